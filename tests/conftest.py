import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from colloquy.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 2, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="colloquy-case-")
