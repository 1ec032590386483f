"""Length of the longest common subsequence of two token arrays."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the code with the query, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(left: list, right: list) -> int:
    """Bit-parallel LCS (Hyyrö 2004): one big-integer step per right-hand token."""
    if len(left) < len(right):
        left, right = right, left
    positions: dict = {}
    for i, token in enumerate(right):
        positions[token] = positions.get(token, 0) | (1 << i)
    full = (1 << len(right)) - 1
    state = full
    for token in left:
        hits = state & positions.get(token, 0)
        state = ((state + hits) | (state - hits)) & full
    return len(right) - bin(state).count("1")


@F.pandas_udf(T.IntegerType())
def token_lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    """Tokens arrive as one space-joined string per side."""
    return pd.Series(
        [lcs_length(a.split(" ") if a else [], b.split(" ") if b else []) for a, b in zip(left, right)],
        dtype="int32",
    )
