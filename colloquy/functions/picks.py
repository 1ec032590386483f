"""Seeded picks that depend on the row's key alone, never on partitioning."""

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(*parts) -> Column:
    """The first 32 bits of md5 over the parts joined by ':'."""
    joined = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.left(F.md5(joined), F.lit(8)), 16, 10).cast("long")


def pick(options: int, *parts) -> Column:
    """A number from 0 to ``options - 1``."""
    return (hash_number(*parts) % F.lit(options)).cast("int")


def constant(value, ddl: str) -> Column:
    """A list, map or nested constant as one literal: Spark folds it before running."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def pick_value(values, *parts) -> Column:
    """One of the given texts."""
    return F.get(constant(list(values), "array<string>"), pick(len(values), *parts))
