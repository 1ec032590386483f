"""Words, as all operators of this folder count them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text (null: none), in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
