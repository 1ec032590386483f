"""Explicit schemas of the tables that flow between the operators."""

from pyspark.sql import types as T

EXAMPLES = T.StructType([
    T.StructField("example_id", T.LongType()),
    T.StructField("user", T.StringType()),
    T.StructField("assistant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("source", T.StringType()),
])

TEXT_RECORDS = T.StructType([
    T.StructField("example_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("category", T.StringType()),
])

PREFERENCES = T.StructType([
    T.StructField("example_id", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("chosen", T.StringType()),
    T.StructField("rejected", T.StringType()),
    T.StructField("category", T.StringType()),
])

KNOWLEDGE = T.StructType([
    T.StructField("question_id", T.IntegerType()),
    T.StructField("question", T.StringType()),
    T.StructField("choices", T.ArrayType(T.StringType())),
    T.StructField("answer", T.IntegerType()),
    T.StructField("category", T.StringType()),
])
