"""Personal-data masking over tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import pii
from colloquy.functions import text as X


def mask_fields(df: DataFrame, fields=("user", "assistant")) -> DataFrame:
    """Mask the fields in place; keep the counts beside them as ``<field>_pii``."""
    counts = F.struct(*[pii.pii_counts(F.col(f)).alias(f) for f in fields])
    counted = df.select("*", X.once(counts).alias("_pii")).select(
        "*", *[F.col(f"_pii.{f}").alias(f"{f}_pii") for f in fields]
    ).drop("_pii")
    return counted.withColumns(
        {f: pii.mask_by_counts(F.col(f), F.col(f"{f}_pii")) for f in fields}
    )


def pii_totals(masked: DataFrame, fields=("user", "assistant"), by=()) -> DataFrame:
    """Long totals ``field, pii_type, n`` of a masked table; absent types are left
    out.  The sums are taken before the unpivot, so one row per group is shuffled."""
    sums = masked.groupBy(*by).agg(
        *[
            F.sum(F.col(f"{f}_pii.{t}")).cast("long").alias(f"{f}.{t}")
            for f in fields
            for t in fixed.PII_TYPES
        ]
    )
    long = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("field"),
                    F.lit(t).alias("pii_type"),
                    F.col(f"`{f}.{t}`").alias("n"),
                )
                for f in fields
                for t in fixed.PII_TYPES
            ]
        )
    )
    return sums.select(*by, long.alias("x")).select(*by, "x.*").where(F.col("n") > 0)
