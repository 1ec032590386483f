"""Analytics over training-run and request logs.

Run logs are ``run_id, step, ...`` with steps increasing in a run.  A run too long
for one task is cut into chunks along its steps (see ``hotkeys``)."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators import hotkeys
from colloquy.operators.lineage import settle

#: Rows of a block of a moving average at most.
BLOCK_ROWS = 512
#: Powers of ten that a weight may fall within a block, and below which an earlier block leaves no trace in a double.
FALL, TRACE = 100, 1e-60


def smoothed_loss(
    log: DataFrame, smoothing: float = 0.9, run: str = "run_id", step: str = "step",
    loss: str = "loss", chunk_rows: int = hotkeys.CHUNK_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exponential moving average of the loss: the first value seeds it, rows without
    a loss are left out.

    A run is cut into blocks of steps.  A block takes what came before it to ``scale * before + offset`` with a scale
    that its size gives, so what reaches a block is a sum of the offsets before it with falling weights; from
    there its rows follow one after another.  No run is worked on in one task."""
    if not 0 <= smoothing <= 1:
        raise ValueError(f"smoothing must lie in [0, 1], got {smoothing}")
    rows = log.where(F.col(loss).isNotNull()).select(run, step, F.col(loss).cast("double").alias("loss"))
    placed = hotkeys.add_position(rows, run, [step], "_at", chunk_rows)
    n = _block_size(smoothing, block_rows)
    keep, new = F.lit(smoothing), F.lit(1 - smoothing)
    follow = lambda before, x: F.when(before.isNull(), x).otherwise(keep * before + new * x)
    blocks = placed.groupBy(run, F.floor((F.col("_at") - 1) / n).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_at", step, "loss"))).alias("rows")
    )
    blocks = settle(blocks, "blocks")
    start = F.when(F.col("_block") > 0, F.lit(0.0))
    offset = F.aggregate("rows", start, lambda before, r: follow(before, r["loss"]))
    ends = blocks.where(F.size("rows") == n).select(run, F.col("_block").alias("_at"), offset.alias("_v"))
    sums = _fading_sum(ends, run, smoothing**n, block_rows).select(
        F.col(run).alias("_run"), (F.col("_at") + 1).alias("_next"), F.col("_sum").alias("before")
    )
    same = F.col(run).eqNullSafe(F.col("_run")) & (F.col("_block") == F.col("_next"))
    values = F.aggregate(
        "rows", F.struct(F.col("before").alias("last"), F.array().cast("array<double>").alias("out")),
        lambda acc, r: F.struct(
            follow(acc["last"], r["loss"]).alias("last"), F.concat(acc["out"], F.array(follow(acc["last"], r["loss"]))).alias("out")
        ),
        lambda acc: acc["out"],
    )
    zipped = F.zip_with("rows", values, lambda r, s: F.struct(r[step].alias(step), r["loss"].alias("loss"), s.alias("smoothed")))
    return blocks.join(sums, same, "left").select(run, F.inline(zipped))


def _block_size(weight: float, most: int) -> int:
    return max(1, min(most, int(FALL / -math.log10(weight)))) if 0 < weight < 1 else most


def _fading_sum(rows: DataFrame, run: str, weight: float, block_rows: int) -> DataFrame:
    """``run, _at, _sum``: the sum over a run of ``_v`` up to this row, each times ``weight`` to the power of the rows since;
    ``_at`` numbers the rows of a run from 0."""
    if weight < TRACE:
        return rows.select(run, "_at", F.col("_v").alias("_sum"))
    n = _block_size(weight, block_rows)
    power = lambda exponent: F.pow(F.lit(weight), exponent)
    cut = rows.withColumns({"_block": F.floor(F.col("_at") / n), "_i": F.col("_at") % n})
    within = Window.partitionBy(run, "_block").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    inside = power(F.col("_i")) * F.sum(F.col("_v") * power(-F.col("_i"))).over(within)
    out = settle(cut.select(run, "_at", "_block", "_i", inside.alias("_sum")), "sums")
    ends = out.where(F.col("_i") == n - 1).select(run, F.col("_block").alias("_at"), F.col("_sum").alias("_v"))
    if not ends.isEmpty():
        carry = _fading_sum(ends, run, weight**n, block_rows).select(
            F.col(run).alias("_run"), (F.col("_at") + 1).alias("_next"), F.col("_sum").alias("_carry")
        )
        same = F.col(run).eqNullSafe(F.col("_run")) & (F.col("_block") == F.col("_next"))
        gone = power(F.col("_i") + 1) * F.coalesce("_carry", F.lit(0.0))
        out = out.join(carry, same, "left").withColumn("_sum", F.col("_sum") + gone)
    return out.select(run, "_at", "_sum")


def throughput(
    log: DataFrame, max_steps: Column | None = None, run: str = "run_id", step: str = "step",
    ts: str = "ts",
) -> DataFrame:
    """Steps per second since the run's first row, and the seconds the rest will take;
    zero where no time has passed or nothing was done.  Without ``max_steps`` a
    run's own last step counts as its goal."""
    # Written, so that the join sees its size and, where it must shuffle, Spark can split large runs.
    runs = settle(log.groupBy(run).agg(F.min(ts).alias("started"), F.max(step).alias("last_step")), "runs")
    # From the interval, so that the session's time zone plays no part.
    gap = F.col(ts) - F.col("started")
    seconds = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
    parts = [F.extract(F.lit(unit), gap).cast("double") * n for unit, n in seconds.items()]
    elapsed = sum(parts[1:], parts[0])
    goal = F.col("last_step") if max_steps is None else max_steps
    rate = F.when(F.col("elapsed") > 0, F.col(step) / F.col("elapsed")).otherwise(F.lit(0.0))
    left = F.when(
        F.col("steps_per_second") > 0, (F.col("goal") - F.col(step)) / F.col("steps_per_second")
    ).otherwise(F.lit(0.0))
    return (
        log.join(runs, run)
        .select(run, step, elapsed.alias("elapsed"), goal.alias("goal"))
        .withColumn("steps_per_second", rate)
        .withColumn("remaining", left)
        .drop("goal")
    )


def best_step(log: DataFrame, run: str = "run_id", step: str = "step", loss: str = "eval_loss") -> DataFrame:
    """The lowest evaluation loss of each run and the first step that reached it."""
    best = F.min(F.struct(F.col(loss).alias("best_loss"), F.col(step).alias("best_step")))
    return (
        log.where(F.col(loss).isNotNull()).groupBy(run).agg(best.alias("b")).select(run, "b.best_step", "b.best_loss")
    )


def _running(log, run, step, value, combine, upto, chunk_rows):
    """``value`` combined over the rows of the run up to row ``upto`` before this one."""
    chunked, cut = hotkeys.add_chunks(log, run, [step], chunk_rows)
    frame = Window.partitionBy(run, "chunk").orderBy(step).rowsBetween(Window.unboundedPreceding, upto)
    out = chunked.withColumn("_running", combine(F.col(value)).over(frame))
    if not cut:
        return out.drop("chunk", "at")
    earlier = hotkeys.earlier_chunks(chunked, run, {"_earlier": combine(F.col(value))}, combine)
    pick = F.least if combine is F.min else F.greatest
    return hotkeys.with_earlier(out, run, earlier).withColumn("_running", pick("_running", "_earlier")).drop("_earlier", "chunk", "at")


def new_bests(
    log: DataFrame, run: str = "run_id", step: str = "step", loss: str = "eval_loss",
    chunk_rows: int = hotkeys.CHUNK_ROWS,
) -> DataFrame:
    """The rows that improve on every earlier evaluation of the run; a tie does not."""
    rows = _running(log.where(F.col(loss).isNotNull()).select(run, step, loss), run, step, loss, F.min, -1, chunk_rows)
    return rows.where(F.col("_running").isNull() | (F.col(loss) < F.col("_running"))).select(run, step, loss)


def peak_gauge(
    log: DataFrame, every: int = 100, run: str = "run_id", step: str = "step", gauge: str = "gauge",
    chunk_rows: int = hotkeys.CHUNK_ROWS,
) -> DataFrame:
    """The running maximum of a gauge read at every ``every``-th step."""
    read = log.where(F.col(step) % every == 0).select(run, step, gauge)
    return _running(read, run, step, gauge, F.max, 0, chunk_rows).withColumnRenamed("_running", "peak")


def request_usage(requests: DataFrame) -> DataFrame:
    """Total tokens, rounded latency and tokens per second of every request."""
    seconds = F.col("latency_seconds")
    speed = F.when(seconds > 0, F.round(F.col("completion_tokens") / seconds, 1)).otherwise(F.lit(0.0))
    return requests.withColumns(
        {
            "total_tokens": F.col("prompt_tokens") + F.col("completion_tokens"),
            "latency_seconds": F.round(seconds, 2),
            "tokens_per_second": speed,
        }
    )


def usage_rollup(usage: DataFrame, by: list[Column | str]) -> DataFrame:
    return usage.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("prompt_tokens").cast("long").alias("prompt_tokens"),
        F.sum("completion_tokens").cast("long").alias("completion_tokens"),
        F.sum("total_tokens").cast("long").alias("total_tokens"),
        F.avg("latency_seconds").alias("mean_latency"),
        F.avg("tokens_per_second").alias("mean_speed"),
    )
