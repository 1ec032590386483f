"""Running a Python function over Arrow batches of a DataFrame."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and characters handed on at once, so that a batch of long texts stays small.
ROWS = 512
CHARS = 1_000_000


def map_rows(
    df: DataFrame,
    column: str,
    keep: list[str],
    new: T.StructType,
    make: Callable[[], Callable[[object], Iterable[tuple]]],
) -> DataFrame:
    """Call a function on each value of ``column`` and return, for every tuple it yields,
    the row's ``keep`` columns followed by the tuple's fields (``new``).

    ``make`` runs once per task and gives the function, so that it may hold
    caches or tables.  No shuffle; a part of one Arrow batch is held at a time.  ``new``
    names must differ from ``keep`` names."""

    def of_lists():
        one = make()
        return lambda values: map(one, values)

    return map_lists(df, column, keep, new, of_lists)


def map_lists(
    df: DataFrame,
    column: str,
    keep: list[str],
    new: T.StructType,
    make: Callable[[], Callable[[list], Iterable[Iterable[tuple]]]],
) -> DataFrame:
    """As ``map_rows``, for a function that takes a list of values and gives the tuples of each."""
    schema = T.StructType([*[df.schema[k] for k in keep], *new.fields])
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in new.fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            for part in parts(batch, len(keep)):
                origin, found = [], []
                for i, rows in enumerate(of(part.column(len(keep)).to_pylist())):
                    for row in rows:
                        origin.append(i)
                        found.append(row)
                if not found:
                    continue
                kept = [part.column(i).take(pa.array(origin, pa.int64())) for i in range(len(keep))]
                fields = [
                    pa.array(values, f.type) for values, f in zip(zip(*found), arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*kept, *fields], names)

    return df.select(*keep, F.col(column).alias("__value")).mapInArrow(run, schema)


def parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded rows and, where column ``at`` holds texts or bytes, bounded size."""
    column, start, size = batch.column(at), 0, 0
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)
        return
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        if i > start and (i - start >= ROWS or size + (n or 0) > CHARS):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
