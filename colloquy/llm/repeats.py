"""Byte strings that repeat anywhere in a table of texts, from common-prefix interval trees.

A suffix array of all bytes of a corpus does not fit one machine, and only repeats of ``length`` bytes matter.  So suffixes start at
anchors alone: of each window of ``length`` bytes the place whose short string hashes lowest, the
leftmost of equal ones.  Equal windows choose the same place, so windows can only repeat among anchors of
one string, and these are worked on together:

1. An anchor stands for the windows that chose it, neighbours of each other.  Anchors are counted by their string;
   those of one occurrence go.  Where all have the same bytes around them, all their windows repeat.
2. Other groups keep one anchor per distinct surroundings.  Surroundings found twice repeat as a whole; the rest is
   compared byte by byte.  The suffixes of a group from its anchors on are sorted, neighbours' common prefixes
   give an enhanced suffix array, and a scan with a stack visits its intervals, the deepest first.  All suffixes of an interval
   of depth d agree on d bytes; ordered by the bytes before them, backwards, they show for each the longest
   extension to the left that another shares.  Both together are a maximal repeat, given for all its occurrences.
3. Groups of more than ``crowd`` distinct surroundings are never brought together.  Their windows are
   counted by digest instead, in an aggregate that combines before it shuffles.

Grouping relies on two independent 64-bit digests together, never on one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.batches import parts
from colloquy.operators.lineage import settle

LENGTH = 200
#: Distinct surroundings of one anchor string that a task compares at once.
CROWD = 2_048
#: Windows hashed at once; a place in a chunk takes ``PLACE`` bits.
CHUNK, PLACE = 1 << 18, 20
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
TEXT = ["k1", "k2"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    of = lambda base: np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)
    return of(np.uint64(_ODD)), of(np.uint64(pow(_ODD, -1, 1 << 64)))


class _Places:
    """The anchor of every window of a byte string, without a loop over bytes."""

    def __init__(self, length: int):
        self.length, self.size = length, max(1, length // 4)
        self.power, self.inverse = _powers(CHUNK + length)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data) - self.length + 1
        out = [self._chunk(data[c : min(c + CHUNK, n) + self.length - 1]) + c for c in range(0, n, CHUNK)]
        return np.concatenate(out)

    def _chunk(self, data: np.ndarray) -> np.ndarray:
        n, size, w = len(data) - self.length + 1, self.size, self.length - self.size + 1
        total = np.r_[np.uint64(0), np.cumsum(_TABLE[data] * self.power[: len(data)], dtype=np.uint64)]
        h = (total[size:] - total[:-size]) * self.inverse[: len(data) - size + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h = (h >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(h) // w)
        blocks = np.r_[h, np.full(rows * w - len(h), np.iinfo(np.uint64).max)].reshape(rows, w)
        upto = np.minimum.accumulate(blocks, axis=1).ravel()
        since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(since[:n], upto[w - 1 : w - 1 + n])
        return (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)


def _digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    values = [digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    return np.array(values, np.uint64).view(np.int64)


def _anchors(length: int):
    """``k1, k2, start, more, ahead, times, a, d`` of the anchors: windows start .. start + more chose the place start + ahead.

    Anchors of one text with equal surroundings, as text of a short period has by the thousand, give one row with
    their number as ``times``; what they cover repeats, whatever other texts hold, and comes merged in rows of
    ``times`` 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(length)
        for batch in batches:
            for part in parts(batch, 2):
                texts = part.column(2).to_pylist()
                data = b"".join(texts)
                if len(data) < length:
                    continue
                first = np.cumsum([0, *map(len, texts)])
                place = places(np.frombuffer(data, np.uint8))
                owner = np.repeat(np.arange(len(texts)), np.diff(first))[: len(place)]
                at = np.flatnonzero(np.arange(len(place)) + length <= first[owner + 1])
                if not len(at):
                    continue
                place, owner = place[at], owner[at]
                new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
                start, last = at[new], at[np.r_[new[1:] - 1, len(at) - 1]]
                place, owner = place[new], owner[new]
                a, d = _digests(data, place, place + places.size), _digests(data, start, last + length)
                once, times, again = _once_each(owner, a, d)
                ahead = place - start
                yield batch_of(part, first, owner[once], start[once], last[once], ahead[once], times, a[once], d[once])
                if len(again):
                    owner, start, last = owner[again], start[again], last[again]
                    new = np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] > last[:-1] + length)]
                    owner, start, last = owner[new], start[new], last[np.r_[np.flatnonzero(new)[1:] - 1, len(last) - 1]]
                    none = np.zeros(len(start), np.int64)
                    yield batch_of(part, first, owner, start, last, none, none, none, _digests(data, start, last + length))

    def batch_of(part, first, owner, start, last, ahead, times, a, d) -> pa.RecordBatch:
        keys = [part.column(i).take(pa.array(owner)) for i in range(2)]
        ints = [pa.array(x.astype(np.int32)) for x in (start - first[owner], last - start, ahead, times)]
        return pa.RecordBatch.from_arrays([*keys, *ints, pa.array(a), pa.array(d)], [*TEXT, "start", "more", "ahead", "times", "a", "d"])

    return run


def _once_each(owner: np.ndarray, a: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first anchor of each text and surroundings, their numbers, and all anchors that are not alone."""
    order = np.lexsort((d, a, owner))
    new = np.flatnonzero(np.r_[True, (owner[order][1:] != owner[order][:-1]) | (a[order][1:] != a[order][:-1]) | (d[order][1:] != d[order][:-1])])
    times = np.diff(np.r_[new, len(order)])
    return order[new], times, np.sort(order[np.repeat(times, times) > 1])


CONTEXT = "a long, d long, k1 long, k2 long, start int, more int, ahead int, single boolean, crowded boolean, around binary"


def _contexts(length: int):
    """The bytes around the wanted anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 2):
                rows = []
                for k1, k2, text, wanted in zip(*(c.to_pylist() for c in part.columns)):
                    for x in wanted:
                        around = text[x["start"] : x["start"] + x["more"] + length]
                        rows.append((x["a"], x["d"], k1, k2, x["start"], x["more"], x["ahead"], x["single"], x["crowded"], around))
                    if len(rows) > 20_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.bool_()] * 2 + [pa.binary()]
    names = [f.split()[0] for f in CONTEXT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    return n if a == b else n - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


def _maximal(members: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """``member, before, after`` of the maximal repeats of ``length`` bytes or more around the anchors of a group, for
    members ``(ahead, around)``: the bytes before and after the anchor's place that another member shares."""
    left = [around[:ahead][::-1] for ahead, around in members]
    right = [around[ahead:] for ahead, around in members]
    order = sorted(range(len(members)), key=right.__getitem__)
    by_left = sorted(range(len(members)), key=left.__getitem__)
    rank = [0] * len(members)
    for r, i in enumerate(by_left):
        rank[i] = r
    widest = max(map(len, left))
    done = [-1] * len(members)
    stack = [(0, 0)]  # depth, first suffix of the open intervals
    for at in range(1, len(order) + 1):
        depth = _common(right[order[at - 1]], right[order[at]]) if at < len(order) else 0
        begin = at - 1
        while stack[-1][0] > depth:
            d, begin = stack.pop()
            if d + widest < length:
                continue
            inside = sorted(order[begin:at], key=rank.__getitem__)
            shared = [_common(left[i], left[j]) for i, j in zip(inside, inside[1:])]
            for i, x, y in zip(inside, [-1, *shared], [*shared, -1]):
                longest = max(x, y)
                # A deeper interval with as long an extension holds this one.
                if longest > done[i]:
                    done[i] = longest
                    if longest + d >= length:
                        yield i, longest, d
        if stack[-1][0] < depth:
            stack.append((depth, begin))


def _trees(length: int):
    """Spans of the maximal repeats of whole groups; rows come sorted by ``a``."""

    def spans(group: list[dict]) -> list[tuple]:
        out = []
        if len(group) < 2:
            return out
        for i, before, after in _maximal([(m["ahead"], m["around"]) for m in group], length):
            m = group[i]
            if m["single"]:
                around = m["around"][m["ahead"] - before : m["ahead"] + after]
                start = m["start"] + m["ahead"] - before
                out.append((m["k1"], m["k2"], start, start + before + after, _signed(around)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if group and row["a"] != group[0]["a"]:
                    found += spans(group)
                    group = []
                group.append(row)
            if found:
                yield _spans(found)
        if found := spans(group):
            yield _spans(found)

    return run


def _signed(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 64) * (xxhash.xxh64_intdigest(data) >> 63)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], [*TEXT, "start", "end", "group"])


def _windows(length: int):
    """Each window of a crowded group's members, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                more = part.column("more").to_numpy() + 1
                row = np.repeat(np.arange(len(more)), more)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(more) - more, more)
                around = part.column("around").to_pylist()
                digests = [_signed(around[i][o : o + length]) for i, o in zip(row.tolist(), offset.tolist())]
                start = part.column("start").to_numpy()[row] + offset.astype(np.int32)
                keys = [part.column(c).take(pa.array(row)) for c in ("a", *TEXT)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(start, pa.int32()), pa.array(digests, pa.int64())], ["a", *TEXT, "start", "w"])

    return run


def _keyed(df: DataFrame, text: str, *more) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return df.select(*more, F.xxhash64(value).alias("k1"), F.xxhash64(F.lit("text"), value).alias("k2"), value.cast("binary").alias("data"))


def repeated(df: DataFrame, text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``k1, k2, start, end, group``: spans, in bytes, that hold every string of ``length`` bytes that also starts
    elsewhere in the table, in this text or another.  ``k1, k2`` are digests of the text; equal texts are listed once or more often, with the
    same spans.  Spans of equal bytes have one ``group``, a digest of them."""
    docs = _keyed(df, text).select(*TEXT, "data")
    anchors = settle(docs.mapInArrow(_anchors(length), "k1 long, k2 long, start int, more int, ahead int, times int, a long, d long"), "anchors")
    alone, anchors = anchors.where("times = 0"), anchors.where("times > 0")
    kinds = anchors.groupBy("a").agg(F.sum("times").alias("n"), (F.min("d") != F.max("d")).alias("mixed")).where("n > 1")
    met = settle(anchors.join(settle(kinds.select("a", "mixed"), "strings"), "a"), "met")
    whole = lambda rows: rows.select(*TEXT, "start", F.expr(f"start + more + {length}").alias("end"), F.col("d").alias("group"))

    mixed = met.where("mixed")
    around = mixed.groupBy("a", "d").agg(F.sum("times").alias("n"), F.min(F.struct(*TEXT, "start", "more", "ahead")).alias("m"))
    around = settle(around, "surroundings")
    twice = mixed.join(around.where("n > 1").select("a", "d"), ["a", "d"], "left_semi")
    crowded = settle(around.groupBy("a").count().where(F.col("count") > crowd).select("a", F.lit(True).alias("crowded")), "crowded")
    wanted = around.join(crowded, "a", "left").select(
        *[f"m.{c}" for c in TEXT],
        F.struct("m.start", "m.more", "m.ahead", "a", "d", (F.col("n") == 1).alias("single"), F.coalesce("crowded", F.lit(False)).alias("crowded")).alias("x"),
    )
    wanted = wanted.groupBy(*TEXT).agg(F.collect_list("x").alias("wanted"))
    texts = docs.groupBy(*TEXT).agg(F.first("data").alias("data")).join(wanted, TEXT).select(*TEXT, "data", "wanted")
    members = texts.mapInArrow(_contexts(length), CONTEXT)
    span = "k1 long, k2 long, start int, end int, group long"
    out = whole(met.where("not mixed")).unionByName(whole(twice)).unionByName(whole(alone))
    if crowded.isEmpty():
        return out.unionByName(members.repartition("a").sortWithinPartitions("a").mapInArrow(_trees(length), span))
    members = settle(members, "members")
    small = members.where("not crowded").repartition("a").sortWithinPartitions("a")
    windows = settle(members.where("crowded").mapInArrow(_windows(length), "a long, k1 long, k2 long, start int, w long"), "windows")
    again = settle(windows.groupBy("a", "w").count().where("count > 1").select("a", "w"), "windows-again")
    single = windows.join(again, ["a", "w"], "left_semi")
    single = single.select(*TEXT, "start", F.expr(f"start + {length}").alias("end"), F.col("w").alias("group"))
    return out.unionByName(small.mapInArrow(_trees(length), span)).unionByName(single)


KEPT = "n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, 1):
            rows = []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                kept, upto, runs, removed = [], 0, 0, 0
                end = -1
                for s in sorted((s["start"], s["end"]) for s in spans or ()):
                    if s[0] > end:
                        runs += 1
                        kept.append(text[upto : s[0]])
                    end = max(end, s[1])
                    upto = end
                kept = b"".join([*kept, text[upto:]])
                rows.append((len(text), len(text) - len(kept), runs, kept))
            columns = [pa.array(v, k) for v, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["row", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(df: DataFrame, keep: list[str], text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the UTF-8 bytes of the whole text without those
    that lie in a string of ``length`` bytes which also starts anywhere else in the table; ``n_spans`` counts the maximal removed
    stretches.  Strings are judged on the input and never cross texts.

    A null text is empty; texts shorter than ``length`` keep all.  Repeated rows and equal texts are repeats of each other and,
    from ``length`` bytes on, lose everything.  Other columns are ignored, whatever their names; an empty table gives an empty
    result.  The longest text bounds a task's memory, with some bytes per byte."""
    if length < 4:
        raise ValueError("repeats have four bytes or more")
    spans = repeated(df, text, length, crowd)
    lists = settle(spans.groupBy(*TEXT).agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    rows = _keyed(df, text, F.struct(*[F.col(c) for c in keep]).alias("row")).join(lists, TEXT, "left").select("row", "data", "spans")
    names = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return rows.mapInArrow(_cut, f"row struct<{names}>, {KEPT}").select("row.*", "n_bytes", "n_removed", "n_spans", "kept")
