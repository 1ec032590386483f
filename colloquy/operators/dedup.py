"""Near-duplicate removal by exact Jaccard similarity of word n-gram sets.

A row is dropped when it is similar to a kept row of lower key, as if rows were
scanned in key order.  The steps:

1. The n-grams of every row are put in one order for all rows, and its first ones
   are written as its prefix (prefix filter).  Rows of equal words collapse to the
   lowest key (one hash aggregate).
2. The prefixes of the remaining rows become entries; those of n-grams in one row
   only go before anything is stored.  The shorter row of a
   similar pair shares one of its still fewer *index* entries with the longer one,
   and at the first n-gram they share, enough n-grams follow in both rows to reach
   the threshold.  Any order would give the same rows; this one puts what a sample of rows
   holds often last, so text that many rows share brings no rows together.  Entries are
   64-bit hashes; chance collisions only bring more pairs.
3. An n-gram with few entries yields their pairs.  One with many, as near-copies
   have, yields only the pairs with its lowest row; when those drop the copies, the
   rest goes on in the next round.  When a round drops too little, the remaining
   groups are compared whole, in tiles of bounded size.
4. Pairs whose sketches, a few bytes for each ten n-grams, already differ too much go;
   no similar pair can.  The others are checked on hashes of their rows, those that one chance collision
   could decide on the full sets, and rows decided in rounds: a row without an undecided lower neighbour is kept,
   the higher neighbours of a kept row drop.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy import fixed
from colloquy.functions import text as X
from colloquy.operators.lineage import passing, scoped, settle

#: Rows of a group whose pairs are listed at once; larger ones start with their lowest row.
SMALL_GROUP = 50
#: Every so manieth row, of more than so many rows, has its n-grams counted for the order.  A share and not a number: with
#: a number the n-grams seen too seldom to be told from rare ones would be in ever more rows of a larger table.
SAMPLE_EVERY, SAMPLE_ROWS = 16, 4_096
#: Counters of the n-grams, one byte each; n-grams that share one count together.  A block is packed in one task.
SLOTS, BLOCK = 1 << 24, 1 << 16
#: Rows at one side of a tile.
TILE_ROWS = 2_000
#: Rounds must leave no more than this share of the rows that wait.
LEFT_SHARE = 0.5
#: N-grams that a Python worker orders at once; a longer row goes alone.
BATCH_GRAMS = 1 << 18
#: Bytes of text that count as a word where a worker splits texts, few enough for most languages.
BYTES_A_WORD = 4
#: An odd number, as of many bits as not (the golden ratio's).
MIXER = np.uint64(0x9E3779B97F4A7C15)
#: Slack of the floating-point bounds; it only lets more pairs through.
SLACK = 1e-6


def _whole(texts: DataFrame) -> DataFrame:
    """The rows with ``whole``, the text in lower case without outer white space."""
    return texts.select("rid", X.strip(F.lower("text")).alias("whole"))


def _hash(texts: pa.Array) -> np.ndarray:
    return pd.util.hash_array(texts.to_numpy(zero_copy_only=False), categorize=False)


def _grams(batches: Iterator[pa.RecordBatch], n: int, most: int) -> Iterator[pa.RecordBatch]:
    """``rid, digest, size, hashes`` of batches of ``rid, whole``: the n-grams with repeats as 64-bit hashes, and the
    digest of the words; equal sequences have equal sets.  Arrow splits at the same white space as ``X.words``
    (tested); only the different words of about ``most`` words are hashed, and n-grams are made of words' hashes."""
    for batch in batches:
        length = pc.binary_length(batch.column("whole"))
        for rows in _pieces([batch.append_column("size", length)], BYTES_A_WORD * most):
            whole = rows.column("whole").cast(pa.string())
            split = pc.utf8_split_whitespace(whole)
            size = pc.list_value_length(split).to_numpy().astype("int64")
            known = split.flatten().dictionary_encode()
            one = _hash(known.dictionary)[known.indices.to_numpy()]
            hashes, short = one, size < n
            for later in range(1, n):
                # A bijection of the hash so far, so that places count; the words themselves are hashed well.
                hashes = (hashes ^ hashes >> np.uint64(32)) * MIXER
                hashes[:-later] += one[later:]
            # An n-gram starts at each word but a row's last ones; a row of fewer words has one, itself.
            after = np.repeat(np.cumsum(size), size) - np.arange(len(hashes))
            first, alone = after == np.repeat(size, size), np.repeat(short, size)
            hashes[first & alone] = _hash(whole.filter(pa.array(short)))
            hashes = hashes[np.where(alone, first, after >= n)].view("int64")
            size = np.where(short, 1, size - n + 1)
            words = pc.if_else(pa.array(short), whole, pc.binary_join(split, " ")).cast(pa.binary())
            digest = pa.array([hashlib.sha256(w).digest() for w in words.to_pylist()], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype("int32")), pa.array(hashes))
            columns = [rows.column("rid"), digest, pa.array(size.astype("int32")), lists]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "digest", "size", "hashes"])


def _hashed(texts: DataFrame, n: int) -> DataFrame:
    """The set of n-grams of each row as 64-bit hashes, and their number."""
    whole = _whole(texts)
    schema = T.StructType([whole.schema["rid"], T.StructField("hashes", T.ArrayType(T.LongType()))])
    most = BATCH_GRAMS
    made = lambda batches: (b.select(schema.names) for b in _grams(batches, n, most))
    hashes = X.once(F.array_distinct("hashes")).alias("hashes")
    return whole.mapInArrow(made, schema).select("rid", hashes).select("rid", F.size("hashes").alias("size"), "hashes")


def _sequence(n: int) -> Column:
    """The digest of the words, as in ``_grams``."""
    whole = X.strip(F.lower("text"))
    words = lambda w: F.when(F.size(w) < n, whole).otherwise(F.array_join(w, " "))
    return X.let(X.words(whole), lambda w: F.unhex(F.sha2(words(w), 256)))


def _frequent(hashed: DataFrame) -> np.ndarray:
    """The counters of the n-grams by the low bits of their hash, as logarithms in one byte."""
    slots = hashed.select(F.explode("hashes").alias("h")).groupBy(F.col("h").bitwiseAND(SLOTS - 1).cast("int").alias("slot"))
    times = F.floor(F.log2(F.count(F.lit(1)) + 1) * 16)
    counts = slots.agg(F.least(times, F.lit(255)).cast("int").alias("n"))

    def pack(block):
        out = np.zeros(BLOCK, "uint8")
        out[block["slot"].to_numpy() % BLOCK] = block["n"].to_numpy()
        return pd.DataFrame({"at": [int(block["slot"].iloc[0]) // BLOCK], "counts": [out.tobytes()]})

    blocks = counts.groupBy(F.floor(F.col("slot") / F.lit(BLOCK)).alias("block")).applyInPandas(pack, "at int, counts binary")
    table = np.zeros(SLOTS, "uint8")
    for at, packed in blocks.collect():
        table[at * BLOCK : (at + 1) * BLOCK] = np.frombuffer(packed, "uint8")
    return table


def _order(grams: np.ndarray, row: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The places of the n-grams by row, then count, then hash.  Most of the hash fits into one number with the others."""
    one = row << 45 | times.astype("int64") << 37 | (grams >> 27) & ((1 << 37) - 1)
    by = np.argsort(one)
    ties = (np.diff(one[by]) == 0) & (np.diff(grams[by]) != 0)
    return np.lexsort((grams, one)) if ties.any() else by


def _sketches(grams: np.ndarray, row: np.ndarray, size: np.ndarray, threshold: float) -> pa.ListArray:
    """For each row a list of 64-bit words, a power of two of them.  A bit tells whether an odd number of the row's
    hashes fall on it, so two sketches differ in no more bits than the sets in n-grams.  One of twice the length folds
    to the shorter by XOR of its halves.  Sketches of unlike sets differ in half their bits, which at least is twice what
    those of similar sets can, or there are two bits an n-gram."""
    bits = np.maximum(size * min(2, 8 * (1 - threshold) / (1 + threshold)), 64)
    words = 2 ** np.ceil(np.log2(bits / 64)).astype("int64")
    ends = np.r_[0, np.cumsum(words)]
    at = 64 * ends[row] + (grams & (64 * words - 1)[row])
    odd = (np.bincount(at, minlength=64 * ends[-1]) & 1).astype("uint8")
    out = np.packbits(odd, bitorder="little").view("int64")
    return pa.ListArray.from_arrays(ends.astype("int32"), pa.array(out))


def _pieces(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``most`` n-grams, by ``size``, or of one row."""
    for batch in batches:
        ends = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False).astype("int64"))
        start = 0
        while start < len(ends):
            stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def _prefixes(rows: DataFrame, threshold: float, frequent: np.ndarray, n: int | None = None) -> DataFrame:
    """``rid, digest, size, keys, sketch`` of rows ``rid, whole``, made of their ``n``-grams in the same pass; or of
    rows that have their ``hashes``, without the digest.  Keys are the first n-grams in order, of ``s`` n-grams
    ``s - ceil(t * s) + 1``."""
    order = rows.sparkSession.sparkContext.broadcast(frequent)
    longs, whole = T.ArrayType(T.LongType()), [T.StructField("digest", T.BinaryType())] if n else []
    kept = [rows.schema["rid"], *whole]
    schema = T.StructType([
        *kept, T.StructField("size", T.IntegerType()), T.StructField("keys", longs), T.StructField("sketch", longs),
    ])
    most = BATCH_GRAMS

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = order.value
        for batch in _pieces(_grams(batches, n, most) if n else batches, most):
            grams = batch.column("hashes").flatten().to_numpy(zero_copy_only=False)
            size = batch.column("size").to_numpy(zero_copy_only=False).astype("int64")
            row = np.repeat(np.arange(len(size)), size)
            by = _order(grams, row, times[grams & (len(times) - 1)])
            grams, row = grams[by], row[by]
            new = np.r_[True, (np.diff(grams) != 0) | (np.diff(row) != 0)]
            grams, row = grams[new], row[new]
            size = np.bincount(row, minlength=len(size))
            pos = np.arange(len(grams)) - np.repeat(np.cumsum(size) - size, size)
            length = np.minimum(size, size - np.ceil(size * threshold - SLACK).astype("int64") + 1)
            keys = pa.array(grams[pos < length[row]], pa.int64())
            ends = pa.array(np.r_[0, np.cumsum(length)].astype("int32"))
            columns = [*[batch.column(f.name) for f in kept], pa.array(size.astype("int32")), pa.ListArray.from_arrays(ends, keys)]
            yield pa.RecordBatch.from_arrays([*columns, _sketches(grams, row, size, threshold)], schema.names)

    return rows.mapInArrow(first_ones, schema)


def _exploded(prefixes: DataFrame, threshold: float) -> DataFrame:
    """``rid, size, key, pos, index``: an entry for each n-gram of a prefix.  The
    first ``s - ceil(2t / (1 + t) * s) + 1`` are index entries, enough towards rows no
    shorter than the row itself."""
    index = F.col("size") - F.ceil(F.col("size") * F.lit(2 * threshold / (1 + threshold)) - F.lit(SLACK)) + 1
    return prefixes.select("rid", "size", F.posexplode("keys").alias("pos", "key")).select(
        "rid", "size", "key", "pos", (F.col("pos") < index).alias("index")
    )


def _entries(hashed: DataFrame, threshold: float) -> DataFrame:
    return _exploded(_prefixes(hashed, threshold, _frequent(hashed)), threshold)


def _may_be_similar(a: str, b: str, threshold: float) -> Column:
    """Whether two entries of one n-gram, in columns of these prefixes, can be the first
    common ones of a similar pair."""
    size_a, size_b = F.col(f"{a}_size"), F.col(f"{b}_size")
    wanted = (size_a + size_b) * F.lit(threshold / (1 + threshold)) - F.lit(SLACK)
    follow = F.least(size_a - F.col(f"{a}_pos"), size_b - F.col(f"{b}_pos"))
    short = (
        F.when(size_a < size_b, F.col(f"{a}_index"))
        .when(size_a > size_b, F.col(f"{b}_index"))
        .otherwise(F.col(f"{a}_index") | F.col(f"{b}_index"))
    )
    return short & (follow >= wanted)


def _side(entries: DataFrame, name: str, *extra: str) -> DataFrame:
    columns = [F.col(c).alias(f"{name}_{c}") for c in ("size", "pos", "index")]
    return entries.select("key", *extra, F.col("rid").alias(name), *columns)


def _listed(low: DataFrame, high: DataFrame, on: list[str], threshold: float) -> DataFrame:
    return (
        low.join(high, on)
        .where((F.col("lo") < F.col("hi")) & _may_be_similar("lo", "hi", threshold))
        .select("lo", "hi")
    )


def _pairs_of_small(entries: DataFrame, threshold: float) -> DataFrame:
    return _listed(_side(entries, "lo"), _side(entries, "hi"), ["key"], threshold).distinct()


def _pairs_in_tiles(entries: DataFrame, threshold: float) -> DataFrame:
    """The pairs of groups of any size.  Each group is a square of tiles; an entry goes to the
    tiles of its line as the lower row and to those of its column as the higher one."""
    tiles = entries.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).alias("tiles"))
    cut = entries.join(tiles, "key").withColumn("own", F.pmod(F.xxhash64("rid"), F.col("tiles")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    low = _side(cut.withColumn("line", F.col("own")).withColumn("column", every), "lo", "line", "column")
    high = _side(cut.withColumn("column", F.col("own")).withColumn("line", every), "hi", "line", "column")
    return _listed(low, high, ["key", "line", "column"], threshold).distinct()


def _with_both(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs with the other columns of ``rows`` for each end, as ``lo_...`` and ``hi_...``."""
    for end in ("lo", "hi"):
        columns = [F.col(c).alias(end if c == "rid" else f"{end}_{c}") for c in rows.columns]
        pairs = pairs.join(rows.select(*columns), end)
    return pairs


def _sketches_allow(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """The pairs without those whose sketches differ in more bits than sets of a similar pair in elements:
    ``(1 - t) / (1 + t)`` of both sizes.  One chance collision in either row is allowed for."""

    def folded(a, b):
        half = F.shiftright(F.size(a), 1)
        halves = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(a) > F.size(b), halves).otherwise(F.col(a))

    bits = F.zip_with(
        folded("lo_sketch", "hi_sketch"), folded("hi_sketch", "lo_sketch"), lambda x, y: F.bit_count(x.bitwiseXOR(y))
    )
    differ = F.aggregate(bits, F.lit(0), lambda total, more: total + more)
    most = (F.col("lo_size") + F.col("hi_size")) * F.lit((1 - threshold) / (1 + threshold)) + 2 + F.lit(SLACK)
    # Lengths more than one doubling apart leave nulls: such a pair is left to the sets.
    return _with_both(pairs, sketches).where(F.coalesce(differ <= most, F.lit(True))).select("lo", "hi")


def _check_pairs(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, threshold: float, n: int) -> DataFrame:
    """The settled pairs that reach the threshold, by sketches and their hashes; where one hash of two n-grams could
    make the difference, by the full sets."""

    def ends(pairs):
        rows = settle(pairs.select(F.explode(F.array("lo", "hi")).alias("rid")).distinct(), "ends")
        return texts.join(rows, "rid", "left_semi")

    both = F.size("lo_set") + F.size("hi_set")
    share = lambda less: (F.col("shared") - less) / (F.col("both") - F.col("shared") + less)
    with passing(texts.sparkSession) as around:
        pairs = settle(_sketches_allow(pairs, sketches, threshold), "allowed")
        hashed = settle(_hashed(ends(pairs), n).select("rid", F.col("hashes").alias("set")), "hashes")
        near = _with_both(pairs, hashed).select(
            "lo", "hi", both.alias("both"), F.size(F.array_intersect("lo_set", "hi_set")).alias("shared")
        )
        near = near.where((F.col("shared") > 0) & (share(0) >= F.lit(threshold)))
        with scoped(around):
            near = settle(near.select("lo", "hi", (share(1) >= F.lit(threshold)).alias("sure")), "near")
    sure, close = near.where("sure").select("lo", "hi"), near.where("not sure").select("lo", "hi")
    if close.isEmpty():
        return sure
    sets = ends(close).select("rid", X.once(X.shingles(F.col("text"), n)).alias("set"))
    similar = X.jaccard(F.col("lo_set"), F.col("hi_set")) >= F.lit(threshold)
    return sure.unionByName(_with_both(close, sets).where(similar).select("lo", "hi"))


def _decide(edges: DataFrame, waiting: DataFrame | None):
    """Rounds over similar pairs: returns the dropped rows and the pairs still open.
    ``waiting`` rows may have lower neighbours not yet known, so none is kept."""
    dropped = []
    while True:
        blocked = edges.select(F.col("hi").alias("lo"))
        if waiting is not None:
            blocked = blocked.unionByName(waiting.select(F.col("rid").alias("lo")))
        kept = edges.select("lo").distinct().join(blocked, "lo", "left_anti")
        to_kept = edges.join(kept, "lo", "left_semi")
        gone = settle(to_kept.select(F.col("hi").alias("rid")).distinct(), "dropped")
        if gone.isEmpty():
            return dropped, edges
        dropped.append(gone)
        left = edges.join(gone.select(F.col("rid").alias("hi")), "hi", "left_anti")
        edges = settle(left.join(gone.select(F.col("rid").alias("lo")), "lo", "left_anti"), "edges")
        if edges.isEmpty():
            return dropped, edges


def _union(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def kept_keys(
    df: DataFrame,
    key: str = "example_id",
    text: str | Column = "text",
    threshold: float = fixed.DEDUP_THRESHOLD,
    n: int = fixed.DEDUP_NGRAM,
    small_group: int = SMALL_GROUP,
    copies: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """The keys that survive, as one column named ``key``.

    ``copies`` may find copies in its own way: from ``rid, text, digest``, equal digests being equal words, it gives the
    ``rid`` that are no copy of a lower one and candidate pairs ``lo, hi`` of these.  Pairs are checked exactly before
    any other is sought, and not listed again; what it misses is found as without it."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold must lie in (0, 1], got {threshold}")
    text = F.col(text) if isinstance(text, str) else text
    texts = df.select(F.col(key).alias("rid"), F.coalesce(text, F.lit("")).alias("text"))
    every = max(1, min(SAMPLE_EVERY, df.count() // SAMPLE_ROWS))
    frequent = _frequent(_hashed(texts.where(F.pmod(F.xxhash64("rid"), F.lit(every)) == 0), n))
    spark = df.sparkSession
    first, pairs = copies(texts.withColumn("digest", X.once(_sequence(n)))) if copies else (None, None)
    with passing(spark) as around:
        prefixes = _prefixes(_whole(texts), threshold, frequent, n)
        if first is None:
            row = F.struct("rid", "size", "keys", "sketch")
            lowest = prefixes.groupBy("digest").agg(F.min_by(row, "rid").alias("row")).select("row.*")
        else:
            with scoped(around):
                first = settle(first, "distinct")
            lowest = prefixes.drop("digest").join(first, "rid", "left_semi")
        lowest = settle(lowest, "lowest")
        with scoped(around):
            distinct = settle(lowest.select("rid"), "distinct") if first is None else first
        with scoped(around):
            sketches = settle(lowest.select("rid", "size", "sketch"), "sketches")
        entries = _exploded(lowest, threshold)
        shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("index").alias("indexed"))
        shared = settle(shared.where("n > 1 and indexed > 0").select("key"), "shared")
        with scoped(around):
            entries = settle(entries.join(shared, "key", "left_semi"), "entries")
    everything = distinct.select(F.col("rid").alias(key))
    known = pairs and settle(pairs.select("lo", "hi").distinct(), "known")
    unknown = lambda pairs: pairs.join(known, ["lo", "hi"], "left_anti") if known else pairs
    exact = lambda pairs: _check_pairs(pairs, texts, sketches, threshold, n)
    check = lambda pairs: exact(settle(unknown(pairs), "pairs"))

    edges, dropped, waited = known and settle(exact(known), "edges"), [], None
    while True:
        count = F.count(F.lit(1))
        hot = settle(
            entries.groupBy("key")
            .agg(
                count.alias("n"), F.count_if("index").alias("n_index"),
                F.min_by(F.struct("rid", "size", "pos", "index"), "rid").alias("leader"),
            )
            .where((F.col("n_index") > 0) & (F.col("n") > small_group))
            .where(F.col("n") * F.col("n_index") > small_group * small_group)
            .select("key", *[F.col(f"leader.{c}").alias(a) for c, a in
                             (("rid", "lo"), ("size", "lo_size"), ("pos", "lo_pos"), ("index", "lo_index"))]),
            "hot",
        )
        if hot.isEmpty():
            found, waiting = check(_pairs_of_small(entries, threshold)), None
        else:
            followers = settle(
                entries.join(hot.select("key", "lo"), "key").where(F.col("rid") != F.col("lo")).drop("lo"),
                "followers",
            )
            waiting = settle(followers.select("rid").distinct(), "waiting")
            n_waiting = waiting.count()
            if waited is not None and n_waiting > LEFT_SHARE * waited:
                found, waiting = check(_pairs_in_tiles(entries, threshold)), None
            else:
                waited = n_waiting
                led = _listed(hot, _side(followers, "hi"), ["key"], threshold)
                cold = entries.join(hot.select("key"), "key", "left_anti")
                pairs = led.unionByName(_pairs_of_small(cold, threshold)).distinct()
                found = check(pairs)
        found = found if edges is None else edges.unionByName(found).distinct()
        gone, edges = _decide(settle(found, "edges"), waiting)
        dropped += gone
        if waiting is None:
            break
        # A leader has met every row of its group; the others go on without it and
        # without the rows just dropped.
        left = followers
        for g in gone:
            left = left.join(g, "rid", "left_anti")
        entries = settle(left, "entries")

    if not dropped:
        return everything
    gone = _union(dropped).select(F.col("rid").alias(key))
    return everything.join(gone, key, "left_anti")


def deduplicate(
    df: DataFrame,
    key: str = "example_id",
    text: str | Column = "text",
    threshold: float = fixed.DEDUP_THRESHOLD,
    n: int = fixed.DEDUP_NGRAM,
    small_group: int = SMALL_GROUP,
    copies: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """The rows whose text is not similar to that of a kept row of lower key."""
    return df.join(kept_keys(df, key, text, threshold, n, small_group, copies), key, "left_semi")


def one_of_each(
    df: DataFrame, key: str, text: str, threshold: float, n: int, small_group: int = SMALL_GROUP,
    copies: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """As ``deduplicate``, for keys that may repeat or be null: as if rows were scanned by key, rows of one key as
    stored, rows without a key last.  All columns stay."""
    if df.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).isEmpty():
        return deduplicate(df, key, text, threshold, n, small_group, copies)
    stored = settle(df.withColumn("__row", F.monotonically_increasing_id()), "dedup-rows")
    order = stored.select(key, "__row").orderBy(F.col(key).asc_nulls_last(), "__row")
    ranks = settle(order.select("__row", F.monotonically_increasing_id().alias("__rank")), "dedup-ranks")
    ranked = stored.join(ranks, "__row")
    return deduplicate(ranked, "__rank", text, threshold, n, small_group, copies).drop("__row", "__rank")


def deduplicate_examples(df: DataFrame, threshold: float = fixed.DEDUP_THRESHOLD, **kwargs) -> DataFrame:
    """Conversation pairs compared on the question followed by the answer."""
    both = F.concat_ws(" ", F.coalesce("user", F.lit("")), F.coalesce("assistant", F.lit("")))
    return deduplicate(df, text=both, threshold=threshold, **kwargs)
