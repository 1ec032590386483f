"""Periodic runs of words by a suffix automaton with link-cut access.

The suffix links of the automaton of a word sequence form a tree; the path from the root to the state of prefix i holds all
suffixes of that prefix.  Words are visited in order: word i walks its path and recolours it with i, so a segment of one colour e
holds the suffixes that last ended at e before.  If the longest of them has at least i - e words, the two
occurrences touch: a square of period i - e, extended to the left by what is longer.  The visit at a run's last word
gives the whole run.

Only stretches that can hold a run are given to the automaton: after its first period, each word of a run
occurred within one period before, so a run of period up to Q needs that many words in a row with their former
occurrence at most Q back.
"""

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.batches import map_lists
from colloquy.llm.words import word_array

#: A run has at least so many words and so many periods.
LEAST, TIMES = 6, 4
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and longest lengths of the states, and the state of every prefix."""
    step, link, longest, prefix = [{}], [-1], [0], []
    last = 0
    for w in words:
        now = len(link)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and w not in step[at]:
            step[at][w] = now
            at = link[at]
        if at >= 0:
            to = step[at][w]
            if longest[at] + 1 == longest[to]:
                link[now] = to
            else:
                twin = len(link)
                step.append(step[to].copy())
                longest.append(longest[at] + 1)
                link.append(link[to])
                link[to] = link[now] = twin
                while at >= 0 and step[at].get(w) == to:
                    step[at][w] = twin
                    at = link[at]
        prefix.append(now)
        last = now
    return link, longest, prefix


def _chains(link: list[int], longest: list[int]) -> tuple[list[int], list[int]]:
    """The heavy paths of the link tree: each state's chain top and its depth in the tree.  A path from the root crosses
    a logarithm of chains."""
    n = len(link)
    order = np.argsort(longest, kind="stable").tolist()
    weight, heavy, most = [1] * n, [-1] * n, [0] * n
    for v in reversed(order[1:]):
        up = link[v]
        weight[up] += weight[v]
        if weight[v] > most[up]:
            most[up], heavy[up] = weight[v], v
    top, depth = list(range(n)), [0] * n
    for v in order[1:]:
        up = link[v]
        depth[v] = depth[up] + 1
        if heavy[up] == v:
            top[v] = top[up]
    return top, depth


def _runs_of(words: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs of a word sequence, found by recolouring.

    Each chain keeps a stack of coloured segments, the one at its top last: lowest state's depth, its longest
    length, and the colour.  A visit takes off the segments it covers and puts one back."""
    link, longest, prefix = _automaton(words)
    top, depth = _chains(link, longest)
    stacks: dict[int, list] = {}
    found, n = [], len(words)
    for i, v in enumerate(prefix):
        below = -1  # the colour that goes on from the chain below, where it is longer
        while v > 0:
            head = top[v]
            stack = stacks.setdefault(head, [])
            d, size = depth[v], longest[v]
            here = stack[-1][2] if stack else -1
            while stack:
                low, length, e = stack[-1]
                if low > d:
                    length = size
                p = i - e
                if e != below and length >= (times - 1) * p and length + p >= least and (i + 1 == n or words[i + 1] != words[i + 1 - p]):
                    found.append((i - p - length + 1, length + p, p))
                if low > d:
                    break
                stack.pop()
                if low == d:
                    break
            stack.append((d, size, i))
            below, v = here, link[head]
    return found


def _stretches(words: np.ndarray, doc: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Word ranges, apart from each other and within one document, that hold every run."""
    n = len(words)
    if not n:
        return []
    key = doc * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    back = np.full(n, n + 1, np.int64)
    same = key[order[1:]] == key[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    first = np.r_[0, np.flatnonzero(np.diff(doc)) + 1]
    begin = np.repeat(first, np.diff(np.r_[first, n]))
    longest, found, q = int(np.diff(np.r_[first, n]).max()), [], 1
    while (p := q // 2 + 1) * times <= longest:
        edges = np.diff(np.r_[0, back <= q, 0])
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        fits = ends - starts >= max((times - 1) * p, least - q)
        starts, ends = starts[fits], ends[fits]
        found += zip(np.maximum(starts - q, begin[starts]).tolist(), ends.tolist())
        q *= 2
    out = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _found(texts: list[str | None], least: int, times: int) -> Iterator[list[tuple]]:
    """``n_words, runs, collapsed`` of each text."""
    split = [(t or "").encode("utf-8").split() for t in texts]
    number: dict[bytes, int] = {}
    sizes = [len(words) for words in split]
    words = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, sum(sizes))
    first = np.cumsum([0, *sizes])
    runs: list[list] = [[] for _ in texts]
    doc = np.repeat(np.arange(len(texts)), sizes)
    for a, b in _stretches(words, doc, least, times):
        at = int(doc[a])
        shift = a - int(first[at])
        runs[at] += [(s + shift, length, period) for s, length, period in _runs_of(words[a:b].tolist(), least, times)]
    for words, found in zip(split, runs):
        found.sort(key=lambda r: (r[0], r[2]))
        if found:
            gone = np.zeros(len(words) + 1, np.int64)
            for start, length, period in found:
                gone[start + period] += 1
                gone[start + length] -= 1
            kept = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
        else:
            kept = words
        yield [(len(words), [dict(zip(RUN.names, r)) for r in found], b" ".join(kept).decode("utf-8"))]


def runs(df: DataFrame, keep: list[str], text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``keep`` columns, ``n_words``, ``runs`` (array of start, length, period in words, by start, then period) and ``collapsed``, the
    words outside all runs and those of each run's first period, joined by one space.

    A run is a stretch with smallest period q of at least ``least`` words and ``times`` (2 or more) periods which no neighbouring word
    extends.  Whole texts; null and empty ones have no words, no runs and an empty ``collapsed``.  Rows are independent, so
    repeated rows give repeated results, and other columns are ignored; an empty table gives an
    empty result.  Work is near linear in a text's words, memory in its longest stretch that can hold a run;
    one text is worked on in one task."""
    if times < 2:
        raise ValueError("a run has two periods or more")
    schema = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return map_lists(df, text, keep, schema, lambda: lambda texts: _found(texts, least, times))


def digests(df: DataFrame, keep: list[str], **options) -> DataFrame:
    """``keep`` columns, the number of runs, the run of greatest length / period (ties: smallest start, then period;
    nulls without one) and digests of all runs and of the collapsed text.  Cases as in ``runs``."""
    best = F.reduce(
        "runs", F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    line = lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in RUN.names]), F.lit("\n"))
    return runs(df, keep, **options).select(*keep, "runs", "collapsed", best.alias("best")).select(
        *keep, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose tail repeats itself for a tenth of the documents, by a checksum of the id; other texts, texts
    without words and those of null ids stay as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: (a + (i - a) % p).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, place(i)))), " ")

    words = F.array(word_array(text))
    new = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text)), F.lit(0))
    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), new).otherwise(text)
