"""Byte-level BPE by monoid tree reduction.

A text's tokens are the product of its parts' tokens under a join: halves are encoded on
their own, and the join re-encodes a growing window around the seam until the
tokens at both window ends come out unchanged.

Why that is right: a token sequence is the encoding of its bytes if and only if every
two neighbours in it are the encoding of their own bytes.  Inside the window that
holds because the window was encoded; outside it held before; and where the window meets the
rest the pair is unchanged, because the window's end tokens are.
"""

import base64
import hashlib
import heapq
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.batches import map_lists, map_rows

#: Bytes up to which a part is a leaf, merged directly.
LEAF = 4
#: Bytes up to which windows are merged together, step by step; a heap serves each longer one.
SHORT = 64
#: Above every rank.
NONE = 1 << 40
#: Bytes of pieces and ids that a worker remembers before it starts over, and bytes an entry takes
#: besides.  Results do not depend on it.
REMEMBERED, ENTRY = 128 << 20, 200
#: Ids decoded at a leaf of the tree.
DECODE_LEAF = 64

DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class Tokenizer:
    """Encodes and decodes with the given ranks; ``pattern`` cuts a text into pieces that
    are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self._held = 0
        #: Joins of two parts so far.
        self.joins = 0
        size = len(ranks)
        lengths = [len(self.tokens.get(i, b"")) for i in range(max(self.tokens, default=-1) + 1)]
        self._length = np.array(lengths, np.int64)
        self._start = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(self.tokens[i] for i in sorted(self.tokens)), np.uint8)
        self._byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = sorted(
            (ranks[t[:i]] * size + ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        )
        self._pair = np.array([k for k, _ in pairs] or [-1], np.int64)
        self._pair_rank = np.array([r for _, r in pairs] or [NONE], np.int64)

    def merge(self, data: bytes) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none is in the ranks."""
        size = len(data)
        ranks = self.ranks
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = [True] * size
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= stop:
                continue
            right = end[i]
            if right >= size or end[right] != stop:
                continue
            alive[right] = False
            end[i] = stop
            if stop < size:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(data[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < size:
            out.append(data[i : end[i]])
            i = end[i]
        return out

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.ranks) + right
        at = np.minimum(np.searchsorted(self._pair, key), len(self._pair) - 1)
        return np.where(self._pair[at] == key, self._pair_rank[at], NONE)

    def _merged(self, ids: np.ndarray, leaf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each of ``n`` leaves, from the leaves' single bytes: in each step every leaf
        that still has a pair in the ranks merges its lowest, leftmost one."""
        rank = np.full(len(ids), NONE, np.int64)
        rank[:-1] = np.where(leaf[:-1] == leaf[1:], self._ranks_of(ids[:-1], ids[1:]), NONE)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            first = np.flatnonzero(np.diff(leaf, prepend=-1))
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(first, append=len(ids))
            if (lowest == NONE).mean() > 0.3:
                open_ = np.repeat(lowest < NONE, length)
                done.append((leaf[~open_], ids[~open_]))
                ids, leaf, rank = ids[open_], leaf[open_], rank[open_]
                continue
            at = np.flatnonzero((rank == np.repeat(lowest, length)) & (rank < NONE))
            at = at[np.diff(leaf[at], prepend=-1) > 0]
            ids[at] = rank[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))
            ids, leaf, rank = ids[keep], leaf[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                i = i[i < len(ids) - 1]
                same = leaf[i] == leaf[i + 1]
                rank[i] = np.where(same, self._ranks_of(ids[i], ids[i + 1]), NONE)
            if len(ids) and at[-1] == len(ids) - 1:
                rank[-1] = NONE
        if not done:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        leaf, ids = (np.concatenate(x) for x in zip(*done))
        return ids[np.argsort(leaf, kind="stable")], np.bincount(leaf, minlength=n)

    def _windows(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows' tokens encoded anew from their bytes: ids of all windows and the number in each."""
        length = self._length[ids]
        owner = np.repeat(np.arange(len(size)), size)
        n_bytes = np.bincount(owner, length, len(size)).astype(np.int64)
        data = self._bytes[_ranges(self._start[ids], length)]
        if n_bytes.max(initial=0) <= SHORT:
            return self._merged(self._byte[data], np.repeat(owner, length), len(size))
        long = n_bytes > SHORT
        from_ = np.cumsum(n_bytes) - n_bytes
        few = np.repeat(~long, n_bytes)
        owners = np.repeat(np.arange(len(size)), n_bytes)
        out, count = self._merged(self._byte[data[few]], owners[few], len(size))
        pieces, bounds = [], np.concatenate([[0], np.cumsum(count)])
        last = 0
        for i in np.flatnonzero(long).tolist():
            whole = data[from_[i] : from_[i] + n_bytes[i]].tobytes()
            found = np.array([self.ranks[t] for t in self.merge(whole)], np.int64)
            count[i] = len(found)
            pieces += [out[last : bounds[i]], found]
            last = bounds[i]
        return np.concatenate([*pieces, out[last:]]), count

    def joined(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts 0 and 1, 2 and 3, ... joined: ``size`` holds the number of tokens of each part, ``ids``
        all of them in order.

        The window around every seam begins with one token on each side and doubles where its end
        tokens did not come out unchanged, until they do or the window holds the part's end."""
        end = np.cumsum(size)
        seam, left, right = end[0::2], size[0::2], size[1::2]
        n = len(seam)
        self.joins += n
        a, b = np.minimum(1, left), np.minimum(1, right)
        source, at = [ids], len(ids)
        window_at, window_n = np.zeros(n, np.int64), np.zeros(n, np.int64)
        todo, width = np.arange(n), 1
        while len(todo):
            x, y, s = a[todo], b[todo], seam[todo]
            found, count = self._windows(ids[_ranges(s - x, x + y)], x + y)
            first = np.cumsum(count) - count
            source.append(found)
            window_at[todo], window_n[todo] = at + first, count
            at += len(found)
            firm = (x == left[todo]) | (found[first] == ids[s - x])
            firm &= (y == right[todo]) | (found[first + count - 1] == ids[s + y - 1])
            todo, width = todo[~firm], width * 2
            a[todo], b[todo] = np.minimum(width, left[todo]), np.minimum(width, right[todo])
        starts = np.stack([seam - left, window_at, seam + b], 1).ravel()
        sizes = np.stack([left - a, window_n, right - b], 1)
        return np.concatenate(source)[_ranges(starts, sizes.ravel())], sizes.sum(1)

    def reduce(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece (none empty): a binary tree over its bytes, halved down to leaves of ``LEAF``
        bytes at most, whose nodes are joined level by level, those of all pieces together."""
        if not pieces:
            return []
        n_bytes = np.array([len(x) for x in pieces], np.int64)
        parts = np.ones(len(pieces), np.int64)
        while (wide := parts * LEAF < n_bytes).any():
            parts[wide] *= 2
        piece = np.repeat(np.arange(len(pieces)), parts)
        nth = _ranges(np.zeros(len(pieces), np.int64), parts)
        cut = lambda i: n_bytes[piece] * i // parts[piece]
        data = self._byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ids, size = self._merged(data, np.repeat(np.arange(len(piece)), cut(nth + 1) - cut(nth)), len(piece))
        out: list[bytes] = [b""] * len(pieces)
        open_ = np.arange(len(pieces))
        while len(open_):
            whole = parts[open_] == 1
            of_whole = np.repeat(whole, parts[open_])
            of_ids = np.repeat(of_whole, size)
            packed = ids[of_ids].astype("<u4").tobytes()
            stops = (4 * np.cumsum(size[of_whole])).tolist()
            for i, start, stop in zip(open_[whole].tolist(), [0, *stops], stops):
                out[i] = packed[start:stop]
            open_ = open_[~whole]
            if len(open_):
                ids, size = self.joined(ids[~of_ids], size[~of_whole])
                parts[open_] //= 2
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Encode pieces into the memory.  A piece that is a token is that token."""
        others, parts = [], []
        for piece in pieces:
            data = piece.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is not None:
                self._known[piece] = rank.to_bytes(4, "little")
            else:
                others.append(piece)
                parts.append(data)
        self._known.update(zip(others, self.reduce(parts)))
        self._held += sum(ENTRY + len(x) + len(self._known[x]) for x in pieces)

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers.  Between pieces nothing
        merges, so there the join is concatenation."""
        cut = [self.pieces(text) for text in texts]
        if self._held > REMEMBERED:
            self._known.clear()
            self._held = 0
        self._learn(set().union(*cut).difference(self._known))
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in cut]

    def encode(self, text: str) -> list[int]:
        return unpack(self.encode_packed([text])[0]).tolist()

    def decode(self, ids) -> bytes:
        """The bytes of the ids: those of leaves of ``DECODE_LEAF`` ids, concatenated two by two up the tree."""
        ids = np.asarray(ids).tolist()
        token = self.tokens.__getitem__
        parts = [b"".join(map(token, ids[i : i + DECODE_LEAF])) for i in range(0, len(ids), DECODE_LEAF)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4")


@lru_cache(maxsize=2)
def tokenizer_at(path: str, pattern: str) -> Tokenizer:
    """One tokenizer for all tasks of a Python worker."""
    return Tokenizer(load_ranks(path), pattern)


def _per_task(path: str, pattern: str, use: Callable) -> Callable:
    def make():
        tokenizer = tokenizer_at(path, pattern)
        return lambda texts: (
            [use(tokenizer, packed)]
            for packed in tokenizer.encode_packed([text or "" for text in texts])
        )

    return make


def _digest(tokenizer: Tokenizer, packed: bytes) -> tuple:
    decoded = tokenizer.decode(unpack(packed))
    return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode(df: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) to the ``keep`` columns.

    One output row per input row, repeated rows included.  Null and empty texts give an
    empty array; texts of any length are encoded whole, a long piece in n log n steps.  An empty
    table gives an empty table.  No shuffle.  ``path`` must be readable on every
    executor, as an installed vocabulary file is."""
    make = _per_task(path, pattern, lambda _, packed: (unpack(packed).tolist(),))
    return map_lists(df, text, keep, IDS, make)


def decode(df: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """Add ``text``, the decoded string of ``ids`` (null: empty).  Bytes that are not UTF-8
    come out as the replacement character; an id that is not in the ranks is an error."""
    out = T.StructType([T.StructField("text", T.StringType())])

    def make():
        tokenizer = tokenizer_at(path, pattern)
        return lambda x: [(tokenizer.decode(x or []).decode("utf-8", "replace"),)]

    return map_rows(df, ids, keep, out, make)


def digests(df: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Encode each text, decode the ids again, and give ``n_tokens``, the SHA-256 of the
    ids (little-endian unsigned 32 bit) and that of the decoded bytes.  Rows as in ``encode``."""
    return map_lists(df, text, keep, DIGEST, _per_task(path, pattern, _digest))
