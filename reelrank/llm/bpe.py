"""Byte-level BPE: distinct pieces of a task are encoded by folding ranked merges over their bytes; decoding joins bytes.

A text is cut by the vocabulary's pattern; each piece that is a token of its
own is one id, and any other starts as its bytes and merges, again and again,
the leftmost pair of the least rank, until no pair has a rank.  The fold runs
over all new distinct pieces of a batch at once, as a matrix of ids with a
matrix of the ranks of neighbours (two looked up anew after each merge).
Tasks remember the pieces they have encoded, up to ``MAX_KNOWN``.  The rank
table comes from the driver (a fixed vocabulary file).  No shuffle.

Defined results: a null text is empty and has no ids; repeated rows give equal
rows; unpaired surrogates cannot occur in UTF-8 columns; ids that the
vocabulary lacks fail on decoding; columns with the names of the results are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reelrank.llm.tables import shipped, without

MAX_KNOWN = 200_000
ROWS = 250  # texts whose pieces are held at once
_NONE = np.int32(1 << 30)
_WIDTHS = (8, 12, 16, 24, 32, 64)
_PLAIN_END = 0x250  # code points below this one have settled classes in every Unicode version


def plain_pattern(pattern: str) -> str | None:
    """``pattern`` for texts of code points below U+0250 only, with its classes spelled out; None if that is not possible.

    Plain classes need no property lookups, which makes the cut several times
    as fast on the texts that have nothing else.
    """
    def of(test) -> str:
        return "".join(re.escape(chr(c)) for c in range(_PLAIN_END) if test(chr(c)))

    letters, numbers = of(lambda c: unicodedata.category(c)[0] == "L"), of(lambda c: unicodedata.category(c)[0] == "N")
    spaces = r"\t-\r \x85\xa0"
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for name, inside in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{spaces}]"), (r"\S", f"[^{spaces}]")):
        out = out.replace(name, inside)
    return None if r"\p" in out else out


class Cutter:
    """Cuts texts into the pieces of a pattern."""

    def __init__(self, pattern: str):
        plain = plain_pattern(pattern)
        self.any = regex.compile(pattern).findall
        self.plain = re.compile(plain).findall if plain else self.any
        self.other = re.compile(f"[^\0-{chr(_PLAIN_END - 1)}]").search

    def __call__(self, text: str) -> list[str]:
        return self.any(text) if self.other(text) else self.plain(text)


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that makes a token."""

    def __init__(self, lines: bytes, pattern: str):
        self.pattern = pattern
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        self.tokens = {i: t for t, i in self.ranks.items()}
        # all tokens one after another, and where each begins
        listed = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.sizes = np.array([len(t) for t in listed])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(listed), dtype=np.uint8)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        pairs = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], rank) for t, rank in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        # an open table: a pair sits at its hash or soon after; the longest way is known
        self.bits = max(8, (4 * len(pairs)).bit_length())  # at most half full, at any number of pairs
        self.table = np.full(1 << self.bits, -1, dtype=np.int64)
        self.table_ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        self.steps = 0
        keys, ranks = np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):  # of the pairs that want a free place one gets it, the others go on to the next
            free = left[self.table[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.table[at[won]], self.table_ranks[at[won]] = keys[won], ranks[won]
            left = np.setdiff1d(left, won)
            at[left] = (at[left] + 1) & (len(self.table) - 1)
            self.steps += 1

    def _place(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; a large number if they make no token (or one is below zero)."""
        shape, key = left.shape, (left.astype(np.int64) << 32 | right.astype(np.int64)).reshape(-1)
        at = self._place(key)
        found = self.table[at]
        out = np.where(found == key, self.table_ranks[at], _NONE)
        left_over = np.flatnonzero((found != key) & (found >= 0))
        for _ in range(1, self.steps):
            if not len(left_over):
                break
            at[left_over] = (at[left_over] + 1) & (len(self.table) - 1)
            found = self.table[at[left_over]]
            hit = found == key[left_over]
            out[left_over[hit]] = self.table_ranks[at[left_over[hit]]]
            left_over = left_over[~hit & (found >= 0)]
        out[key < 0] = _NONE
        return out.reshape(shape)

    def _fold(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Merged ids, as 32-bit integers one after another, of pieces of at most ``width`` bytes."""
        n = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width + 1), -1, dtype=np.int32)
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ids[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = self.bytes[flat]
        ranks = np.full((len(pieces), width + 1), _NONE, dtype=np.int32)
        ranks[:, :width] = self.rank(ids[:, :-1], ids[:, 1:])
        done: list = [None] * len(pieces)
        rows, columns = np.arange(len(pieces)), np.arange(width + 1)
        while len(rows):
            j = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), j]
            ended = least == _NONE
            raw, step = ids[ended].tobytes(), 4 * (width + 1)
            for i, (r, m) in enumerate(zip(rows[ended].tolist(), n[ended].tolist())):
                done[r] = raw[i * step:i * step + 4 * m]
            rows, ids, ranks, n, j, least = (x[~ended] for x in (rows, ids, ranks, n, j, least))
            if not len(rows):
                break
            line = np.arange(len(rows))
            moved = columns[None, :-1] > j[:, None]
            np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=moved)
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=moved)
            ids[line, j] = least
            n = n - 1
            ranks[line, j] = self.rank(ids[line, j], ids[line, np.minimum(j + 1, width)])
            before = j > 0
            ranks[line[before], j[before] - 1] = self.rank(ids[line[before], j[before] - 1], least[before])
        return done

    def _long(self, piece: bytes) -> bytes:
        """Merged ids of one piece of any length: a heap of pairs over a linked list."""
        ids = [int(x) for x in self.bytes[np.frombuffer(piece, dtype=np.uint8)]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        text = [bytes([c]) for c in piece]
        heap = [(r, i, 2) for i in range(len(ids) - 1) if (r := self.ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, size = heapq.heappop(heap)
            j = after[i] if text[i] is not None else len(ids)
            if j >= len(ids) or text[j] is None or len(text[i]) + len(text[j]) != size:
                continue  # one of the two has merged meanwhile
            text[i], text[j], ids[i] = text[i] + text[j], None, rank
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(ids)
                if b < len(ids) and (r := self.ranks.get(text[a] + text[b])) is not None:
                    heapq.heappush(heap, (r, a, len(text[a]) + len(text[b])))
        return np.array([x for x, t in zip(ids, text) if t is not None], dtype=np.int32).tobytes()

    def encode(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece, as 32-bit integers one after another."""
        out, left, whole = {}, {w: ([], []) for w in _WIDTHS}, self.ranks.get
        groups = [left[next(w for w in _WIDTHS if n <= w)] for n in range(_WIDTHS[-1] + 1)]
        for p in pieces:
            raw = p.encode()
            known = whole(raw)
            if known is not None:
                out[p] = known.to_bytes(4, sys.byteorder)
            elif len(raw) >= len(groups):
                out[p] = self._long(raw)
            else:
                names, bytes_ = groups[len(raw)]
                names.append(p)
                bytes_.append(raw)
        for width, (names, bytes_) in left.items():
            for a in range(0, len(names), 50_000):
                out.update(zip(names[a:a + 50_000], self._fold(bytes_[a:a + 50_000], width)))
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of lists of ids: list i has the ids before ``ends[i]`` that list i - 1 has not."""
        if not len(ids):
            return [b""] * len(ends)
        if ids.min() < 0 or ids.max() >= len(self.sizes) or (self.sizes[ids] == 0).any():
            raise ValueError("ids that the vocabulary lacks")
        size = self.sizes[ids]
        last = np.cumsum(size)
        raw = self.flat[np.arange(last[-1]) + np.repeat(self.first[ids] - last + size, size)].tobytes()
        cuts = np.concatenate(([0], last))[ends].tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]


def load(path: str, pattern: str) -> Vocabulary:
    """Vocabulary from a rank file (a token in base 64 and its rank on each line); the file is on the driver."""
    with open(path, "rb") as f:
        return Vocabulary(f.read(), pattern)


def _with(docs: DataFrame, fields: list[T.StructField], drop: str | None = None) -> T.StructType:
    return T.StructType([*[f for f in docs.schema.fields if f.name != drop], *fields])


def _encoder(load: Callable[[], Vocabulary], text: str, ids: str, drop: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = load(), {}
        find = Cutter(vocab.pattern)
        for batch in (x.slice(a, ROWS) for x in batches for a in range(0, x.num_rows, ROWS)):
            pieces = [find(t) if t else [] for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            new = set(chain.from_iterable(pieces)) - known.keys()
            if len(known) + len(new) > MAX_KNOWN:
                known, new = {}, set(chain.from_iterable(pieces))
            known.update(vocab.encode(list(new)))
            get = known.__getitem__
            lists = [b"".join(map(get, p)) for p in pieces]
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in lists]))).astype(np.int32)
            column = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(lists), dtype=np.int32)))
            kept = [i for i, x in enumerate(batch.schema.names) if x != drop]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], column],
                                             names=[*[batch.schema.names[i] for i in kept], ids])

    return run


def _decoder(load: Callable[[], Vocabulary], ids: str, to: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = load()
        for batch in (x.slice(a, ROWS) for x in batches for a in range(0, x.num_rows, ROWS)):
            lists = batch.column(batch.schema.get_field_index(ids))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            found = vocab.decode(pc.list_flatten(lists).to_numpy(zero_copy_only=False), ends)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, to])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", keep_text: bool = False) -> DataFrame:
    """``docs`` with the ids of column ``text`` in column ``ids`` (the text itself goes unless ``keep_text``)."""
    drop, docs = None if keep_text else text, without(docs, ids, keep=text)
    run = _encoder(shipped(docs.sparkSession, vocabulary), text, ids, drop)
    return docs.mapInArrow(run, _with(docs, [T.StructField(ids, T.ArrayType(T.IntegerType()))], drop))


def decode(coded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``coded`` with the bytes that its ids stand for in column ``to``."""
    coded = without(coded, to, keep=ids)
    run = _decoder(shipped(coded.sparkSession, vocabulary), ids, to)
    return coded.mapInArrow(run, _with(coded, [T.StructField(to, T.BinaryType())]))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", to: str = "decoded") -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass of the same workers."""
    load, docs = shipped(docs.sparkSession, vocabulary), without(docs, ids, to, keep=text)
    first, second = _encoder(load, text, ids, text), _decoder(load, ids, to)
    schema = _with(docs, [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(to, T.BinaryType())], text)
    return docs.mapInArrow(lambda batches: second(first(batches)), schema)
