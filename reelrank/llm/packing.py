"""Packing along a space-filling curve: neighbouring documents share sequences, and no token is padding.

Every document becomes its token ids and an end id.  The ids are hashed with
signs into ``HASHED`` dimensions (damped counts, unit length), projected to
``AXES`` dimensions by fixed random numbers, cut into cells of a grid, and the
cell's place on the Hilbert curve is the document's key.  Documents are dealt
out by ranges of (key, id, row number) and sorted, so neighbours on the curve
are neighbours in the order; rows of one key, such as copies, are split too.
Only keys and counts are sorted; the ids join their places by row number.
The place of a document's first token is the sum of the tokens before it: each
range sums its own, and the ranges' totals (one number each) are summed over.

Sequences are the order cut at every ``LENGTH`` tokens, so all are full; the
rest, shorter than one sequence, is cut at falling powers of two, which are
not padded either.  A document is cut wherever a sequence ends.

Tokens come from the ``tokenizers`` library.  A task cuts texts at white space
and its new distinct words into letters, digits and signs as the file's
pattern does, has the library encode the new distinct pieces only, and
remembers words and pieces (``MAX_KNOWN``, then it starts again; the memory is
kept for the tasks that a worker process runs later).  A word with a code
point from U+0250 on, or with the text of a special token, and any file with
another normalizer or pattern, is encoded by the library as a whole.

Defined results: a null text is empty; an empty text has the end id alone;
repeated rows are packed each; rows without an id come first on the curve's
ties and are packed like any other; other columns are not read, so their names
cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.bpe import Cutter
from reelrank.llm.tables import shipped, stored

LENGTH = 2048
END = 1
HASHED = 256
AXES = 4
BITS = 12  # cells along an axis: 2**BITS
SPREAD = 3.0  # standard deviations that the grid covers to either side; farther is the last cell
MAX_KNOWN = 500_000
TEXTS = 500  # documents whose pieces are made at once
TEXT_BYTES = 4 << 20  # text whose words are held at once (a longer document is held alone)
TASK_TOKENS = 8 << 20
TASK_ROWS = 1 << 18
_PLAIN_END = 0x250
_LINE = 2000  # pieces encoded in one call


# ------------------------------------------------------------------ tokens

def _gathered(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` (each up to its place in ``ends``) numbered ``at``, one after another, and their ends."""
    starts = np.concatenate(([0], ends[:-1]))
    n = (ends - starts)[at]
    out = np.cumsum(n)
    kind = np.int32 if max(len(flat), out[-1] if len(out) else 0) < 1 << 31 else np.int64
    place = np.repeat((starts[at] - (out - n)).astype(kind), n)
    place += np.arange(len(place), dtype=kind)
    return flat[place], out


def _strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


class Words:
    """Encodes texts by their distinct words; the ids are those of the library on the whole text."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_str(file)
        spec = json.loads(file)
        self.type = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        special = [t["content"] for t in spec["added_tokens"] or []]
        self.cut = None
        pattern = self._known(spec)
        if pattern and not any(set(t) & set(" \t\n\r\v\f") for t in special):
            # a class of one property alone needs no brackets; a line end marks the end of a word
            self.cut = Cutter(pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}") + r"|\n")
            self.other = re.compile("|".join([f"[^\0-{chr(_PLAIN_END - 1)}]", *map(re.escape, special)])).search
            self.plain = Tokenizer.from_str(file)
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            suffix, vocab = spec["model"]["end_of_word_suffix"], self.whole.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    @staticmethod
    def _known(spec: dict) -> str | None:
        """The pattern of a file that lower-cases and cuts each word by itself, with marked word ends; else None."""
        norm, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
        kinds = [n["type"] for n in norm.get("normalizers", [])]
        steps = pre.get("pretokenizers", [])
        fits = (kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in steps] == ["Split", "ByteLevel"]
                and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and model["type"] == "BPE"
                and model.get("end_of_word_suffix") and not model.get("dropout") and not spec.get("post_processor"))
        return steps[0]["pattern"].get("Regex") if fits else None

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.type).tobytes()

    def _flat(self, known: dict[str, bytes], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``names`` one after another, and where each one's end."""
        held = list(map(known.__getitem__, names))
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held))) // self.type().itemsize
        return np.frombuffer(b"".join(held) or bytearray(), dtype=self.type), ends

    def _learn(self, words: list[str]) -> None:
        other = [w for w in words if self.other(w)]
        for w, e in zip(other, self.whole.encode_batch(other, add_special_tokens=False)):
            self.words[w] = self._ids(e.ids)
        if other:
            known = set(other)
            words = [w for w in words if w not in known]
        # all words in one string, cut at once: their pieces, and a line end after each word
        cut = pa.array(self.cut("\n".join([*words, ""]).lower()), pa.string()).dictionary_encode()
        names = _strings(cut.dictionary)
        self._learn_pieces([p for p in names if p != "\n" and p not in self.pieces])
        self.pieces["\n"] = b""
        at = cut.indices.to_numpy()
        flat, ends = _gathered(*self._flat(self.pieces, names), at)
        size, flat = self.type().itemsize, flat.tobytes()
        of = (size * ends[at == names.index("\n")]).tolist() if words else []
        self.words |= {w: flat[s:e] for w, s, e in zip(words, [0, *of], of)}

    def _learn_pieces(self, new: list[str]) -> None:
        size = self.type().itemsize
        for a in range(0, len(new), _LINE):
            part = new[a:a + _LINE]
            ids = np.array(self.plain.encode(" ".join(part), add_special_tokens=False).ids, dtype=self.type)
            ends = (size * (np.flatnonzero(self.last[ids]) + 1)).tolist()  # each piece's last token is marked as such
            if len(ends) != len(part):
                self.pieces |= {p: self._ids(self.plain.encode(p, add_special_tokens=False).ids) for p in part}
                continue
            flat = ids.tobytes()
            self.pieces |= {p: flat[s:e] for p, s, e in zip(part, [0, *ends], ends)}

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = texts.fill_null("")
        if self.cut is None:
            return [np.array(e.ids, dtype=self.type) for e in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        # these separators are white space to every part; other white space is left to the pattern
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        names = _strings(words.dictionary)
        if len(self.words) > MAX_KNOWN or len(self.pieces) > MAX_KNOWN:
            self.words, self.pieces = {}, {}
        known = self.words
        self._learn([w for w in names if w not in known])
        ids, ends = _gathered(*self._flat(known, names), words.indices.to_numpy())
        bounds = np.concatenate(([0], ends))[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _words(file: str) -> Words:
    """The encoder of this worker process: what it knows serves the later tasks too."""
    held = sys.modules.setdefault("reelrank_known_words", types.ModuleType("reelrank_known_words"))
    if getattr(held, "file", None) != file:
        held.words, held.file = Words(file), file
    return held.words


# ------------------------------------------------------------------ the curve

def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows x axes, each below ``2**bits``)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of the larger cubes, from the largest down
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << b), (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Curve:
    """Curve keys of documents from their token ids."""

    def __init__(self, size: int, hashed: int = HASHED, axes: int = AXES, bits: int = BITS, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.slot = rng.integers(0, hashed, size)
        self.sign = rng.integers(0, 2, size) * 2.0 - 1
        self.project = rng.standard_normal((hashed, axes))
        self.bits = bits

    def vector(self, ids: np.ndarray) -> np.ndarray:
        """Hashed vector of unit length (zero without tokens): signed counts, damped by the logarithm."""
        v = np.bincount(self.slot[ids], weights=self.sign[ids], minlength=len(self.project))
        v = np.sign(v) * np.log1p(np.abs(v))
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        if not documents:
            return np.zeros(0, dtype=np.int64)
        p = np.stack([self.vector(d) for d in documents]) @ self.project
        top = (1 << self.bits) - 1
        cells = np.clip(np.floor((p / SPREAD + 1) / 2 * (top + 1)), 0, top).astype(np.int64)
        return hilbert(cells, self.bits)


# ------------------------------------------------------------------ the packing

def id_type(file: str) -> str:
    """Two bytes for each id where the vocabulary allows it, else four."""
    return np.dtype(Words(file).type).newbyteorder("<").str


def encoded(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """``doc_id, key, n, ids``: the ids of each document with the end id (:func:`id_type`), and its curve key."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    get = shipped(docs.sparkSession, file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(get())
        curve = Curve(words.whole.get_vocab_size())
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            a = 0
            while a < batch.num_rows:
                done = int(sizes[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(sizes, done + TEXT_BYTES, side="right")))
                part, a = batch.slice(a, b - a), b
                ids = words(part.column(1))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(curve.keys(ids)), pa.array([len(i) + 1 for i in ids], pa.int64()),
                    pa.array([np.append(i, words.type(end)).tobytes() for i in ids], pa.binary())],
                    names=["doc_id", "key", "n", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key long, n long, ids binary")


def ordered(documents: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, ids, n`` with ``place``, the number of tokens before the document along the curve; and all tokens.

    Only (key, id, row, n) is sorted and summed; the ids, written once, are dealt out once to meet their place.
    """
    rows = stored(documents.withColumn("row", F.monotonically_increasing_id()), "packing-tokens")
    total, n = rows.agg(F.sum("n"), F.count("*")).first()
    tasks = documents.sparkSession.sparkContext.defaultParallelism
    parts = int(max(1, -(-n // TASK_ROWS), min(tasks, n // 1000)))
    dealt = rows.select("key", "doc_id", "row", "n").repartitionByRange(parts, "key", "doc_id", "row")
    dealt = dealt.sortWithinPartitions("key", "doc_id", "row").select("row", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = before + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(ends - n)],
                names=["row", "n", "part", "inside"])
            before = int(ends[-1]) if len(n) else before

    sums = stored(dealt.mapInArrow(run, "row long, n long, part int, inside long"), "packing-order")
    # one row for each range of TASK_ROWS documents
    ranges = sums.groupBy("part").agg(F.sum("n").alias("tokens")).withColumn("before", F.coalesce(F.sum("tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    places = sums.join(ranges, "part").select("row", (F.col("before") + F.col("inside")).alias("place"))
    return rows.join(places.hint("shuffle_hash"), "row").select("doc_id", "ids", "n", "place"), total or 0


def tail_cuts(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one begin, and the end: lengths are falling powers of two."""
    at = total // length * length
    cuts = [at]
    for b in range(length.bit_length() - 1, -1, -1):
        if total - at & 1 << b:
            at += 1 << b
            cuts.append(at)
    return cuts


def pieces_of(start: int, end: int, length: int, tail: list[int]) -> list[tuple[int, int, int, int]]:
    """``(from, to, sequence, offset)`` of the tokens ``start`` to ``end`` of the order."""
    full = tail[0]
    out, at = [], start
    while at < end:
        if at < full:
            sequence, first = at // length, at // length * length
            stop = min(end, first + length)
        else:
            i = next(k for k in range(len(tail) - 1) if at < tail[k + 1])
            sequence, first = full // length + i, tail[i]
            stop = min(end, tail[i + 1])
        out.append((at, stop, sequence, at - first))
        at = stop
    return out


def pack(docs: DataFrame, file: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text",
         end: int = END) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of every piece of every document.

    ``file`` is the text of a ``tokenizers`` JSON file; ``ids`` are 32-bit little-endian numbers.
    """
    spark = docs.sparkSession
    along, total = ordered(encoded(docs, file, doc_id, text, end))
    kind, tail = id_type(file), tail_cuts(total, length)
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, place = batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for a in range(0, batch.num_rows, TEXTS):
                out, at = [], []
                for i in range(a, min(a + TEXTS, batch.num_rows)):
                    flat = np.frombuffer(ids[i].as_py(), dtype=kind).astype("<u4").tobytes()
                    for s, e, sequence, offset in pieces_of(place[i], place[i] + n[i], length, tail):
                        first = s - place[i]
                        out.append((first, e - s, flat[4 * first:4 * (first + e - s)], n[i], sequence, offset))
                        at.append(i)
                types_ = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at, pa.int64())),
                    *[pa.array([r[c] for r in out], t) for c, t in enumerate(types_)]], names=names)

    return along.mapInArrow(
        run, f"doc_id {along.schema['doc_id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n, ids``: the packed sequences; a group holds at most one sequence's tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), parts.alias("p"))
            .select("sequence_id", "n", F.aggregate("p", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids")))
