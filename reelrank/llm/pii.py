"""Personal data: base patterns, and further spans from a semi-Markov conditional random field.

Base spans (e-mail, ip, card, phone) come from fixed patterns, per kind
leftmost and not overlapping, with checks of ranges, lengths and the Luhn sum.
They always stay.

The field looks at islands: consecutive tokens with a digit or an at sign.  An
island is cut into pieces (digit runs, letter runs, single other characters).
A segmentation covers the pieces with single "other" pieces and with entities
of one to ``MAX_PIECES`` pieces.  Each candidate entity is scored as a whole
(number and grouping of its digits, Luhn sum, number ranges, separators,
noise characters, what touches its edges), and each pair of neighbouring
labels has a score.  Forward and backward sums over all segmentations give the
likelihood for training and each entity's probability; the best segmentation
chooses boundaries and kinds together.  An entity is added if it overlaps no
base span, the best segmentation has it and its probability is at least
``LEAST``.  An island is decoded whole however long it is: the features of a
long one are made for ``CHUNK_PIECES`` pieces at a time, once for the sums from
the left and once for those from the right, and only its sums stay.

The field is trained on at most ``MAX_ISLANDS`` islands of the corpus of at
most ``MAX_ISLAND_CHARS`` characters (the first by a hash) whose labels are the base spans, and on copies of those
islands with noise characters after their tokens.  Islands that are noisy
themselves are left out, as the base patterns cannot label them.

Texts are searched whole, in place, without a shuffle.  Defined results: a
null or empty text has no spans; repeated rows give equal rows; with no island
to train on nothing is added; a column with the name of the result is replaced;
an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm.tables import shipped, without

KINDS = ("email", "ip", "card", "phone")
MAX_PIECES = 24
MAX_ISLANDS = 3000
MAX_ISLAND_CHARS = 200  # of an island to train on
CHUNK_PIECES = 512  # of a long island at a time
LEAST = 0.9
STEPS = 80
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match fails from all places in a digit run or from none
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ISLAND = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*(?:[^\S\n]{1,2}[^\s0-9@]*+[0-9@]\S*)*")
_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")
_NOISE = frozenset("#*$%&|<>!?~^=")


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        v = int(x) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the base patterns, by kind and start; code points."""
    out = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 40 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def _log_sum(values: list[float]) -> float:
    most = max(values, default=-math.inf)
    return most if most == -math.inf else most + math.log(sum(math.exp(v - most) for v in values))


class Island:
    """Pieces of an island and its candidate entities with their whole-span features."""

    def __init__(self, text: str):
        self.text = text
        cuts = [m.span() for m in _PIECE.finditer(text)]
        self.starts, self.ends = [a for a, _ in cuts], [b for _, b in cuts]
        pieces = [text[a:b] for a, b in cuts]
        self.other = [self._piece(p) for p in pieces]
        self.candidates: list[tuple[int, int, tuple[str, ...]]] = []
        n_digits = [len(p) if "0" <= p[0] <= "9" else 0 for p in pieces]
        letters, spaces = [any(map(str.isalpha, p)) for p in pieces], [p.isspace() for p in pieces]
        for i, p in enumerate(pieces):
            if not (p[0].isalnum() or p in "+("):
                continue
            digits = at = lettered = spaced = 0
            for j in range(i + 1, min(len(pieces), i + MAX_PIECES) + 1):
                digits += n_digits[j - 1]
                at += pieces[j - 1] == "@"
                lettered |= letters[j - 1]
                spaced |= spaces[j - 1]
                if at > 1 or at and spaced:
                    break
                if pieces[j - 1][0].isalnum() and (at or not lettered and 4 <= digits <= 19):
                    found = self._features(i, j)
                    if found:
                        self.candidates.append((i, j, found))

    @staticmethod
    def _piece(p: str) -> tuple[str, ...]:
        kind = "digits" if p[0].isdigit() else "letters" if p[0].isalpha() else "noise" if p in _NOISE else "space" if p.isspace() else p
        return (f"o:{kind}", f"o:{kind}:{min(len(p), 6)}")

    def _features(self, i: int, j: int) -> tuple[str, ...]:
        a, b = self.starts[i], self.ends[j - 1]
        span = self.text[a:b]
        digits = _digits(span)
        letters, at = any(c.isalpha() for c in span), span.count("@")
        if at > 1 or not at and (letters or not 4 <= len(digits) <= 19) or at and any(c.isspace() for c in span):
            return ()  # no kind can be like this
        groups = re.findall(r"[0-9]+", span)
        calm = "".join(c for c in span if c not in _NOISE)
        between = "".join(sorted(set(re.sub(r"[0-9]|[^\W\d_]", "", calm))))
        shape = re.sub(r"[0-9]+", "9", calm) if not at else ""
        before = self.text[a - 1] if a else " "
        after = self.text[b] if b < len(self.text) else " "
        edge = lambda c: "word" if c.isalnum() else "noise" if c in _NOISE else "space" if c.isspace() else c
        return (
            "bias", f"shape:{shape[:12]}", f"seps:{between}", f"digits:{len(digits)}", f"groups:{min(len(groups), 7)}",
            f"luhn:{len(digits) >= 13 and luhn(digits)}", f"plus:{span[0] == '+'}",
            f"bytes:{len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups) and shape == '9.9.9.9'}",
            f"at:{at}:{bool(at and re.fullmatch(r'[^@]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+', calm))}",
            f"before:{edge(before)}", f"after:{edge(after)}",
            f"phone:{span[0] == '+' and 9 <= len(digits) <= 15}")

    def key(self) -> tuple:
        """Equal for islands that the field cannot tell apart."""
        return (tuple(self.other), tuple(self.candidates))


class Field:
    """Semi-Markov conditional random field; label 0 is "other", label k is ``KINDS[k - 1]``."""

    def __init__(self):
        self.index: dict[tuple[str, int], int] = {}
        self.weights = np.zeros(0)
        self.moves = np.zeros((5, 5))

    def _arcs(self, island: Island, learn: bool) -> list[tuple[int, int, int, list[int]]]:
        """``(start, end, label, features)`` of every possible segment."""
        def of(names, label):
            if learn:
                return [self.index.setdefault((x, label), len(self.index)) for x in names]
            return [i for x in names if (i := self.index.get((x, label))) is not None]

        arcs = [(i, i + 1, 0, of(f, 0)) for i, f in enumerate(island.other)]
        arcs += [(i, j, k, of(f, k)) for i, j, f in island.candidates for k in range(1, 5)]
        return sorted(arcs, key=lambda x: (x[1], x[0], x[2]))

    def _sums(self, arcs: list, n: int) -> tuple[list, list, list, list]:
        """By place and label: log sums of all ways to end there, to enter a segment, to go on after it; segment scores."""
        score = [sum(self.weights[f].tolist()) for *_, f in arcs]
        moves = self.moves.tolist()
        ahead = [[-math.inf] * 5 for _ in range(n + 1)]
        enter = [[-math.inf] * 5 for _ in range(n + 1)]
        back = [[-math.inf] * 5 for _ in range(n + 1)]
        ahead[0][0], enter[0], back[n] = 0.0, list(moves[0]), [0.0] * 5
        done = 0
        for (i, j, k, _), s in zip(arcs, score):  # by end
            while done < i:
                done += 1
                enter[done] = [_log_sum([x + moves[y][z] for y, x in enumerate(ahead[done])]) for z in range(5)]
            ahead[j][k] = _log_sum([ahead[j][k], s + enter[i][k]])
        begun: dict[int, list] = {}
        for (i, j, k, _), s in zip(arcs, score):
            begun.setdefault(i, []).append((j, k, s))
        for i in range(n - 1, -1, -1):
            into = [-math.inf] * 5
            for k in range(5):
                into[k] = _log_sum([s + back[j][k] for j, label, s in begun[i] if label == k])
            back[i] = [_log_sum([moves[y][k] + into[k] for k in range(5)]) for y in range(5)]
        return ahead, enter, back, score

    def _chances(self, arcs: list, n: int) -> tuple[list, float, list, list, list]:
        """The probability of each segment, and the sums it comes from."""
        ahead, enter, back, score = self._sums(arcs, n)
        whole = _log_sum(ahead[n])
        return [math.exp(enter[i][k] + s + back[j][k] - whole) for (i, j, k, _), s in zip(arcs, score)], whole, ahead, back, score

    def train(self, samples: list[tuple[Island, list[tuple[int, int, int]], int]], steps: int = STEPS, rate: float = 1.0,
              penalty: float = 1e-3) -> Field:
        """Gradient ascent (with a running scale by feature) on the log likelihood of labelled islands and their counts."""
        known = [(self._arcs(x, True), len(x.other), set(gold), count) for x, gold, count in samples]
        self.weights = np.zeros(len(self.index))
        total = sum(c for *_, c in known)
        scale, move_scale = np.full(len(self.index), 1e-8), np.full((5, 5), 1e-8)
        for _ in range(steps if total else 0):
            step, moves, own = -penalty * self.weights, -penalty * self.moves, self.moves.tolist()
            for arcs, n, gold, count in known:
                chance, whole, ahead, back, score = self._chances(arcs, n)
                share, last = count / total, 0
                for (i, j, k, f), p, s in zip(arcs, chance, score):
                    hit = (i, j, k) in gold
                    if abs(hit - p) > 1e-9:
                        for x in f:
                            step[x] += share * (hit - p)
                        for y, x in enumerate(ahead[i]):
                            moves[y, k] -= share * math.exp(x + own[y][k] + s + back[j][k] - whole)
                    if hit:
                        moves[last, k] += share
                        last = k
            scale += step * step
            move_scale += moves * moves
            self.weights = self.weights + rate * step / np.sqrt(scale)
            self.moves = self.moves + rate * moves / np.sqrt(move_scale)
        return self

    def entities(self, island: Island) -> list[tuple[int, int, int, float]]:
        """``(start piece, end piece, label, probability)`` of the entities of the best segmentation."""
        n, arcs = len(island.other), self._arcs(island, False)
        chance, _, _, _, score = self._chances(arcs, n)
        best, via = np.full((n + 1, 5), -np.inf), {}
        best[0, 0] = 0.0
        for x, ((i, j, k, _), s) in enumerate(zip(arcs, score)):
            last = int(np.argmax(best[i] + self.moves[:, k]))
            got = best[i, last] + self.moves[last, k] + s
            if got > best[j, k]:
                best[j, k], via[j, k] = got, (x, last)
        out, at, k = [], n, int(np.argmax(best[n]))
        while at:
            x, last = via[at, k]
            i, j, label, _ = arcs[x]
            if label:
                out.append((i, j, label, float(chance[x])))
            at, k = i, last
        return out[::-1]


    def long_entities(self, text: str) -> Iterator[tuple[int, int, int, float]]:
        """:meth:`entities` of an island of any length, as ``(start, end, label, probability)`` in characters."""
        cuts = array("q", [0])
        cuts.extend(m.end() for m in _PIECE.finditer(text))
        n = len(cuts) - 1

        def arcs_from(first: int, last: int) -> dict[int, list[tuple[int, int, float]]]:
            """``(end, label, score)`` of the segments that start at each of some pieces; a piece more on each side is
            there for what touches their edges."""
            low, high = max(0, first - 1), min(n, last + MAX_PIECES + 1)
            begun: dict[int, list] = {}
            for i, j, k, f in self._arcs(Island(text[cuts[low]:cuts[high]]), False):
                if first <= low + i < last:
                    begun.setdefault(low + i, []).append((low + j, k, sum(self.weights[f].tolist())))
            return begun

        moves = self.moves.tolist()
        parts = [(a, min(n, a + CHUNK_PIECES)) for a in range(0, n, CHUNK_PIECES)]
        enter, via = array("d"), bytearray(10 * (n + 1))  # sums to enter a label at a place; pieces and label before it
        ahead: dict[int, list] = {0: [0.0] + [-math.inf] * 4}
        best: dict[int, list] = {0: [0.0] + [-math.inf] * 4}
        for first, last in parts:
            begun = arcs_from(first, last)
            for i in range(first, last):
                sums, most = ahead.pop(i), best.pop(i)
                into = [_log_sum([x + moves[y][z] for y, x in enumerate(sums)]) for z in range(5)] if i else list(moves[0])
                enter.extend(into)
                before = [max(range(5), key=lambda y: most[y] + moves[y][z]) for z in range(5)]
                for j, k, s in begun[i]:
                    to = ahead.setdefault(j, [-math.inf] * 5)
                    to[k] = _log_sum([to[k], s + into[k]])
                    top, got = best.setdefault(j, [-math.inf] * 5), most[before[k]] + moves[before[k]][k] + s
                    if got > top[k]:
                        top[k] = got
                        via[10 * j + 2 * k:10 * j + 2 * k + 2] = bytes((j - i, before[k]))
        whole = _log_sum(ahead[n])
        at, k = n, max(range(5), key=lambda y: best[n][y])
        chosen: dict[int, tuple[int, int]] = {}
        while at:
            back_by, last = via[10 * at + 2 * k:10 * at + 2 * k + 2]
            if k:
                chosen[at - back_by] = (at, k)
            at, k = at - back_by, last
        out: list[tuple[int, int, int, float]] = []
        back: dict[int, list] = {n: [0.0] * 5}
        for first, last in reversed(parts):
            begun = arcs_from(first, last)
            for i in range(last - 1, first - 1, -1):
                into = [_log_sum([s + back[j][k] for j, label, s in begun[i] if label == k]) for k in range(5)]
                if i in chosen:
                    end, label = chosen[i]
                    score = next(s for j, k, s in begun[i] if (j, k) == (end, label))
                    out.append((cuts[i], cuts[end], label, math.exp(enter[5 * i + label] + score + back[end][label] - whole)))
                back[i] = [_log_sum([moves[y][k] + into[k] for k in range(5)]) for y in range(5)]
                back.pop(i + MAX_PIECES, None)
        return reversed(out)


def _gold(island: Island, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int]] | None:
    """The island's segmentation by base spans; None if a span is no candidate or spans overlap."""
    starts, ends = {a: i for i, a in enumerate(island.starts)}, {b: i + 1 for i, b in enumerate(island.ends)}
    possible, out, at = {(i, j) for i, j, _ in island.candidates}, [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        i, j = starts.get(a), ends.get(b)
        if i is None or j is None or i < at or (i, j) not in possible:
            return None
        out += [(x, x + 1, 0) for x in range(at, i)] + [(i, j, 1 + KINDS.index(kind))]
        at = j
    return out + [(x, x + 1, 0) for x in range(at, len(island.other))]


def _noisy(text: str, spans: list[tuple[str, int, int]], noise: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The island with noise after each token, and its spans moved along (their trailing noise left out)."""
    moved, out = [0] * (len(text) + 1), []
    for i, c in enumerate(text):
        if c.isspace() and i and not text[i - 1].isspace():
            out.append(noise)
        moved[i] = sum(map(len, out))
        out.append(c)
    moved[len(text)] = sum(map(len, out))
    return "".join(out) + noise, [(k, moved[a], moved[b - 1] + 1) for k, a, b in spans]


def train(docs: DataFrame, text: str = "text", max_islands: int = MAX_ISLANDS) -> Field:
    """A field trained on at most ``max_islands`` different islands of ``docs``."""
    few = docs.select(F.col(text).alias("text")).where(F.col(text).rlike("[0-9@]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(m[0] for t in batch.column(0).to_pylist() for m in _ISLAND.finditer(t)
                            if len(m[0]) <= MAX_ISLAND_CHARS)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], names=["island"])

    islands = few.mapInArrow(run, "island string").distinct().orderBy(F.xxhash64("island"), "island").limit(max_islands)
    samples: dict[tuple, list] = {}
    for (island,) in islands.collect():
        spans = base_spans(island)
        if not _NOISE.isdisjoint(island):
            continue
        for t, s in [(island, spans), *([_noisy(island, spans, n) for n in ("###", "!!")] if spans else [])]:
            made = Island(t)
            gold = _gold(made, s)
            if gold is not None:
                samples.setdefault((made.key(), tuple(gold)), [made, gold, 0])[2] += 1
    return Field().train([tuple(x) for x in samples.values()])


def _may_hold(island: str) -> bool:
    """False only if no span of the island can be a candidate: these have an at sign, or four digits or more with no
    letter between."""
    if "@" in island:
        return True
    digits = 0
    for p in _RUN.findall(island):
        if "0" <= p[0] <= "9":
            digits += len(p)
            if digits >= 4:
                return True
        elif any(map(str.isalpha, p)):
            digits = 0
    return False


def more_spans(text: str, base: list[tuple[str, int, int]], field: Field, known: dict) -> list[tuple[str, int, int]]:
    """Entities that the field adds to the base spans of a text."""
    out = []
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for m in _ISLAND.finditer(text):
        a, b = m.span()
        if any(x <= a and b <= y + 1 for x, y in taken if x < b and y > a) or not _may_hold(m[0]):
            continue
        if b - a > 4 * MAX_ISLAND_CHARS:
            entities = field.long_entities(m[0])
        else:
            made = Island(m[0])
            if not made.candidates:
                continue
            key = made.key()
            if key not in known:
                if len(known) > 20_000:
                    known.clear()
                known[key] = field.entities(made)
            entities = [(made.starts[i], made.ends[j - 1], label, p) for i, j, label, p in known[key]]
        for x, y, label, p in entities:
            before = bisect_left(starts, a + y)  # base spans that start before the entity's end
            if p >= LEAST and not (before and reach[before - 1] > a + x):
                out.append((KINDS[label - 1], a + x, a + y))
    return out


def all_spans(text: str, field: Field | None, known: dict) -> list[tuple[str, int, int, bool]]:
    base = base_spans(text)
    more = more_spans(text, base, field, known) if field is not None and len(field.weights) else []
    return sorted(((*s, i == 0) for i, spans in enumerate((base, more)) for s in spans),
                  key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _spans_of(batches, shared, column) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    field, known = shared(), {}
    for batch in (x.slice(a, 1000) for x in batches for a in range(0, x.num_rows, 1000)):
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        yield batch, texts, [all_spans(t, field, known) for t in texts]


def find(docs: DataFrame, field: Field, text: str = "text", to: str = "spans") -> DataFrame:
    """``docs`` with the spans of the text, by kind and start, in column ``to`` in place of the text; no shuffle."""
    docs = without(docs, to, keep=text)
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*rest, T.StructField(to, T.ArrayType(SPAN))])
    shared = shipped(docs.sparkSession, field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, spans in _spans_of(batches, shared, text):
            kept = [batch.column(i) for i, x in enumerate(batch.schema.names) if x != text]
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in x] for x in spans]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], names=schema.names)

    return docs.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with ``[KIND]`` for every span; overlapping spans become one, of the first one's kind."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with all spans of the text masked; a null text stays null; no shuffle."""
    shared = shipped(docs.sparkSession, field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, spans in _spans_of(batches, shared, text):
            i = batch.schema.get_field_index(text)
            was = batch.column(i)
            new = [masked(t, s) if ok else None for t, s, ok in zip(texts, spans, was.is_valid().to_pylist())]
            yield batch.set_column(i, batch.schema.field(i), pa.array(new, was.type))

    return docs.mapInArrow(run, docs.schema)
