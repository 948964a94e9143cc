"""Plain Python versions of the operators, straight from their definitions."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    t = text or ""
    w = words(t)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(t)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """(doc_id, fingerprint) rows to the smallest id reachable over links of at most two bits."""
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, f in rows:
        parent.setdefault(f, f)
    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 2:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(least.get(root(f), d), d)
    return [least.get(root(f)) for _, f in rows]


def substrings(rows, n):
    """(doc_id, text) rows, in order, to (doc_id, n_words, n_removed, kept)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for d, t in order:
        w, gone = words(t), set()
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            if key in seen:
                gone.update(range(i, i + n))
            seen.add(key)
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def leaks(rows, items):
    """(doc_id, item_id, best similarity) of all item-sized windows with a weighted Jaccard of at least 0.8."""
    split = lambda t: re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", (t or "").lower()).split()

    def bag(w):
        k = min(5, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))

    weight = lambda s: sum(len(x.encode()) for x in s)
    out = set()
    for d, t in rows:
        w = split(t)
        for item, text in items:
            x = split(text)
            size, best = min(len(x), len(w)), 0
            if not x or len(w) < min(5, len(x)):
                continue
            want = bag(x)
            for s in range(len(w) - size + 1):
                got = bag(w[s:s + size])
                low = sum(weight(k) * min(got[k], want[k]) for k in got | want)
                all_ = sum(weight(k) * max(got[k], want[k]) for k in got | want)
                if 5 * low >= 4 * all_:
                    best = max(best, low / all_)
            if best:
                out.add((d, item, round(best, 9)))
    return out


def pii(text):
    t, out = text or "", []
    digits = lambda s: re.sub(r"[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    for kind, pattern, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ):
        out += [(kind, *m.span()) for m in re.finditer(pattern, t) if ok(m[0])]
    return out


def licence_dirs(paths, given):
    """Nearest ancestor directory with a licence, for each path without one of its own."""
    out = {}
    for p in paths:
        parts = p.split("/")[:-1]
        for n in range(len(parts), -1, -1):
            d = "/".join(parts[:n])
            if d in given:
                out[p] = d
                break
    return out


def loads(rows):
    total = defaultdict(int)
    for shard, size in rows:
        total[shard] += size
    return total
