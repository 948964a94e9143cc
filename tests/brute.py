"""Plain-Python references used by the tests (small fixtures only)."""

from __future__ import annotations

import math
import re
from collections import Counter


def java_split(s: str, pattern: str) -> list[str]:
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def tokens(genres: str | None) -> list[str]:
    if genres is None:
        return []
    return java_split(" ".join(java_split(genres, r"\|")).lower(), r"\s")


def cosine_pairs(movies: list[tuple[int, str | None]], threshold: float = 0.6,
                 term=lambda t: t) -> dict[tuple[int, int], float]:
    """All directed pairs (a, b), a != b, with TF-IDF cosine > threshold."""
    tf = {mid: Counter(term(t) for t in tokens(g)) for mid, g in movies}
    m = len(movies)
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((m + 1) / (d + 1)) for t, d in df.items()}
    vec = {mid: {t: c * idf[t] for t, c in cnt.items() if c * idf[t] != 0} for mid, cnt in tf.items()}
    norm = {mid: math.sqrt(sum(w * w for w in v.values())) for mid, v in vec.items()}
    out = {}
    for a, va in vec.items():
        for b, vb in vec.items():
            if a == b or norm[a] == 0 or norm[b] == 0:
                continue
            dot = sum(w * vb.get(t, 0.0) for t, w in va.items())
            cos = dot / (norm[a] * norm[b])
            if cos > threshold:
                out[(a, b)] = cos
    return out


def realtime(events, ratings, sims, k=20, n=20, threshold=0.7):
    """The per-user scoring rule, written as loops (one batch of events)."""
    simmap: dict[int, dict[int, float]] = {}
    for (a, b), s in sims.items():
        simmap.setdefault(a, {})[b] = s
    out = {}
    for uid in {e[0] for e in events}:
        ev = [e for e in events if e[0] == uid]
        last = max(ev, key=lambda e: (e[3], e[1], e[2]))
        hist = [r for r in ratings if r[0] == uid] + ev
        recents = sorted(hist, key=lambda r: (-r[3], r[1], -r[2]))[:k]
        rated = {r[1] for r in ratings if r[0] == uid}
        cands = sorted(((c, s) for c, s in simmap.get(last[1], {}).items() if c not in rated),
                       key=lambda x: (-x[1], x[0]))[:n]
        scores = []
        for c, _ in cands:
            prods, inc, dec = [], 0, 0
            for r in recents:
                s = simmap.get(c, {}).get(r[1], 0.0)
                if s > threshold:
                    prods.append(s * r[2])
                    inc += r[2] > 3
                    dec += r[2] <= 3
            if prods:
                base = 0.0
                for p in sorted(prods):
                    base += p
                base /= len(prods)
                x = (inc or 1) - math.log10(dec or 1)
                adj = math.log10(x) if x > 0 else (-math.inf if x == 0 else math.nan)
                scores.append((c, base + adj))
        out[uid] = sorted(scores, key=lambda x: (math.isnan(x[1]), 0 if math.isnan(x[1]) else -x[1], x[0]))
    return out
