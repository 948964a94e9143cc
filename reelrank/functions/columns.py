"""Scalar column functions.

All of them are compositions of built-in ``pyspark.sql.functions`` so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts))


def year_month(seconds: Column | str) -> Column:
    """Epoch seconds -> ``yyyyMM`` in UTC, without reading the session time zone."""
    ntz = F.timestamp_add("SECOND", _col(seconds).cast("bigint"),
                          F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(ntz, "yyyyMM")


def lower_contains(text: Column | str, needle: Column | str) -> Column:
    """``lower(text)`` contains ``lower(needle)`` (substring, not token)."""
    return F.contains(F.lower(_col(text)), F.lower(_col(needle)))


def genre_match(genres: Column | str, genre_list: list[str], mode: str = "substring") -> Column:
    """The genres of ``genre_list`` that a movie's ``|``-joined genre string matches.

    ``substring`` (default) is the reference's rule: the lower-cased genre
    occurs anywhere in the lower-cased string, so ``Old`` also hits ``cold``.
    ``token`` requires a whole ``|``-separated token to be equal.
    The list is a literal array, so matching is a per-row expression: no join.
    """
    candidates = F.array(*[F.lit(g) for g in genre_list])
    lowered = F.lower(_col(genres))
    if mode == "substring":
        return F.filter(candidates, lambda g: F.contains(lowered, F.lower(g)))
    if mode == "token":
        tokens = F.split(lowered, r"\|", -1)
        return F.filter(candidates, lambda g: F.array_contains(tokens, F.lower(g)))
    raise ValueError(f"unknown genre match mode {mode!r}")


def java_split(text: Column | str, pattern: str) -> Column:
    """Regex split with the JVM ``String.split`` rule: trailing empty strings are dropped.

    An empty input gives one empty token; an input made only of separators
    gives an empty array.
    """
    t = _col(text)
    stripped = F.regexp_replace(t, f"(?:{pattern})+$", "")
    return (F.when(t == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern, -1)))


def java_log10(x: Column | str) -> Column:
    """``log10`` with JVM results outside the domain: 0 -> -Infinity, negative/NaN -> NaN.

    Spark's ``log10`` gives NULL there, which would silently drop a score.
    """
    v = _col(x)
    return (F.when(v > 0, F.log10(v))
            .when(v == 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))


def rounded(x: Column | str, digits: int = 6) -> Column:
    """``round(x, digits)``, bit for bit, without a decimal object per value.

    Away from a tie the nearest whole number of ``x * 10**digits`` is plain arithmetic, and its quotient by
    ``10**digits`` is the double next to that decimal, as ``round`` gives it.  Near a tie, and for large values, NaN and
    NULL, ``round`` itself decides.
    """
    v, scale = _col(x), 10 ** digits
    t = v * F.lit(float(scale))
    plain = (F.abs(t) < 1e9) & (F.abs(t - F.floor(t) - 0.5) > 1e-6)
    return F.when(plain, F.floor(t + 0.5) / F.lit(float(scale))).otherwise(F.round(v, digits))


def sorted_recs(rows: Column, id_field: str = "mid") -> Column:
    """Sort a collected ``array<struct<id, score>>`` by score desc (NaN last), id asc,
    and return it as ``array<struct<id, score>>``.
    """
    keyed = F.transform(rows, lambda r: F.struct(
        F.isnan(r["score"]).cast("int").alias("k0"),
        F.when(F.isnan(r["score"]), F.lit(0.0)).otherwise(-r["score"]).alias("k1"),
        r[id_field].alias("k2"),
        r["score"].alias("score")))
    return F.transform(F.sort_array(keyed), lambda r: F.struct(
        r["k2"].alias(id_field), r["score"].alias("score")))
