"""Delimited text sources (movie ``^``, rating ``,``, tag ``,``).

Parsers take a DataFrame with one string column ``value`` -- what
``spark.read.text`` and a text stream produce -- so batch and stream share
them.  ``strict=True`` casts with ANSI semantics (a bad number fails the job,
as the reference does); ``strict=False`` uses ``try_cast`` and yields NULLs,
and :func:`split_invalid` then separates the rows that did not parse
(``keep_line=True`` keeps the raw line next to them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank import schemas


# Fixed value: the characters that a JVM string trim removes, U+0000 to U+0020.
TRIMMED = "".join(map(chr, range(0x21)))


def jvm_trim(c):
    """Both ends without characters up to U+0020 (``F.trim`` removes spaces only)."""
    return F.btrim(c, F.lit(TRIMMED))


def _num(c, type_name: str, strict: bool):
    return c.cast(type_name) if strict else c.try_cast(type_name)


def _field(parts, i: int, strict: bool):
    """Field ``i`` (0-based).  A short line fails a strict parse and gives
    NULL in a lenient one."""
    return parts.getItem(i) if strict else F.get(parts, F.lit(i))


def _line(keep_line: bool) -> list:
    return [F.col("value").alias("line")] if keep_line else []


def parse_movies(lines: DataFrame, strict: bool = True, keep_line: bool = False) -> DataFrame:
    """``mid^name^descri^timelong^issue^shoot^language^genres^actors^directors``.

    Fields 1-9 are trimmed.  Trailing empty fields are kept as ``''``.
    """
    parts = F.split(F.col("value"), r"\^", -1)
    cols = [_num(_field(parts, 0, strict), "int", strict).alias("mid")]
    for i, name in enumerate(schemas.MOVIE_COLUMNS[1:], start=1):
        cols.append(jvm_trim(_field(parts, i, strict)).alias(name))
    return lines.select(*cols, *_line(keep_line))


def parse_ratings(lines: DataFrame, strict: bool = True, keep_line: bool = False) -> DataFrame:
    """``uid,mid,score,timestamp``."""
    parts = F.split(F.col("value"), ",", -1)
    return lines.select(
        _num(_field(parts, 0, strict), "int", strict).alias("uid"),
        _num(_field(parts, 1, strict), "int", strict).alias("mid"),
        _num(_field(parts, 2, strict), "double", strict).alias("score"),
        _num(_field(parts, 3, strict), "int", strict).alias("timestamp"),
        *_line(keep_line),
    )


_TAG_LINE = r"(?s)^([^,]*),([^,]*),(.*),([^,]*)\z"  # a tag may hold any character, separators of lines included


def parse_tags(lines: DataFrame, strict: bool = True, keep_line: bool = False) -> DataFrame:
    """``uid,mid,tag,timestamp``; the tag is trimmed and may itself hold commas
    (everything between the second and the last comma)."""
    v = F.col("value")
    return lines.select(
        _num(F.regexp_extract(v, _TAG_LINE, 1), "int", strict).alias("uid"),
        _num(F.regexp_extract(v, _TAG_LINE, 2), "int", strict).alias("mid"),
        jvm_trim(F.regexp_extract(v, _TAG_LINE, 3)).alias("tag"),
        _num(F.regexp_extract(v, _TAG_LINE, 4), "int", strict).alias("timestamp"),
        *_line(keep_line),
    )


_NUMERIC = {"movie": ["mid"], "rating": ["uid", "mid", "score", "timestamp"], "tag": ["uid", "mid", "timestamp"]}


def split_invalid(parsed: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows of a lenient parse: a row is invalid when one of
    its numeric fields did not parse (NULL).  One pass each, no shuffle."""
    bad = F.lit(False)
    for c in _NUMERIC[kind]:
        bad = bad | F.col(c).isNull()
    return parsed.filter(~bad), parsed.filter(bad)


_PARSERS = {"movie": parse_movies, "rating": parse_ratings, "tag": parse_tags}


def read_text_table(spark: SparkSession, path: str, kind: str, strict: bool = True) -> DataFrame:
    """Read delimited text files of ``kind`` (movie, rating, tag) into the typed table."""
    return parse_lines(spark.read.text(path), kind, strict)


def parse_lines(lines: DataFrame, kind: str, strict: bool = True, keep_line: bool = False) -> DataFrame:
    """Lines of ``kind`` (movie, rating, tag) to its table."""
    return _PARSERS[kind](lines, strict=strict, keep_line=keep_line)


def parse_recents(entries: DataFrame, strict: bool = True) -> DataFrame:
    """Recent-rating lists: rows ``(uid, pos, value)`` with ``value`` = ``mid:score``, pos 0 = newest, to
    ``(uid, pos, mid, score)``.  Both numbers are trimmed; what follows a second colon is ignored."""
    parts = F.split(F.col("value"), ":", -1)
    return entries.select(
        "uid", "pos", _num(jvm_trim(_field(parts, 0, strict)), "int", strict).alias("mid"),
        _num(jvm_trim(_field(parts, 1, strict)), "double", strict).alias("score"))


def recent_entries(recents: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_recents`: ``(uid, pos, value)`` from ``(uid, pos, mid, score)``."""
    return recents.select("uid", "pos", F.concat_ws(":", "mid", "score").alias("value"))


def movie_lines(movies: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_movies` (used to write text and in tests)."""
    return movies.select(F.concat_ws("^", *[F.col(c).cast("string") for c in schemas.MOVIE_COLUMNS])
                         .alias("value"))


def rating_lines(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.concat_ws(",", *schemas.RATING_COLUMNS).alias("value"))


def tag_lines(tags: DataFrame) -> DataFrame:
    return tags.select(F.concat_ws(",", *schemas.TAG_COLUMNS).alias("value"))
