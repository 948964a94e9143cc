"""Column expressions (JVM-side, codegen friendly) shared by the operators."""

from reelrank.functions.columns import (
    epoch_seconds,
    genre_match,
    java_log10,
    java_split,
    lower_contains,
    sorted_recs,
    year_month,
)

__all__ = ["epoch_seconds", "genre_match", "java_log10", "java_split",
           "lower_contains", "sorted_recs", "year_month"]
