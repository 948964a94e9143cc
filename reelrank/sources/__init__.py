"""Sources and sinks: delimited text, typed tables, driver-table projections."""

from reelrank.sources.fixtures import Inputs, load_inputs
from reelrank.sources.tables import (
    read_movies,
    read_ratings,
    read_table,
    read_tags,
    store_base_tables,
    write_search_documents,
    write_table,
)
from reelrank.sources.text import parse_movies, parse_ratings, parse_tags, read_text_table

__all__ = ["Inputs", "load_inputs", "parse_movies", "parse_ratings", "parse_tags",
           "read_movies", "read_ratings", "read_table", "read_tags", "read_text_table",
           "store_base_tables", "write_search_documents", "write_table"]
