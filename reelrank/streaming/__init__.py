"""Structured Streaming form of the real-time recommender."""

from reelrank.streaming.log import BatchTable, UserLog
from reelrank.streaming.query import (
    current_stream_recs,
    parse_rating_messages,
    rating_stream,
    rejected_messages,
    start_realtime_query,
    starting_offsets,
)

__all__ = ["BatchTable", "UserLog", "current_stream_recs", "parse_rating_messages", "rating_stream", "rejected_messages",
           "start_realtime_query", "starting_offsets"]
