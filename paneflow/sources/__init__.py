"""Sources: Kafka topics, and files or tables in their place."""

from .kafka import consumer_options, read_topics, topic_stream, topics_frame
from .replay import line_stream, line_table, message_stream

__all__ = [
    "consumer_options",
    "line_stream",
    "line_table",
    "message_stream",
    "read_topics",
    "topic_stream",
    "topics_frame",
]
