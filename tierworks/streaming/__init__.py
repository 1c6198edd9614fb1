from tierworks.streaming.events import (
    ORDER_EVENT,
    parse_events,
    stream_append,
    stream_by_batch,
    stream_dedupe,
    stream_first_copies,
    stream_source,
    stream_to_table,
    stream_with_dead_letters,
)

__all__ = [
    "ORDER_EVENT",
    "parse_events",
    "stream_append",
    "stream_by_batch",
    "stream_dedupe",
    "stream_first_copies",
    "stream_source",
    "stream_to_table",
    "stream_with_dead_letters",
]
