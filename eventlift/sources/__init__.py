from eventlift.sources.lake import read_event_files, read_raw_lake, stream_event_files, stream_raw_lake
from eventlift.sources.messages import (
    decode_envelope,
    encode_envelope,
    read_message_files,
    stream_messages,
)
from eventlift.sources.sample import raw_events_from_table

__all__ = [
    "decode_envelope",
    "encode_envelope",
    "raw_events_from_table",
    "read_event_files",
    "read_message_files",
    "read_raw_lake",
    "stream_event_files",
    "stream_messages",
    "stream_raw_lake",
]
