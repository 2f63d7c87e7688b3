from cartspark.streaming.archive import (
    RECORDS,
    REJECTED,
    archive_first_records,
    archive_records,
    archive_stream,
    archived_counts,
    archived_parts,
    keyed_envelope,
    read_archive,
    stamp_ingestion,
)
from cartspark.streaming.delivery import file_sink, publish_stream, read_sent, read_tally, topic_sink
from cartspark.streaming.envelope import (
    decode_envelope,
    decode_records,
    decode_values,
    failed_records,
    good_events,
)
from cartspark.streaming.estimates import read_estimates, stream_batch_estimates
from cartspark.streaming.sliding import read_late_rows, read_stream_windows, stream_sliding_windows
from cartspark.streaming.sources import record_values, stream_events, stream_values

__all__ = [
    "RECORDS",
    "REJECTED",
    "archive_first_records",
    "archive_records",
    "archive_stream",
    "archived_counts",
    "archived_parts",
    "decode_envelope",
    "decode_records",
    "decode_values",
    "failed_records",
    "file_sink",
    "good_events",
    "keyed_envelope",
    "publish_stream",
    "read_archive",
    "read_estimates",
    "read_late_rows",
    "read_sent",
    "read_stream_windows",
    "read_tally",
    "record_values",
    "stamp_ingestion",
    "stream_batch_estimates",
    "stream_events",
    "stream_sliding_windows",
    "stream_values",
    "topic_sink",
]
