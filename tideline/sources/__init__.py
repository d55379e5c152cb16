from tideline.sources.directory import dump_to_dir, latest_per_key, read_dir
from tideline.sources.envelopes import (
    parse_envelopes,
    parse_requests,
    read_lines,
    shard_ends,
    shard_starts,
    stream_records,
    to_request_lines,
)
from tideline.sources.sessions import SESSION_KEYS, session_bounds, worker_sessions
from tideline.sources.streams import (
    fetch_batches,
    initial_position,
    resume_from_checkpoint,
    stream_tip,
    union_streams,
)

__all__ = [
    "SESSION_KEYS",
    "dump_to_dir",
    "fetch_batches",
    "initial_position",
    "latest_per_key",
    "parse_envelopes",
    "parse_requests",
    "read_dir",
    "read_lines",
    "resume_from_checkpoint",
    "session_bounds",
    "shard_ends",
    "shard_starts",
    "stream_records",
    "stream_tip",
    "to_request_lines",
    "union_streams",
    "worker_sessions",
]
