from tideline.functions.checkpoints import encode_checkpoint, shutdown_reason
from tideline.functions.payload import (
    checksum_matches,
    decode_data,
    is_aggregated,
    record_format,
    verify_checksum,
)
from tideline.functions.sequence import (
    base_key,
    decode_base,
    is_sub_record,
    order_columns,
    order_key,
    position,
    request_position,
)
from tideline.functions.sizing import record_size, varint_size
from tideline.functions.text import DAEMON_NOISE, is_noise, keep_lines

__all__ = [
    "DAEMON_NOISE",
    "base_key",
    "checksum_matches",
    "decode_base",
    "decode_data",
    "encode_checkpoint",
    "is_aggregated",
    "is_noise",
    "is_sub_record",
    "keep_lines",
    "order_columns",
    "order_key",
    "position",
    "record_format",
    "record_size",
    "request_position",
    "shutdown_reason",
    "varint_size",
    "verify_checksum",
]
