from tideline.operators.counters import (
    arrival_counter,
    count_checkpoints,
    drop_ignored,
    flush_by_count,
    latest_checkpoint,
    shard_counters,
)
from tideline.operators.deaggregate import deaggregate
from tideline.operators.flush import flush_batches, flush_by_bytes, flush_by_interval, flush_log, flush_tokens, heartbeat_flush
from tideline.operators.flusher import Flusher, open_records, partial_tokens, run_flusher
from tideline.operators.fold import OrderedFold, ordered_fold
from tideline.operators.frontier import (
    checkpoint_schedule,
    final_checkpoints,
    frontier,
    frontier_history,
    stalled_shards,
)
from tideline.operators.ordering import dense_counter, ordered_chunks, running_max
from tideline.operators.pack import key_dictionary, oversize_records, pack, pack_header, with_lanes
from tideline.operators.processor import RecordProcessor, process_shards

__all__ = [
    "Flusher",
    "OrderedFold",
    "RecordProcessor",
    "arrival_counter",
    "checkpoint_schedule",
    "count_checkpoints",
    "deaggregate",
    "dense_counter",
    "drop_ignored",
    "final_checkpoints",
    "flush_batches",
    "flush_by_bytes",
    "flush_by_count",
    "flush_by_interval",
    "flush_log",
    "flush_tokens",
    "frontier",
    "frontier_history",
    "heartbeat_flush",
    "key_dictionary",
    "latest_checkpoint",
    "open_records",
    "ordered_chunks",
    "ordered_fold",
    "oversize_records",
    "pack",
    "pack_header",
    "partial_tokens",
    "process_shards",
    "running_max",
    "run_flusher",
    "shard_counters",
    "stalled_shards",
    "with_lanes",
]
