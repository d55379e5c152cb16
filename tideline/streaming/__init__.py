from tideline.streaming.counters import ShardCounters
from tideline.streaming.flush import flush_sink, flush_stream
from tideline.streaming.folds import EndingFold, StreamFold
from tideline.streaming.frontier import FrontierTracker, completion_runs, merge_runs
from tideline.streaming.processor import checkpoints_of, process_shards_stream, processor_sink, rows_of
from tideline.streaming.stalls import stalled_shards_stream

__all__ = [
    "EndingFold",
    "FrontierTracker",
    "ShardCounters",
    "StreamFold",
    "checkpoints_of",
    "completion_runs",
    "flush_sink",
    "flush_stream",
    "merge_runs",
    "process_shards_stream",
    "processor_sink",
    "rows_of",
    "stalled_shards_stream",
]
