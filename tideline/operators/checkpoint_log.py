"""What happens to checkpoints: records at which a processor asks for one, a hook, a log."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.functions.checkpoints import encode_checkpoint
from tideline.operators.fold import OrderedFold, ordered_fold
from tideline.operators.processor import RecordProcessor
from tideline.schema import POSITION_FIELDS, SHARD_KEYS

#: Called on executors with checkpoints as Arrow batches; raise to fail the query. Retried tasks call again.
Hook = Callable[[pa.RecordBatch], None]


class _Checkpoints(OrderedFold):
    """The rows at which a processor asks for a checkpoint, in place of what it puts out."""

    def __init__(self, processor: RecordProcessor, columns: Sequence[str]):
        self.processor = processor
        self.splittable = processor.splittable
        self.combine = processor.combine
        self.columns = list(columns)

    def start(self, key):
        return self.processor.initialize(key)

    def step(self, key, state, rows):
        asked = self.processor.checkpoints(key, state, rows)
        state, _ = self.processor.process(key, state, rows)
        if asked is None:
            return state, None
        at = rows.filter(pa.array(asked, pa.bool_())).select(self.columns)
        if at.num_rows:
            state = self.processor.checkpointed(key, state, at.slice(at.num_rows - 1).to_pylist()[0])
        return state, at

    def summarize(self, slices):
        return self.processor.summarize(slices)

    def advance(self, state, summary):
        return self.processor.advance(state, summary)


def processor_checkpoints(
    records: DataFrame,
    processor: RecordProcessor,
    keys: Sequence[str] = SHARD_KEYS,
    summary_columns: Sequence[str] = (),
    **sizing,
) -> DataFrame:
    """One row per checkpoint that ``processor`` asks for: keys and position."""
    columns = [*keys, *POSITION_FIELDS]
    out = T.StructType([T.StructField(c, records.schema[c].dataType) for c in columns])
    return ordered_fold(
        records, _Checkpoints(processor, columns), out, keys=keys, summary_columns=summary_columns, **sizing
    )


def with_hook(checkpoints: DataFrame, hook: Hook) -> DataFrame:
    """``checkpoints``, each batch of them shown to ``hook`` where it lies."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hook(batch)
            yield batch

    return checkpoints.mapInArrow(run, checkpoints.schema)


def log_checkpoints(
    checkpoints: DataFrame, path: str, v2: Column | bool = True, keys: Sequence[str] = SHARD_KEYS
) -> None:
    """Append checkpoints, with their wire form in ``line``, to the log below ``path``."""
    columns = [*keys, *POSITION_FIELDS]
    checkpoints.select(*columns, encode_checkpoint(v2=v2).alias("line")).write.mode("append").parquet(path)


def read_checkpoint_log(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was logged: keys, position, ``line``."""
    return spark.read.parquet(path)
