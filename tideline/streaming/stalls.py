"""Stalled shards of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideline.schema import SHARD_KEYS


def stalled_shards_stream(activity: DataFrame, timeout_ms: int, keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """One row each time a shard has shown no activity for ``timeout_ms`` of processing time.

    Any row counts as activity. A shard is reported once per silence.
    """
    keys = list(keys)
    out = T.StructType(
        [
            *[T.StructField(k, activity.schema[k].dataType) for k in keys],
            T.StructField("since_ms", T.LongType()),
            T.StructField("noticed_ms", T.LongType()),
        ]
    )

    def run(key, pdfs: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        now = group.getCurrentProcessingTimeMs()
        if group.hasTimedOut:
            (since,) = group.get
            yield pd.DataFrame([[*key, since, now]], columns=out.names)
            group.remove()
        else:
            for _ in pdfs:
                pass
            group.update((now,))
            group.setTimeoutDuration(timeout_ms)

    return activity.select(*keys).groupBy(*keys).applyInPandasWithState(
        run, out, "since bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
