"""Completion frontier: how far a shard has been handled without a gap.

Input is one row per non-ignored record with its position and whether it is
``done``. Records may complete in any order. The frontier of a shard is the
newest done record before the shard's first open one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.checkpoints import shutdown_reason
from tideline.functions.sequence import is_sub_record, order_key, position
from tideline.operators.gate import CLOCK, NEEDS, WEIGHT, interval_gate
from tideline.operators.ordering import running_max
from tideline.operators.sizing import fits_one_task, keyed_join, lookup, materialize
from tideline.schema import POSITION_FIELDS, SHARD_KEYS


def _unpack(df: DataFrame, struct: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(f"{struct}.{c}").alias(c) for c in POSITION_FIELDS])


def _eligible(subsequence: bool) -> Column:
    """Records a checkpoint may name: any, or only those that end their aggregate."""
    return F.lit(True) if subsequence else ~is_sub_record()


def _codes(columns: list[pa.Array]) -> np.ndarray:
    """A number for every row, equal where all ``columns`` are; NULLs are equal."""
    parts = [c.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
    # Made dense again at every step, so that products of many columns do not overflow.
    return reduce(lambda a, b: np.unique(a * (b.max() + 1) + b, return_inverse=True)[1], parts)


def _raw(column: pa.Array) -> pa.Array:
    """Texts as bytes, whose order is Spark's."""
    return column.cast(pa.binary()) if pa.types.is_string(column.type) else column


def _before_open(n_keys: int, columns: list[str]):
    """Leave out rows that cannot matter to a frontier: those behind an open record that the task has already seen
    in the shard, and done ones that no checkpoint may name. A shard's first row always stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[tuple, bytes | None] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [_raw(batch.column(i)) for i in range(n_keys)]
            _, first, shard = np.unique(_codes(keys), return_index=True, return_inverse=True)
            names = [tuple(c[i].as_py() for c in keys) for i in first.tolist()]
            place = _raw(batch.column("base_key"))
            is_open = batch.column("_is_open")
            least = pa.table({"shard": shard, "place": place}).filter(is_open).group_by("shard").aggregate([("place", "min")])
            new = [i for i, name in zip(first.tolist(), names) if name not in opened]
            for s, found in zip(least["shard"].to_pylist(), least["place_min"].to_pylist()):
                old = opened.get(names[s])
                opened[names[s]] = found if old is None or (found is not None and found < old) else old
            # Places within one base are left to Spark's own comparison, and so are NULLs.
            limit = pa.array([opened.setdefault(name, None) for name in names], place.type).take(pa.array(shard))
            kept = pc.and_(batch.column("_may_matter"), pc.fill_null(pc.less_equal(place, limit), True))
            kept = kept.to_numpy(zero_copy_only=False).copy()
            kept[new] = True
            yield batch.select(columns).filter(pa.array(kept))

    return run


def _narrowed(completions: DataFrame, is_done: Column, done: str, subsequence: bool, keys: Sequence[str]) -> DataFrame:
    """Keys, positions and flags of the rows that may decide the frontier, without a shuffle."""
    columns = [*keys, *POSITION_FIELDS, done]
    marked = completions.select(
        *columns, (~is_done).alias("_is_open"), (~is_done | _eligible(subsequence)).alias("_may_matter")
    )
    return marked.mapInArrow(_before_open(len(keys), columns), marked.select(*columns).schema)


def frontier(
    completions: DataFrame,
    done: str = "done",
    subsequence: bool = False,
    keys: Sequence[str] = SHARD_KEYS,
    computed: bool = False,
) -> DataFrame:
    """Frontier per shard; shards whose first record is open have NULL positions.

    Two plain aggregates with map-side combine and one join against a row per
    shard: no window, and a hot shard costs no more than any other rows.
    ``completions`` is read twice. Say ``computed`` if that means more than
    scanning a table: positions and flags are then kept in between, of the rows
    that may still matter by what their task has seen of the shard.
    """
    keys = list(keys)
    is_done = F.coalesce(F.col(done), F.lit(False))
    if computed:
        completions = materialize(_narrowed(completions, is_done, done, subsequence, keys))
    first_open = completions.groupBy(*keys).agg(F.min(F.when(~is_done, order_key())).alias("_open"))
    joined = lookup(completions, first_open, keys)
    before = F.col("_open").isNull() | (order_key() < F.col("_open"))
    passed = joined.groupBy(*keys).agg(
        F.max(F.when(before & _eligible(subsequence), position())).alias("_p")
    )
    return _unpack(passed, "_p", keys)


def frontier_history(
    completions: DataFrame,
    done_round: str = "done_round",
    subsequence: bool = False,
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """Each advance of the frontier: shard, round, and where it then stands.

    A record is passed in the round in which the last of it and its predecessors
    completed, the running maximum of ``done_round``. Rounds after which the
    frontier stands where it stood are left out. NULL means never done.
    """
    keys = list(keys)
    never = F.lit((1 << 63) - 1)
    rounds = F.coalesce(F.col(done_round).cast("bigint"), never)
    ready = running_max(completions, rounds, "_ready", keys=keys, **sizing)
    advances = (
        ready.filter((F.col("_ready") < never) & _eligible(subsequence))
        .groupBy(*keys, F.col("_ready").alias("round"))
        .agg(F.max(position()).alias("_p"))
    )
    return _unpack(advances, "_p", [*keys, "round"])


def checkpoint_schedule(
    rounds: DataFrame,
    history: DataFrame,
    interval_ms: int,
    clock: str = "clock_ms",
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """Checkpoints sent when at most one may go out per interval.

    ``rounds`` lists the occasions (shard, ``round``, clock): one per flush round,
    or per record for the finest timing. A checkpoint goes out on an occasion if
    the interval has passed since the last one and the frontier (``history``) has
    moved since. Only a checkpoint sent restarts the interval.
    """
    keys = list(keys)
    moved = history.select(*keys, "round", position().alias("_p"))
    occasions = keyed_join(rounds.select(*keys, "round", clock), moved, [*keys, "round"], "left")
    # Asked for its size, summed up and gated: worked out once, one narrow row per round.
    occasions = materialize(occasions)
    sizing = {"fits": fits_one_task(occasions, keys, sizing.get("max_group_rows")), **sizing}
    # The frontier never moves back, so the newest position so far is the maximum.
    occasions = running_max(occasions, F.col("_p"), "_at", keys=keys, order=[F.col("round")], **sizing)
    events = (
        occasions.withColumn(CLOCK, F.col(clock))
        .withColumn(WEIGHT, F.when(F.col("_p").isNotNull(), 1).otherwise(0))
        .withColumn(NEEDS, F.lit(True))
        .drop("_p")
    )
    gated = interval_gate(events, interval_ms, keys=keys, order=[F.col("round")], **sizing)
    sent = gated.filter(F.col("fired").isNotNull())
    return _unpack(sent.withColumnRenamed("batch_no", "checkpoint_no"), "_at", [*keys, "checkpoint_no", "round", clock])


def final_checkpoints(
    completions: DataFrame,
    shard_ends: DataFrame,
    done: str = "done",
    subsequence: bool = False,
    keys: Sequence[str] = SHARD_KEYS,
) -> DataFrame:
    """Last checkpoint of closed shards.

    ``completions`` is the state after the closing flush, ``shard_ends`` has one
    row per ended shard with its wire ``reason``. A terminated shard is
    checkpointed at its frontier (``kind`` = ``frontier``), or at the newest
    record seen if it has none (``latest``, NULL position); an open record, or a
    done one the frontier cannot pass, fails the query. A lost shard
    (``zombie``) gets no checkpoint. Any other reason fails the query.
    """
    keys = list(keys)
    ends = shard_ends.select(*keys, shutdown_reason("reason").alias("reason"))
    is_done = F.coalesce(F.col(done), F.lit(False))
    # Nothing may be open, so the frontier is simply the newest record that can carry it.
    state = completions.groupBy(*keys).agg(
        F.max(F.when(is_done & _eligible(subsequence), position())).alias("_p"),
        F.max(position()).alias("_newest"),
        F.count(F.when(~is_done, 1)).alias("_n_open"),
    )
    joined = keyed_join(ends, state, keys, "left")
    left_over = (F.coalesce("_n_open", F.lit(0)) > 0) | (
        F.col("_newest").isNotNull() & (F.col("_p").isNull() | (F.col("_p") < F.col("_newest")))
    )
    name = F.concat_ws("/", *keys)
    kind = (
        F.when(F.col("reason") == "zombie", F.lit(None).cast("string"))
        .when(
            F.col("reason") != "terminate",
            F.raise_error(F.concat(F.lit("unknown shutdown reason for shard "), name)).cast("string"),
        )
        .when(left_over, F.raise_error(F.concat(F.lit("records left over on closed shard "), name)).cast("string"))
        .when(F.col("_p").isNotNull(), "frontier")
        .otherwise("latest")
    )
    return _unpack(joined.withColumn("kind", kind), "_p", [*keys, "reason", "kind"]).filter(
        F.col("kind").isNotNull()
    )


def stalled_shards(
    activity: DataFrame,
    timeout_ms: int,
    clock: str = "arrival_ms",
    now_ms: int | Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
) -> DataFrame:
    """Silences longer than ``timeout_ms``: when each began and when it ended.

    ``activity`` is any row that shows life: records, ignored ones, heartbeats.
    ``now_ms`` closes the last silence, whose ``until_ms`` is NULL.

    Two rows in one timeout-wide slot are never a timeout apart, so only each
    slot's first and last time matter: a map-side combined aggregate, and a
    window over slots instead of rows.
    """
    if timeout_ms < 1:
        raise ValueError("timeout_ms must be positive")
    keys = list(keys)
    slot = F.floor(F.col(clock) / F.lit(timeout_ms)).cast("bigint")
    slots = activity.groupBy(*keys, slot.alias("_slot")).agg(
        F.min(clock).alias("_first"), F.max(clock).alias("_last")
    )
    nxt = F.lead("_first").over(W.partitionBy(*keys).orderBy("_slot"))
    gaps = slots.select(*keys, F.col("_last").alias("since_ms"), nxt.alias("until_ms"))
    if now_ms is None:
        end = F.col("until_ms")
    else:
        now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
        end = F.coalesce("until_ms", now)
    return gaps.filter(end - F.col("since_ms") > timeout_ms).withColumn("silent_ms", end - F.col("since_ms"))
