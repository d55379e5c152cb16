"""Worker sessions: what a shard's lines say between an ``initialize`` and the end of its lease.

A worker starts anew with each ``initialize``: its counters begin at zero and
its state is empty. Sessions make that visible in batch: every request line
gets the number of its session, and any per-shard operator takes
``keys=SESSION_KEYS`` to start over with each.

Lines never move. One pass over them collects, for each (shard, part of a
file), the few lines that open or close a session; a window over those parts,
one small row each, tells in which session a part starts; and lines look their
session up by part and by bin, a run of the part's rows. A part is what one task
reads, so what is collected of it is bounded by the part's size. Its bins are as
wide as its marks are rare: the lines of a part are compared with about
``MARKS_PER_BIN`` stretches each, however many sessions it holds and wherever they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.operators.sizing import materialize, ordered_lookup
from tideline.schema import SHARD_KEYS
from tideline.sources.envelopes import LINE_PLACE

SESSION = "session"
SESSION_KEYS = (*SHARD_KEYS, SESSION)

OPENING = ("initialize",)
CLOSING = ("shutdown", "shutdownRequested")
_NEVER = (1 << 63) - 1

#: Marks of a part per bin, on the average: more of them make the lookup smaller and its comparisons more.
MARKS_PER_BIN = 8


def session_marks(lines: DataFrame, *, value: str = "value", keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """(keys, file, block, marks, first_row, last_row) of every part of a file: its lines that open or close a session, in order."""
    # A projection of its own, so that no line is searched twice.
    lines = lines.withColumn("_action", F.get_json_object(value, "$.action"))
    action = F.col("_action")
    mark = F.struct("row", action.isin(*OPENING).alias("opens"))
    return lines.groupBy(*keys, "file", "block").agg(
        F.sort_array(F.collect_list(F.when(action.isin(*OPENING, *CLOSING), mark))).alias("marks"),
        F.min("row").alias("first_row"),
        F.max("row").alias("last_row"),
    )


def _segments(marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_part, _from, _until, session, first_row, last_row, _width): stretches of a part's rows; session is NULL between sessions."""
    earlier = W.partitionBy(*keys).orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    opened = F.size(F.filter("marks", lambda m: m["opens"])).cast("bigint")
    known = marks.withColumns(
        {
            "_before": F.coalesce(F.sum(opened).over(earlier), F.lit(0)),
            # Whether the last mark of the parts before opens; parts without marks say nothing.
            "_open": F.coalesce(
                F.last(F.when(F.size("marks") > 0, F.element_at("marks", -1)["opens"]), ignorenulls=True).over(earlier),
                F.lit(False),
            ),
        }
    )
    # A closing line still belongs to its session, so what it closes ends a row later.
    first = F.struct(F.lit(-1).cast("bigint").alias("at"), F.col("_open").alias("opens"))
    steps = F.transform(
        "marks", lambda m: F.struct((m["row"] + F.when(m["opens"], 0).otherwise(1)).alias("at"), m["opens"].alias("opens"))
    )
    rows = ("first_row", "last_row", "_width")
    parts = known.withColumn("_steps", F.concat(F.array(first), steps)).select(
        "_part", *rows, "_before", F.posexplode("_steps").alias("_i", "_step")
    )
    in_part = W.partitionBy("_part").orderBy("_i")
    opens = F.when((F.col("_i") > 0) & F.col("_step.opens"), 1).otherwise(0)
    openings = F.sum(opens).over(in_part.rowsBetween(W.unboundedPreceding, 0))
    until = F.coalesce(F.lead("_step.at").over(in_part), F.lit(_NEVER))
    number = F.col("_before") + openings - 1
    return parts.select(
        "_part", *rows,
        F.col("_step.at").alias("_from"),
        until.alias("_until"),
        F.when(F.col("_step.opens"), number).cast("bigint").alias(SESSION),
    ).filter("_from < _until")


def _bin(row: Column) -> Column:
    """The bin of a row of its part."""
    return F.floor((row - F.col("first_row")) / F.col("_width")).cast("bigint")


def _binned(segments: DataFrame) -> DataFrame:
    """(_part, _bin, _from, _until, session): a stretch once for each bin that it reaches into.

    That is once, and once more for each bin that begins within it, so bins add no more rows than there are bins.
    """
    inside = segments.filter((F.col("_from") <= F.col("last_row")) & (F.col("_until") > F.col("first_row")))
    bins = F.sequence(
        _bin(F.greatest("_from", "first_row")), _bin(F.least(F.col("_until") - 1, F.col("last_row")))
    )
    return inside.select("_part", F.explode(bins).alias("_bin"), "_from", "_until", SESSION)


def worker_sessions(
    lines: DataFrame, *, value: str = "value", keys: Sequence[str] = SHARD_KEYS, on_error: str = "fail"
) -> DataFrame:
    """``lines`` (read with ``places``) with ``session``, numbered from 0 in each shard.

    The line that opens a session and the one that closes it belong to it. An
    ``initialize`` while a session is open starts the next: the worker was
    lost. A line outside any session fails the query; with
    ``on_error="null"`` its session is NULL.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    keys = list(keys)
    lines = lines.filter(~F.col(value).isin("", "\r"))
    span = F.col("last_row") - F.col("first_row") + 1
    width = F.ceil(span * MARKS_PER_BIN / (F.size("marks") + 1)).cast("bigint")
    # Parts get numbers: paths are long, and would be most of what is broadcast.
    marks = materialize(
        session_marks(lines, value=value, keys=keys).withColumns({"_part": F.monotonically_increasing_id(), "_width": width})
    )
    parts = marks.select(*keys, "file", "block", "_part", "first_row", "_width")
    placed = ordered_lookup(lines, parts, [*keys, "file", "block"])[0].withColumn("_bin", _bin(F.col("row")))
    joined = ordered_lookup(placed, _binned(_segments(marks, keys)), ["_part", "_bin"])[0]
    found = joined.filter((F.col("row") >= F.col("_from")) & (F.col("row") < F.col("_until")))
    found = found.select(*lines.columns, SESSION)
    if on_error == "fail":
        outside = F.raise_error(F.concat(F.lit("a line outside any session of shard "), F.concat_ws("/", *keys)))
        found = found.withColumn(SESSION, F.coalesce(F.col(SESSION), outside.cast("bigint")))
    return found


def session_bounds(lines: DataFrame, *, value: str = "value", keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """One row per session of ``worker_sessions``' result: its start position, its end's wire reason, and its deliveries.

    The reason of a session that has not ended, or whose worker was lost, is NULL; a requested stop counts as ``ZOMBIE``.
    """
    keys = [*keys, SESSION]
    action = F.get_json_object(value, "$.action")
    start = F.get_json_object(value, "$.sequenceNumber")
    reason = F.when(action == "shutdownRequested", "ZOMBIE").when(action == "shutdown", F.get_json_object(value, "$.reason"))
    return lines.groupBy(*keys).agg(
        F.max(F.when(action == "initialize", start)).alias("start"),
        F.max(reason).alias("reason"),
        F.count(F.when(action == "processRecords", 1)).alias("n_deliveries"),
    )


__all__ = ["LINE_PLACE", "SESSION", "SESSION_KEYS", "session_bounds", "session_marks", "worker_sessions"]
