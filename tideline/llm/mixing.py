"""Mixing sources to target weights by a low-discrepancy schedule.

* Targets: all words are shared by weight; a source stops at ``repeats`` times
  its size, and what it cannot use is shared again by weight.
* Schedule: slot i maps the point frac((i + 1) * golden ratio) through the
  cumulative targets to a source. Any run of slots holds every source in
  proportion. Slots are ranked within their source.
* Blocks: a source's documents, shuffled by hash, form a stream of words, which
  starts anew when it ends, up to ``repeats`` times. The source's target, in
  whole words, is its quota: the stream up to there is cut evenly over the
  source's slots, rank r takes block r, so every source takes its target to the
  word. Blocks of all sources are of nearly equal size, but a source has
  ``LEAST_SLOTS`` slots at least, or one for each word of its target.

Everything is spread: slots and documents are ranked by bucket (see
``shared.running``), points find their source through bins, blocks join on
(source, rank). Single tasks only see one row per source.

Sources order by code point, NULL (a source of its own) last. NULL or empty
texts have no words and take none. Repeated rows are documents of their own;
equal ones are interchangeable. Reruns agree: every order is a hash of the
row. An empty table gives an empty result; so does a table without words, with
targets of zero. Other columns pass through ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.shared import bucket_bits, checkpointed, md5_bits, null_last, own_names, running, word_count
from tideline.operators.sizing import BROADCAST_BYTES

#: A block is this part of all words, one word at least.
SLOTS = 1 << 18
#: A source is due so many slots at least, or one for each word of its target, and ``FEWEST_SLOTS`` in any case.
#: Any interval that is due two slots or more gets one.
LEAST_SLOTS = 64
FEWEST_SLOTS = 4
BINS = 1 << 12
WEIGHTS = (1.0, 2.0, 3.0)
REPEATS = 3
GOLDEN = (math.sqrt(5) - 1) / 2
#: Bytes of text that one task orders when documents are emitted.
BUCKET_BYTES = 64 << 20
ROWS_PER_BUCKET = 1_000_000
#: About the bytes of text in a partition of the mixed documents; beyond ``MOST_RUNS`` of them, the larger number.
RUN_BYTES, LARGE_RUN_BYTES = 4 << 20, 256 << 20
MOST_RUNS = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(group, source_size, target, lo, hi) per source; lo and hi are its share of the unit interval.

    ``sizes`` has one row per source: group, source_size. Sharing what is
    left again and again ends where each target is the smaller of its limit
    and one level times its weight. In the order of limit / weight the level
    follows from running sums.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name = W.orderBy("group")
    names = sizes.withColumns(
        {
            "weight": F.element_at(
                F.array(*(F.lit(float(w)) for w in weights)),
                ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
            ),
            "limit": (F.col("source_size") * repeats).cast("double"),
            "total": F.sum("source_size").over(everything).cast("double"),
        }
    )
    rising = W.orderBy(F.col("limit") / F.col("weight"), "group")
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    leveled = names.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(rising.rowsBetween(W.currentRow, W.unboundedFollowing)),
    )
    # The first source whose limit the level does not exceed sets it for itself and all that follow.
    reached = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(reached, F.struct(F.col("limit") / F.col("weight"), F.col("group"), F.col("level")))).over(
        everything
    )["level"]
    target = F.least("limit", F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    share = F.sum("target").over(by_name.rowsBetween(W.unboundedPreceding, W.currentRow))
    whole = F.sum("target").over(everything)
    return (
        leveled.withColumn("target", target)
        .withColumns({"hi": F.try_divide(share, whole), "lo": F.try_divide(share - F.col("target"), whole)})
        .select("group", "source_size", "target", "lo", "hi")
    )


def block_words(total: int, slots: int = SLOTS) -> int:
    return max(1, -(-total // slots))


def with_quotas(targets: DataFrame, block: int) -> DataFrame:
    """``targets`` with lo and hi in proportion to slots, ``quota`` (the words that a source takes) and ``more``.

    ``more`` is by how many slots a source has more than its target is blocks.
    """
    by_name = W.orderBy("group").rowsBetween(W.unboundedPreceding, W.currentRow)
    due = F.least(F.greatest("target", F.lit(float(FEWEST_SLOTS))), F.lit(float(LEAST_SLOTS)))
    # In words: shares stay what they are, to the bit, where no source is due more slots.
    part = F.when(F.col("target") > 0, F.greatest("target", due * block)).otherwise(F.lit(0.0))
    share, whole = F.sum("_part").over(by_name), F.sum("_part").over(W.partitionBy())
    return (
        targets.withColumn("_part", part)
        .withColumns(
            {
                "hi": F.try_divide(share, whole),
                "lo": F.try_divide(share - F.col("_part"), whole),
                "quota": F.when(F.col("target") > 0, F.greatest(F.round("target"), F.lit(1.0))).otherwise(0).cast("bigint"),
                "more": (F.col("_part") - F.col("target")) / block,
            }
        )
        .drop("_part")
    )


def schedule(targets: DataFrame, n: int, bits: int | None = None, bin_count: int = BINS) -> DataFrame:
    """(slot, group, rank): the source of each of ``n`` slots, and its rank among the slots of that source."""
    point = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0))
    slots = targets.sparkSession.range(n).select(
        F.col("id").alias("slot"), point.alias("x"), F.floor(point * bin_count).alias("bin")
    )
    bins = (
        targets.filter("hi > lo")
        .select(
            "group",
            "lo",
            # The last source reaches to the end, however the sum was rounded.
            F.when(F.col("hi") == F.max("hi").over(W.partitionBy()), F.lit(2.0)).otherwise(F.col("hi")).alias("hi"),
        )
        .withColumn(
            "bin",
            F.explode(
                F.sequence(
                    F.floor(F.col("lo") * bin_count),
                    F.least(F.floor(F.col("hi") * bin_count), F.lit(bin_count).cast("bigint")),
                )
            ),
        )
    )
    placed = slots.join(bins, "bin").filter("x >= lo and x < hi").select("slot", "group")
    # Slots are their own order: leading bits of the left-aligned number cut them into buckets.
    width = max(1, n.bit_length())
    placed = placed.withColumn("_h", F.shiftleft("slot", 63 - width))
    ranked = running(placed, "group", "_h", ["slot"], F.lit(0), bits or min(width, 12))
    return ranked.select("slot", "group", F.col("pos").alias("rank"))


def _sized(df: DataFrame, text: str, source: str, key: str) -> DataFrame:
    return df.withColumns(
        {
            "size": word_count(F.col(text)),
            "group": null_last(F.col(source)),
            "_h": md5_bits(F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(text, F.lit("")))),
        }
    )


def _plan(sized: DataFrame, weights, repeats, slots) -> tuple[DataFrame, DataFrame]:
    """Per source (group, source_size, target, quota, blocks), and its slots."""
    sizes = checkpointed(sized.groupBy("group").agg(F.sum("size").cast("bigint").alias("source_size")))
    total, sources = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count(F.lit(1))).first()
    block = block_words(int(total), slots)
    targets = checkpointed(with_quotas(source_targets(sizes, weights, repeats), block))
    more = targets.agg(F.sum("more")).first()[0] or 0.0
    n = -(-int(total) // block) + math.ceil(more)
    bin_count = max(BINS, 1 << sources.bit_length())
    ranked = checkpointed(schedule(targets, n, bin_count=bin_count))
    blocks = ranked.groupBy("group").agg(F.count(F.lit(1)).alias("blocks"))
    plan = targets.join(blocks, "group", "left").fillna(0, ["blocks"]).drop("lo", "hi", "more")
    return checkpointed(plan), ranked


def _rank_at(at: Column) -> Column:
    """The rank whose words hold position ``at`` of a source's stream."""
    return F.floor(((at + 1) * F.col("blocks") - 1) / F.col("quota"))


def _begin_of(rank: Column) -> Column:
    """The position at which a rank's words begin."""
    return F.floor(rank * F.col("quota") / F.col("blocks"))


def _epochs(repeats: int) -> Column:
    """Passes of the stream in which a document may be taken: all that begin before its source's quota ends."""
    begins = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: e * F.col("source_size") + F.col("start"))
    return F.filter(begins, lambda at: at < F.col("quota"))


def mix_report(
    df: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    repeats: int = REPEATS,
    slots: int = SLOTS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot) per row of ``df``.

    Documents are cut to the blocks they lie in, blocks join the slots of
    their source and rank, and the words of the slots add up.
    """
    rows = checkpointed(
        _sized(df.select("doc_id", "source", "text"), "text", "source", "doc_id").select("doc_id", "group", "_h", "size")
    )
    plan, ranked = _plan(rows, weights, repeats, slots)
    largest = rows.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    bits = bucket_bits(largest, rows_per_bucket)
    placed = checkpointed(running(rows, "group", "_h", ["doc_id", "size"], F.col("size"), bits, plan))
    begin = placed.filter("size > 0").select(
        "group", "pos", "size", "quota", "blocks", F.explode(_epochs(repeats)).alias("at")
    )
    at, last, rank = F.col("at"), F.col("at") + F.col("size") - 1, F.col("rank")
    pieces = begin.withColumn("rank", F.explode(F.sequence(_rank_at(at), _rank_at(last)))).withColumn(
        "words", F.least(last + 1, _begin_of(rank + 1)) - F.greatest(at, _begin_of(rank))
    )
    pieces = pieces.select("group", "pos", "rank", "words").filter("words > 0")
    taken = (
        pieces.join(ranked, ["group", "rank"])
        .groupBy("group", "pos")
        .agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    )
    return placed.join(taken, ["group", "pos"], "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        "first_slot",
    )


def mix(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    repeats: int = REPEATS,
    slots: int = SLOTS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The mixed documents: a row for each pass that takes one, always whole.

    A source's blocks are its ranks 0 to b-1, so a pass takes a document or
    not; only the one at which the source's quota ends lies across. It is taken
    if at least half of it lies before, and in any case if it is the first:
    words are off the target by half a document at most, and no source with a target is left out.
    Columns are those of ``df``.

    Rows come in the order of the schedule: a pass stands at the slot in which
    its first word lies. Partitions are runs of slots, so each holds every source in proportion.
    """
    own, names = own_names(df)
    sized = _sized(own, names[text], names[source], names[key])
    narrow = checkpointed(sized.select("group", "_h", "size", F.octet_length(names[text]).alias("_bytes")))
    plan, ranked = _plan(narrow, weights, repeats, slots)
    plan = plan.select("group", "source_size", "quota", "blocks")
    largest, size = narrow.groupBy("group").agg(F.sum("_bytes").alias("b")).agg(F.max("b"), F.sum("b")).first()
    bits = bucket_bits(largest or 0, bucket_bytes)
    placed = running(sized, "group", "_h", [names[key], "size"], F.col("size"), bits, plan)
    passes = placed.filter("size > 0").withColumn("at", F.explode(_epochs(repeats)))
    taken = passes.filter((F.col("at") == 0) | (2 * (F.col("quota") - F.col("at")) >= F.col("size")))
    taken = taken.withColumn("rank", _rank_at(F.col("at")))
    n = ranked.count()
    ranked = F.broadcast(ranked) if n * 8 * len(ranked.columns) <= BROADCAST_BYTES else ranked
    runs = _runs(size or 0)
    ordered = (
        taken.join(ranked, ["group", "rank"])
        .repartitionById(runs, F.floor(F.col("slot") * runs / max(n, 1)).cast("int"))
        .sortWithinPartitions("slot", "at")
    )
    return ordered.select(*names.values()).toDF(*df.columns)


def _runs(size: int) -> int:
    """Partitions for mixed documents of ``size`` bytes, which are about as many as went in."""
    return max(1, min(MOST_RUNS, -(-size // RUN_BYTES)), -(-size // LARGE_RUN_BYTES))
