"""Records for tests and row-at-a-time restatements of what operators must do."""

from pyspark.sql import functions as F

from tideline.functions import base_key

RECORD_DDL = (
    "stream_name string, shard_id string, partition_key string, base string, sub bigint, "
    "user_sub bigint, user_total bigint, arrival_ms bigint"
)


def records(spark, rows, extra_ddl="", n_partitions=3):
    """Rows of (shard, base, user_sub, user_total, arrival_ms, *extra), shuffled over partitions."""
    full = [("s", r[0], "k", str(r[1]), 0, r[2], r[3], r[4], *r[5:]) for r in rows]
    ddl = RECORD_DDL + (", " + extra_ddl if extra_ddl else "")
    df = spark.createDataFrame(full, ddl).repartition(n_partitions)
    return df.withColumn("base_key", base_key("base")).withColumn("data", F.encode("base", "UTF-8"))


def walk_gate(rows, interval, capacity):
    """Rows of (clock, weight, needs) to (batch_no, fired), one after the other."""
    out, last, held, number, top = [], None, 0, 0, None
    for clock, weight, needs in rows:
        top = clock if top is None else max(top, clock)
        if last is None:
            last = top
        if weight and capacity is not None and held >= capacity:
            number += 1
            held, last = 1, top
            out.append((number, "full"))
            continue
        held += weight
        fire = interval is not None and top - last >= interval and (not needs or held > 0)
        out.append((number, "interval" if fire else None))
        if fire:
            number += 1
            held, last = 0, top
    return out


def walk_frontier(rows, subsequence):
    """Rows of (user_sub, user_total, done) in order to the index of the frontier."""
    reached = None
    for i, (sub, total, done) in enumerate(rows):
        if not done:
            break
        if subsequence or sub is None or total is None or sub >= total - 1:
            reached = i
    return reached
