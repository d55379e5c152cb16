"""The same results in plain SQL, for checking the queries against another engine."""

from __future__ import annotations

from tideline.plans.queries import (
    CAPACITY_BYTES,
    DOCS_PER_BATCH,
    DOCS_PER_LANE,
    EVENTS_PER_REQUEST,
    HOUR,
    NOISE,
    SESSION_EVENTS,
    SUMMARY_BYTES,
)
from tideline.plans.stream_queries import EVENT_MS, LANDINGS

EVENTS = """
e AS (SELECT event_id, 'shard-' || (user_id % 5) AS shard_id, CAST(user_id AS VARCHAR) AS partition_key,
             CAST(event_id AS VARCHAR) AS base, epoch_us(ts) // 1000 AS arrival_ms, event_type, value, props
      FROM events)
"""

LINES = """
l AS (SELECT 'shard-' || (l_orderkey % 5) AS shard_id, l_orderkey, CAST(l_orderkey AS VARCHAR) AS base,
             CAST(l_partkey AS VARCHAR) AS partition_key, l_quantity,
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '|' || l_returnflag || '|' || l_linestatus AS data,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                l_quantity, l_extendedprice) - 1 AS user_sub,
             count(*) OVER (PARTITION BY l_orderkey) AS user_total
      FROM lineitem)
"""

DOCS = f"""
d AS (SELECT doc_id, lang, source AS pk, CASE WHEN doc_id % 3 <> 0 THEN lang END AS ehk, text,
             strlen(source) AS pk_len, strlen(text) AS data_len,
             CASE WHEN doc_id % 3 <> 0 THEN strlen(lang) END AS ehk_len,
             CAST(floor(doc_id / {DOCS_PER_BATCH}) AS BIGINT) AS batch
      FROM documents)
"""


def varint(n: str) -> str:
    return f"CAST(ceil(length(ltrim(bin({n}))) / 7.0) AS BIGINT)"


def delimited(n: str) -> str:
    return f"(1 + {varint(n)} + {n})"


def added_bytes(pk_new: str, pk_index: str, ehk_new: str, ehk_index: str) -> str:
    inner = (
        f"(1 + {varint(pk_index)} + CASE WHEN ehk_len IS NULL THEN 0 ELSE 1 + {varint(ehk_index)} END"
        f" + {delimited('data_len')})"
    )
    return (
        f"(CASE WHEN {pk_new} THEN {delimited('pk_len')} ELSE 0 END"
        f" + CASE WHEN ehk_len IS NOT NULL AND {ehk_new} THEN {delimited('ehk_len')} ELSE 0 END"
        f" + {delimited(inner)})"
    )


def lone_bytes() -> str:
    return added_bytes("true", "0", "true", "0")


NUMBERED = f"WITH {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1 AS counter FROM e)"


def gate(source: str, interval: int | str, capacity: int | None, extra: str) -> str:
    """Recursive walk over ``ev(shard_id, rn, clock, weight, needs, ...)``."""
    full = f"(ev.weight > 0 AND g.held > 0 AND g.held + ev.weight > {capacity})" if capacity is not None else "false"
    due = f"(ev.clock - g.last >= {interval} AND (NOT ev.needs OR g.held + ev.weight > 0))"
    return f"""
    WITH RECURSIVE {source},
    g AS (
      SELECT shard_id, rn, CASE WHEN f = 'interval' THEN clock ELSE start END AS last,
             CASE WHEN f = 'interval' THEN 0 ELSE weight END AS held,
             CAST(0 AS BIGINT) AS batch_no, CAST(CASE WHEN f = 'interval' THEN 1 ELSE 0 END AS BIGINT) AS closed, f AS fired
      FROM (SELECT *, clock AS start, CASE WHEN 0 >= {interval} AND (NOT needs OR weight > 0) THEN 'interval' END AS f
            FROM ev WHERE rn = 1)
      UNION ALL
      SELECT ev.shard_id, ev.rn,
             CASE WHEN {full} OR {due} THEN ev.clock ELSE g.last END,
             CASE WHEN {full} THEN ev.weight WHEN {due} THEN 0 ELSE g.held + ev.weight END,
             CASE WHEN {full} THEN g.closed + 1 ELSE g.closed END,
             CASE WHEN {full} OR {due} THEN g.closed + 1 ELSE g.closed END,
             CASE WHEN {full} THEN 'full' WHEN {due} THEN 'interval' END
      FROM g JOIN ev ON ev.shard_id = g.shard_id AND ev.rn = g.rn + 1
    )
    {extra}
    """


def event_gate(interval: int, capacity: int | None, weight: str, extra: str) -> str:
    source = f"""{EVENTS},
    ev AS (SELECT shard_id, base, arrival_ms, arrival_ms AS clock, {weight} AS weight, false AS needs,
                  row_number() OVER (PARTITION BY shard_id ORDER BY event_id) AS rn FROM e)"""
    return gate(source, interval, capacity, extra)


NOT_VIEW = "CASE WHEN event_type = 'view' THEN 0 ELSE 1 END"
JOINED = "FROM g JOIN ev ON ev.shard_id = g.shard_id AND ev.rn = g.rn"

HEARTBEATS = f"""{EVENTS},
u AS (SELECT shard_id, 'record' AS kind, base, event_id, arrival_ms FROM e WHERE event_type <> 'view'
      UNION ALL
      SELECT shard_id, 'heartbeat', NULL, NULL, arrival_ms + 2700000 FROM e WHERE event_type = 'view'),
ev AS (SELECT shard_id, kind, base, arrival_ms, arrival_ms AS clock, CASE WHEN kind = 'record' THEN 1 ELSE 0 END AS weight,
              kind = 'heartbeat' AS needs,
              row_number() OVER (PARTITION BY shard_id ORDER BY arrival_ms, CASE WHEN kind = 'heartbeat' THEN 0 ELSE 1 END,
                                 event_id) AS rn
       FROM u)"""

ROUNDS = f"""{EVENTS},
c AS (SELECT *, CAST(floor(event_id / 40) + event_id * 13 % 7 AS BIGINT) AS done_round FROM e),
r AS (SELECT *, max(done_round) OVER (PARTITION BY shard_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS ready FROM c),
h AS (SELECT shard_id, ready AS round, max(event_id) AS reached FROM r GROUP BY 1, 2)"""

SCHEDULE = f"""{ROUNDS},
o AS (SELECT shard_id, done_round AS round, max(arrival_ms) AS clock_ms FROM c GROUP BY 1, 2),
ev AS (SELECT o.shard_id, o.round, o.clock_ms,
              max(o.clock_ms) OVER (PARTITION BY o.shard_id ORDER BY o.round ROWS UNBOUNDED PRECEDING) AS clock,
              CASE WHEN h.reached IS NULL THEN 0 ELSE 1 END AS weight, true AS needs,
              max(h.reached) OVER (PARTITION BY o.shard_id ORDER BY o.round ROWS UNBOUNDED PRECEDING) AS reached,
              row_number() OVER (PARTITION BY o.shard_id ORDER BY o.round) AS rn
       FROM o LEFT JOIN h ON h.shard_id = o.shard_id AND h.round = o.round)"""

PACK = f"""
WITH RECURSIVE {DOCS},
n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM d),
x AS (SELECT *, i // {DOCS_PER_LANE} AS lane, i % {DOCS_PER_LANE} AS k, {lone_bytes()} AS lone FROM n),
p AS (
  SELECT lang, lane, k, [pk] AS pks, CASE WHEN ehk IS NULL THEN CAST([] AS VARCHAR[]) ELSE [ehk] END AS ehks,
         lone AS size, pk_len AS own, CAST(0 AS BIGINT) AS batch_no, CAST(0 AS BIGINT) AS sub
  FROM x WHERE k = 0
  UNION ALL
  SELECT lang, lane, k,
         CASE WHEN fits THEN CASE WHEN pk_new THEN list_append(pks, pk) ELSE pks END ELSE [pk] END,
         CASE WHEN fits THEN CASE WHEN ehk IS NOT NULL AND ehk_new THEN list_append(ehks, ehk) ELSE ehks END
              WHEN ehk IS NULL THEN CAST([] AS VARCHAR[]) ELSE [ehk] END,
         CASE WHEN fits THEN size + add ELSE lone END,
         CASE WHEN fits THEN own ELSE pk_len END,
         CASE WHEN fits THEN batch_no ELSE batch_no + 1 END,
         CASE WHEN fits THEN sub + 1 ELSE 0 END
  FROM (SELECT *, 20 + own + size + add <= {SUMMARY_BYTES} - 64 AS fits
        FROM (SELECT *, {added_bytes("pk_new", "pk_index", "ehk_new", "ehk_index")} AS add
              FROM (SELECT x.*, p.pks, p.ehks, p.size, p.own, p.batch_no, p.sub,
                           NOT list_contains(p.pks, x.pk) AS pk_new,
                           CASE WHEN list_contains(p.pks, x.pk) THEN list_position(p.pks, x.pk) - 1 ELSE len(p.pks) END AS pk_index,
                           NOT list_contains(p.ehks, coalesce(x.ehk, '')) AS ehk_new,
                           CASE WHEN list_contains(p.ehks, coalesce(x.ehk, '')) THEN list_position(p.ehks, coalesce(x.ehk, '')) - 1
                                ELSE len(p.ehks) END AS ehk_index
                    FROM p JOIN x ON x.lang = p.lang AND x.lane = p.lane AND x.k = p.k + 1)))
)"""

#: The same for all documents as one producer without lanes.
PACK_HOT = (
    PACK.replace("PARTITION BY lang ORDER BY doc_id", "ORDER BY doc_id")
    .replace("x AS (SELECT *, ", "x AS (SELECT * REPLACE ('all' AS lang), ")
    .replace(f"i // {DOCS_PER_LANE} AS lane, i % {DOCS_PER_LANE} AS k", "0 AS lane, i AS k")
)

ROUNDTRIP = f"""{PACK}
SELECT x.lang, x.lane, p.batch_no, p.sub AS user_sub, count(*) OVER (PARTITION BY x.lang, x.lane, p.batch_no) AS user_total,
       x.pk AS partition_key, md5(x.text) AS digest
FROM p JOIN x ON x.lang = p.lang AND x.lane = p.lane AND x.k = p.k"""

DEAGGREGATE = f"""WITH {LINES}
SELECT shard_id, base, CAST(0 AS BIGINT) AS sub, user_sub, user_total, partition_key, data FROM l"""


def frontier_lines(extra: str) -> str:
    return f"""WITH {LINES},
    s AS (SELECT shard_id, min(CASE WHEN l_quantity >= 50 THEN l_orderkey * 1000 + user_sub END) AS opened FROM l GROUP BY 1),
    f AS (SELECT s.shard_id, max(CASE WHEN (s.opened IS NULL OR l_orderkey * 1000 + user_sub < s.opened) {extra}
                                 THEN l_orderkey * 1000 + user_sub END) AS reached
          FROM s JOIN l ON l.shard_id = s.shard_id GROUP BY 1)
    SELECT f.shard_id, l.base, l.user_sub, l.user_total
    FROM f LEFT JOIN l ON l.shard_id = f.shard_id AND l.l_orderkey * 1000 + l.user_sub = f.reached"""


WHOLE = "AND user_sub = user_total - 1"


def all_oracles() -> dict[str, str]:
    found = _oracles()
    found["stream_process_shards"] = found["process_shards"]
    # One shard for all events, and many chunks in it: the result does not know about chunks.
    for name in ("arrival_counter", "flush_by_interval", "flush_by_bytes", "frontier_history", "process_shards"):
        found[f"{name}_hot"] = found[name].replace("'shard-' || (user_id % 5) AS shard_id", "'all' AS shard_id")
    found["stream_flush_hot"] = event_gate(
        6 * HOUR, 12, NOT_VIEW,
        f"""SELECT g.shard_id, ev.base, g.batch_no, g.fired, CASE WHEN ev.weight > 0 THEN
            CAST(sum(ev.weight) OVER (PARTITION BY g.shard_id ORDER BY g.rn ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) END AS counter {JOINED}""",
    ).replace("'shard-' || (user_id % 5) AS shard_id", "'all' AS shard_id")
    found["stream_processor_checkpoints"] = found["processor_checkpoints"]
    found["stream_shard_counters"] = found["shard_counters"]
    return found


LANDED = f"""{EVENTS},
ld AS (SELECT *, event_id * {LANDINGS} // (SELECT max(event_id) + 1 FROM events) AS landing FROM e)"""

#: Rounds are landings, one record in seven completes a landing late; shard 0 completes nothing in the last two.
STREAM_SCHEDULE = f"""{LANDED},
cn AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1 AS counter,
              landing + CASE WHEN event_id % 7 = 3 AND landing < {LANDINGS - 1} THEN 1 ELSE 0 END AS done_round FROM ld),
cr AS (SELECT *, max(CASE WHEN shard_id = 'shard-0' AND done_round >= {LANDINGS - 2} THEN 1000000 ELSE done_round END)
                 OVER (PARTITION BY shard_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS ready FROM cn),
h AS (SELECT shard_id, ready AS round, max(event_id) AS reached FROM cr WHERE ready < 1000000 GROUP BY 1, 2),
o AS (SELECT shard_id, landing AS round, max(event_id) * {EVENT_MS} AS clock_ms FROM ld GROUP BY 1, 2),
ev AS (SELECT o.shard_id, o.round, o.clock_ms, o.clock_ms AS clock,
              CASE WHEN h.reached IS NULL THEN 0 ELSE 1 END AS weight, true AS needs,
              max(h.reached) OVER (PARTITION BY o.shard_id ORDER BY o.round ROWS UNBOUNDED PRECEDING) AS reached,
              row_number() OVER (PARTITION BY o.shard_id ORDER BY o.round) AS rn
       FROM o LEFT JOIN h ON h.shard_id = o.shard_id AND h.round = o.round)"""


def _oracles() -> dict[str, str]:
    noise = "|".join(f"(?:{p})" for p in NOISE)
    return {
        "parse_envelopes": f"""WITH {EVENTS},
            q AS (SELECT *, max(arrival_ms) OVER w - min(arrival_ms) OVER w AS delay_ms FROM e
                  WINDOW w AS (PARTITION BY shard_id, event_id // {EVENTS_PER_REQUEST}))
            SELECT shard_id, partition_key, base AS sequence_number, CAST(0 AS BIGINT) AS sub, arrival_ms, delay_ms,
                   base64(encode(props)) AS data FROM q""",
        "route_bad_lines": """SELECT CAST(event_id AS VARCHAR) AS line,
            CAST(CASE WHEN event_id % 13 < 4 THEN 1 ELSE 0 END AS BIGINT) AS routed,
            CASE WHEN event_id % 13 >= 4 THEN CAST(event_id AS VARCHAR) END AS sequence_number FROM events""",
        "delivery_heartbeats": f"""WITH {EVENTS}
            SELECT shard_id, arrival_ms, CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS BIGINT) AS n_records,
                   CASE WHEN event_id % 3 = 0 THEN event_id END AS delay_ms,
                   CAST(CASE WHEN event_id % 3 = 0 OR event_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS is_v2 FROM e""",
        "read_dir": f"""WITH {EVENTS},
            k AS (SELECT *, CASE WHEN event_id % 37 < 9 THEN '_' ELSE '' END || event_type || '-' || (event_id % 37) AS name FROM e),
            l AS (SELECT name, arg_max(props, (shard_id, event_id)) AS data FROM k GROUP BY name)
            SELECT name, CAST(strlen(data) AS BIGINT) AS n_bytes, md5(data) AS digest FROM l""",
        "resume_from_markers": f"""WITH {EVENTS}
            SELECT shard_id, base FROM e
            WHERE shard_id IN ('shard-0', 'shard-4') OR (shard_id = 'shard-3' AND event_id > 5000)""",
        "flush_batches": event_gate(
            6 * HOUR,
            None,
            "1",
            f"""SELECT shard_id, batch_no, base FROM (SELECT g.shard_id, g.batch_no, ev.base,
                max(g.closed) OVER (PARTITION BY g.shard_id) AS closed {JOINED}) WHERE batch_no < closed""",
        ),
        "dump_latest_per_key": f"""WITH {EVENTS},
            k AS (SELECT *, event_type || '-' || (event_id % 37) AS key FROM e)
            SELECT key AS partition_key, arg_max(shard_id, (shard_id, event_id)) AS shard_id,
                   arg_max(base, (shard_id, event_id)) AS base, arg_max(props, (shard_id, event_id)) AS data
            FROM k GROUP BY key""",
        "union_streams": f"""WITH {EVENTS}, {LINES}
            SELECT 'clicks' AS stream_name, shard_id, base, CAST(NULL AS BIGINT) AS user_sub, partition_key FROM e
            UNION ALL SELECT 'orders', shard_id, base, user_sub, partition_key FROM l""",
        "initial_position": f"""WITH {EVENTS},
            t AS (SELECT shard_id, max(event_id) AS tip FROM e
                  WHERE arrival_ms < 1705276800000 AND shard_id <> 'shard-4' GROUP BY 1)
            SELECT e.shard_id, base, props AS data FROM e LEFT JOIN t ON t.shard_id = e.shard_id
            WHERE tip IS NULL OR event_id > tip""",
        "resume_from_checkpoint": f"""WITH {LINES},
            c AS (SELECT shard_id, max(l_orderkey) AS cp FROM l
                  WHERE l_orderkey < (SELECT avg(l_orderkey) FROM lineitem) AND shard_id <> 'shard-4' AND user_sub < 2
                  GROUP BY 1),
            m AS (SELECT c.shard_id, cp, max(user_sub) AS cp_sub, max(user_total) AS cp_total
                  FROM c JOIN l ON l.shard_id = c.shard_id AND l.l_orderkey = cp AND user_sub < 2 GROUP BY 1, 2)
            SELECT l.shard_id, base, user_sub, user_total FROM l LEFT JOIN m ON m.shard_id = l.shard_id
            WHERE cp IS NULL OR l_orderkey > cp OR (l_orderkey = cp AND cp_sub < cp_total - 1)""",
        "fetch_batches": f"{NUMBERED} SELECT shard_id, base, counter // 100 AS fetch FROM n",
        "encode_checkpoints": f"""WITH {LINES}
            SELECT base, user_sub, CASE WHEN l_orderkey % 2 = 0
              THEN '{{"action":"checkpoint","sequenceNumber":' || CASE WHEN user_sub > 0 THEN '"' || base || '"' ELSE 'null' END
                   || ',"subSequenceNumber":' || CASE WHEN user_sub > 0 THEN CAST(user_sub AS VARCHAR) ELSE 'null' END || '}}'
              ELSE '{{"action":"checkpoint","checkpoint":' || CASE WHEN user_sub > 0 THEN '"' || base || '"' ELSE 'null' END || '}}'
              END AS line FROM l""",
        "b64_decode": f"WITH {EVENTS} SELECT base AS sequence_number, props AS data FROM e",
        "decode_seqno": """SELECT event_id, CASE WHEN event_id % 10 = 3 THEN upper(event_type)
            WHEN event_id % 10 = 4 THEN repeat('7', 125) || event_id ELSE CAST(event_id AS VARCHAR) END AS base FROM events""",
        "stream_records": f"""WITH {EVENTS}
            SELECT 'events' AS stream_name, shard_id, partition_key, base, CAST(0 AS BIGINT) AS sub,
                   CAST(NULL AS BIGINT) AS user_sub, CAST(NULL AS BIGINT) AS user_total, arrival_ms,
                   CAST(0 AS BIGINT) AS delay_ms, props AS data FROM e""",
        "classify_format": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'aggregated' WHEN 1 THEN 'deflated'
            ELSE 'plain' END AS format FROM events""",
        "verify_checksum": """SELECT CAST(l_orderkey AS VARCHAR) AS base, count(*) AS n_records, CAST(1 AS BIGINT) AS intact,
            'aggregated' AS format FROM lineitem GROUP BY l_orderkey""",
        "is_sub_record": f"""WITH {LINES}
            SELECT base, user_sub, CAST(CASE WHEN user_sub < user_total - 1 THEN 1 ELSE 0 END AS BIGINT) AS is_sub FROM l""",
        "varint_size": f"""SELECT n, {varint("n")} AS n_bytes
            FROM (SELECT l_partkey * l_orderkey * l_suppkey AS n FROM lineitem)""",
        "record_size": f"""WITH {DOCS},
            f AS (SELECT *, min(doc_id) OVER (PARTITION BY lang, batch, pk) AS pk_first,
                         min(doc_id) OVER (PARTITION BY lang, batch, ehk) AS ehk_first FROM d),
            i AS (SELECT *, dense_rank() OVER (PARTITION BY lang, batch ORDER BY pk_first) - 1 AS pk_index,
                         doc_id = pk_first AS pk_new, doc_id = ehk_first AS ehk_new FROM f),
            j AS (SELECT lang, batch, ehk_first, row_number() OVER (PARTITION BY lang, batch ORDER BY ehk_first) - 1 AS ehk_index
                  FROM (SELECT DISTINCT lang, batch, ehk_first FROM f WHERE ehk IS NOT NULL)),
            a AS (SELECT i.*, coalesce(j.ehk_index, 0) AS ehk_index FROM i LEFT JOIN j
                  ON j.lang = i.lang AND j.batch = i.batch AND j.ehk_first = i.ehk_first AND i.ehk IS NOT NULL)
            SELECT doc_id, {added_bytes("pk_new", "pk_index", "ehk_new", "ehk_index")} AS n_bytes FROM a""",
        "ignored_records": f"""WITH {EVENTS} SELECT shard_id, base,
            row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1 AS counter FROM e WHERE event_type <> 'view'""",
        "noise_filter": f"""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
            WHERE line <> '' AND NOT regexp_matches(line, '{noise}')""",
        "deaggregate": DEAGGREGATE,
        "deaggregate_deflated": DEAGGREGATE,
        "pack_roundtrip": ROUNDTRIP,
        "pack_deflated": ROUNDTRIP,
        "pack_summary": f"""{PACK}
            SELECT p.lang, p.lane, batch_no, arg_min(pk, p.k) AS partition_key,
                   arg_min(ehk, p.k) FILTER (ehk IS NOT NULL) AS explicit_hash_key, count(*) AS n_records,
                   CAST(20 + max(size) + max(own) AS BIGINT) AS est_bytes
            FROM p JOIN x ON x.lang = p.lang AND x.lane = p.lane AND x.k = p.k GROUP BY 1, 2, 3""",
        "pack_hot": f"""{PACK_HOT}
            SELECT 'all' AS producer, batch_no, arg_min(pk, p.k) AS partition_key,
                   arg_min(ehk, p.k) FILTER (ehk IS NOT NULL) AS explicit_hash_key, count(*) AS n_records,
                   CAST(20 + max(size) + max(own) AS BIGINT) AS est_bytes
            FROM p JOIN x ON x.k = p.k GROUP BY 1, 2""",
        "key_dictionary": f"""WITH {DOCS},
            k AS (SELECT lang, batch, pk, min(doc_id) AS first FROM d GROUP BY 1, 2, 3)
            SELECT lang, batch, pk AS partition_key, row_number() OVER (PARTITION BY lang, batch ORDER BY first) - 1 AS key_index
            FROM k""",
        "pack_header": f"""WITH {DOCS} SELECT lang, batch, arg_min(pk, doc_id) AS partition_key,
            arg_min(ehk, doc_id) FILTER (ehk IS NOT NULL) AS explicit_hash_key, count(*) AS n_records FROM d GROUP BY 1, 2""",
        "oversize_records": f"""WITH {DOCS} SELECT doc_id, {lone_bytes()} AS lone_bytes FROM d WHERE {lone_bytes()} > 10000""",
        "arrival_counter": f"{NUMBERED} SELECT shard_id, base, counter FROM n",
        "count_checkpoints": f"""{NUMBERED} SELECT shard_id, base, counter // 11 AS checkpoint_no FROM n
            WHERE (counter + 1) % 11 = 0""",
        "latest_checkpoint": f"""WITH {LINES}
            SELECT 'lineitem' AS stream_name, shard_id, arg_max(base, (l_orderkey, user_sub)) AS base,
                   arg_max(user_sub, (l_orderkey, user_sub)) AS user_sub, arg_max(user_total, (l_orderkey, user_sub)) AS user_total,
                   count(*) AS n_records FROM l GROUP BY shard_id""",
        "flush_by_count": f"{NUMBERED} SELECT shard_id, base, counter // 64 AS batch_no FROM n",
        "flush_by_interval": event_gate(
            6 * HOUR, 12, NOT_VIEW, f"SELECT g.shard_id, ev.base, g.batch_no, g.fired {JOINED}"
        ),
        "heartbeat_flush": gate(
            HEARTBEATS, 4 * HOUR, 20, f"SELECT g.shard_id, ev.kind, ev.base, ev.arrival_ms, g.batch_no, g.fired {JOINED}"
        ),
        "frontier": f"""WITH {EVENTS},
            o AS (SELECT shard_id, min(event_id) FILTER (value >= 300) AS opened FROM e GROUP BY 1)
            SELECT e.shard_id, CAST(max(event_id) FILTER (opened IS NULL OR event_id < opened) AS VARCHAR) AS base
            FROM e JOIN o ON o.shard_id = e.shard_id GROUP BY 1""",
        "frontier_whole_records": frontier_lines(WHOLE),
        "frontier_subsequence": frontier_lines(""),
        "aggregated_frontier": frontier_lines(WHOLE),
        "stream_deaggregate": DEAGGREGATE,
        "stream_frontier": """SELECT 'all' AS shard_id, CAST(max(event_id) AS VARCHAR) AS base FROM events
            WHERE event_id < (SELECT coalesce(min(event_id), 1e18) FROM events WHERE value >= 450)""",
        "frontier_history": f"WITH {ROUNDS} SELECT shard_id, round, CAST(reached AS VARCHAR) AS base FROM h",
        "checkpoint_schedule": gate(
            SCHEDULE,
            12 * HOUR,
            None,
            f"SELECT g.shard_id, g.batch_no AS checkpoint_no, ev.round, ev.clock_ms, CAST(ev.reached AS VARCHAR) AS base {JOINED}"
            " WHERE g.fired IS NOT NULL",
        ),
        "final_checkpoints": f"""WITH {LINES}
            SELECT shard_id, 'terminate' AS reason, 'frontier' AS kind, arg_max(base, (l_orderkey, user_sub)) AS base,
                   arg_max(user_sub, (l_orderkey, user_sub)) AS user_sub, arg_max(user_total, (l_orderkey, user_sub)) AS user_total
            FROM l WHERE shard_id <> 'shard-4' GROUP BY shard_id
            UNION ALL SELECT 'shard-9', 'terminate', 'latest', NULL, NULL, NULL""",
        "stalled_shards": f"""WITH {EVENTS},
            g AS (SELECT shard_id, arrival_ms AS since_ms,
                         lead(arrival_ms) OVER (PARTITION BY shard_id ORDER BY event_id) AS until_ms FROM e)
            SELECT shard_id, since_ms, until_ms, until_ms - since_ms AS silent_ms FROM g WHERE until_ms - since_ms > {2 * HOUR}""",
        "shard_counters": f"""WITH {EVENTS}
            SELECT shard_id, count(*) FILTER (event_type <> 'view') AS n_records,
                   CAST(floor(count(*) FILTER (event_type <> 'view') / 11) AS BIGINT) AS n_checkpoints FROM e GROUP BY 1""",
        "process_shards": f"""WITH {EVENTS},
            s AS (SELECT *, strlen(props) AS size, CAST(sum(strlen(props)) OVER (PARTITION BY shard_id ORDER BY event_id
                         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_bytes FROM e)
            SELECT shard_id, base, n_bytes FROM s WHERE n_bytes // 1000 > (n_bytes - size) // 1000""",
        "processor_checkpoints": f"{NUMBERED} SELECT shard_id, base FROM n WHERE (counter + 1) % 11 = 0",
        "checkpoint_log": f"""{NUMBERED} SELECT shard_id, base,
            '{{"action":"checkpoint","sequenceNumber":"' || base || '","subSequenceNumber":0}}' AS line
            FROM n WHERE (counter + 1) % 11 = 0""",
        "session_counters": f"""WITH {EVENTS},
            b AS (SELECT *, event_id // {SESSION_EVENTS} AS block FROM e),
            n AS (SELECT *, dense_rank() OVER (PARTITION BY shard_id ORDER BY block) - 1 AS session,
                         row_number() OVER (PARTITION BY shard_id, block ORDER BY event_id) - 1 AS counter FROM b)
            SELECT shard_id, session, base, counter, CASE WHEN (counter + 1) % 11 = 0 THEN counter // 11 END AS checkpoint_no FROM n""",
        "flush_partial_tokens": event_gate(
            6 * HOUR,
            12,
            "1",
            f"""SELECT shard_id, base, batch_no, CAST(CASE WHEN last < closed THEN 1 ELSE 0 END AS BIGINT) AS done,
                CASE WHEN last < closed THEN last END AS done_round
                FROM (SELECT g.shard_id, ev.base, g.batch_no, max(g.closed) OVER (PARTITION BY g.shard_id) AS closed,
                             g.batch_no + CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS last {JOINED} JOIN e ON e.base = ev.base)""",
        ),
        "flush_by_bytes": event_gate(
            12 * HOUR, CAPACITY_BYTES,
            "CASE WHEN event_type = 'view' THEN 0 ELSE strlen(props) + strlen(partition_key) END",
            f"SELECT g.shard_id, ev.base, g.batch_no, g.fired {JOINED}",
        ),
        "stream_final_checkpoints": f"""WITH {LANDED},
            s AS (SELECT *, CAST(right(shard_id, 1) AS BIGINT) AS k, landing > CAST(right(shard_id, 1) AS BIGINT) + 1 AS again FROM ld),
            t AS (SELECT *, row_number() OVER (PARTITION BY shard_id, k <= 3 AND again ORDER BY event_id) AS n FROM s)
            SELECT shard_id, 'checkpoint' AS kind, base FROM t WHERE n % 11 = 0
            UNION ALL SELECT shard_id, 'final', CAST(max(event_id) AS VARCHAR) FROM s WHERE k <= 2 AND NOT again GROUP BY 1, 2""",
        "stream_checkpoint_schedule": gate(
            STREAM_SCHEDULE,
            f"(SELECT count(*) * {EVENT_MS} // 4 FROM events)",
            None,
            f"SELECT g.shard_id, g.batch_no AS checkpoint_no, ev.round, ev.clock_ms, CAST(ev.reached AS VARCHAR) AS base {JOINED}"
            " WHERE g.fired IS NOT NULL",
        ),
        "stream_flush": f"{NUMBERED} SELECT shard_id, base, counter, counter // 64 AS batch_no FROM n",
        "stream_end_to_end": f"""WITH {EVENTS}
            SELECT shard_id, CAST(max(event_id) AS VARCHAR) AS base FROM e WHERE event_type <> 'view' GROUP BY 1""",
        "flush_tokens": event_gate(
            6 * HOUR,
            None,
            "1",
            f"""SELECT g.shard_id, ev.base, g.batch_no,
                CAST(CASE WHEN g.batch_no < max(g.closed) OVER (PARTITION BY g.shard_id) THEN 1 ELSE 0 END AS BIGINT) AS done,
                CASE WHEN g.batch_no < max(g.closed) OVER (PARTITION BY g.shard_id) THEN g.batch_no END AS done_round {JOINED}""",
        ),
        "flush_log": event_gate(
            6 * HOUR,
            12,
            NOT_VIEW,
            f"""SELECT g.shard_id, CASE WHEN g.fired = 'full' THEN g.batch_no - 1 ELSE g.batch_no END AS batch_no, g.fired,
                ev.arrival_ms AS flushed_ms {JOINED} WHERE g.fired IS NOT NULL""",
        ),
    }
