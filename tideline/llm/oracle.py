"""The same results as DuckDB SQL, where SQL can express them.

Left out: op3 and op13 (byte pair merges), op6 and op9 (fitted models), op8 (XXH64), op11 (suffix trees);
those are tested against brute force, a round trip or held-out rows.
"""

from __future__ import annotations

from tideline.llm import fingerprints, mixing, secret_scan, sharding, warc

OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('{warc.BASE32}',
           CAST(((CAST('0x' || substr(h, CAST((j // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS INT)) & 31) + 1 AS INT),
           1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (html)"""

OP4 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


def _op1() -> str:
    """Matches by splitting; windows in full, where the operator counts step by step."""
    assign, access, hex_ = (p.replace("'", "''") for p in (secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX))
    kinds = [("assign", assign, 2), ("access", access, 0), ("hex", hex_, 0)]
    kinds += [(c.kind, c.pattern, 0) for c in secret_scan.CLASSES]

    def found(rank: int, kind: str, pattern: str, group: int) -> str:
        return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(t, '{pattern}', 0) AS hits,
            regexp_extract_all(t, '{pattern}', {group}) AS vals, regexp_split_to_array(t, '{pattern}') AS gaps FROM d
            WHERE regexp_matches(t, '{pattern}')"""

    allow = " OR ".join(f"regexp_matches(val, '{p}')" for p in secret_scan.ALLOW)
    w = secret_scan.WINDOW
    classes = " ".join(f"WHEN '{c.kind}' THEN {c.threshold}" for c in secret_scan.CLASSES)
    folded = ", ".join(f"'{c.kind}'" for c in secret_scan.CLASSES if c.fold)
    musts = " ".join(
        f"WHEN '{c.kind}' THEN {' AND '.join([f"regexp_matches(val, '{p}')" for p in c.must] or ['true'])}" for c in secret_scan.CLASSES
    )
    # Class by class: what an earlier one has found is not reported again.
    steps, so_far = [], []
    for i, c in enumerate(secret_scan.CLASSES):
        apart = "".join(f" AND NOT EXISTS (SELECT 1 FROM z{j} AS o WHERE o.doc_id = y.doc_id AND o.s < y.ce AND y.cs < o.e)" for j in range(i))
        steps.append(f"z{i} AS (SELECT doc_id, rank, kind, s, e FROM y WHERE kind = '{c.kind}'{apart}),")
        so_far.append(f"SELECT * FROM z{i}")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(found(i, *k) for i, k in enumerate(kinds))}),
n AS (SELECT doc_id, rank, kind, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS i FROM f),
m AS (SELECT doc_id, rank, kind, vals[i] AS val, length(hits[i]) AS size,
             CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM n),
b AS (SELECT doc_id, rank, kind, s, s + size AS e FROM m
      WHERE rank < 3 AND (kind <> 'assign' OR length(val) >= {secret_scan.ASSIGN_VALUE_CHARS})),
c AS (SELECT *, CASE WHEN kind IN ({folded}) THEN lower(val) ELSE val END AS v FROM m
      WHERE rank >= 3 AND NOT ({allow}) AND CASE kind {musts} END
        AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = m.doc_id AND b.s < m.s + m.size AND m.s < b.e)),
x AS (SELECT *, list_filter(range(0, length(v) - {w - 1}), lambda k:
          list_aggregate(string_split(substr(v, k + 1, {w}), ''), 'entropy') >= CASE kind {classes} END) AS high FROM c),
y AS (SELECT doc_id, rank, kind, s + list_min(high) AS s, s + list_max(high) + {w} AS e, s AS cs, s + size AS ce FROM x
      WHERE len(high) > 0),
{' '.join(steps)}
a AS (SELECT * FROM b UNION ALL {' UNION ALL '.join(so_far)}),
r AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM a GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (doc_id)"""


def _op7(shards: int = 40) -> str:
    n = sharding.HEX_DIGITS
    return f"""
WITH tbl AS (SELECT list(v ORDER BY i) AS c FROM (SELECT i, list_reduce([i] || list_transform(range(8), lambda k: CAST(0 AS BIGINT)),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i))),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, CAST(strlen(t) + 16 AS BIGINT) AS size,
        list_transform(list_filter(string_split(regexp_replace(hex(encode(t)), '(..)', '\\1,', 'g'), ','), lambda x: x <> ''),
                       lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM d),
q AS (SELECT doc_id, size, xor(list_reduce([CAST(4294967295 AS BIGINT)] || bytes,
        lambda a, b: xor(a >> 8, c[CAST((xor(a, b) & 255) + 1 AS INT)])), 4294967295) AS text_crc32 FROM k, tbl),
u AS (SELECT *, list_transform(range({shards + 1}), lambda i:
        -ln((CAST(CAST('0x' || substr(md5(doc_id || '/' || i), 1, {n}) AS BIGINT) AS DOUBLE) + 0.5) / {float(16**n)})) AS score FROM q),
b AS (SELECT *, CAST(list_position(score, list_min(score[1:{shards}])) - 1 AS INT) AS shard,
             CAST(list_position(score, list_min(score)) - 1 AS INT) AS grown_shard FROM u)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(doc_id || '/' || text_crc32), 1, 16), doc_id) - 1 AS slot FROM b"""


def _op10() -> str:
    w, r = mixing.WEIGHTS, mixing.REPEATS
    weights = ", ".join(str(x) for x in w)
    return f"""
WITH d AS (SELECT doc_id, coalesce('0' || source, '1') AS g, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(text, '')), 1, 16) AS h FROM documents),
s AS (SELECT g, CAST(sum(size) AS BIGINT) AS source_size, [{weights}][(row_number() OVER (ORDER BY g) - 1) % {len(w)} + 1] AS w
      FROM d GROUP BY g),
t AS (SELECT *, CAST(source_size * {r} AS DOUBLE) AS lim, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / w, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY lim / w, g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM t),
a AS (SELECT arg_min(level, (lim / w, g)) AS level FROM l WHERE level * w <= lim),
p AS (SELECT g, source_size, total, least(lim, a.level * w) AS target FROM l, a),
z AS (SELECT CAST(greatest(1, ceil(max(total) / {mixing.SLOTS})) AS BIGINT) AS block, CAST(max(total) AS BIGINT) AS total FROM p),
v AS (SELECT p.*, z.block, CASE WHEN target > 0 THEN greatest(target,
             least(greatest(target, {float(mixing.FEWEST_SLOTS)}), {float(mixing.LEAST_SLOTS)}) * z.block) ELSE 0 END AS part,
             CASE WHEN target > 0 THEN CAST(greatest(round(target), 1) AS BIGINT) ELSE 0 END AS quota FROM p, z),
i AS (SELECT *, sum(part) OVER (ORDER BY g) / sum(part) OVER () AS hi,
             (sum(part) OVER (ORDER BY g) - part) / sum(part) OVER () AS lo FROM v),
n AS (SELECT unnest(range(CAST(ceil(max(z.total) / max(z.block)) + ceil(sum((part - target) / i.block)) AS BIGINT))) AS slot FROM i, z),
x AS (SELECT slot, ((slot + 1) * CAST({mixing.GOLDEN!r} AS DOUBLE)) % 1.0 AS pt FROM n),
y AS (SELECT slot, g, row_number() OVER (PARTITION BY g ORDER BY slot) - 1 AS rank FROM x JOIN i ON pt >= lo AND pt < hi),
m AS (SELECT g, count(*) AS blocks FROM y GROUP BY g),
o AS (SELECT d.*, i.source_size, i.target, i.quota, coalesce(m.blocks, 0) AS blocks,
             CAST(sum(size) OVER (PARTITION BY d.g ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
      FROM d JOIN i USING (g) LEFT JOIN m USING (g))
SELECT doc_id, size, o.source_size, target,
       CAST(list_sum(list_transform(range({r}), lambda e: greatest(0, least(size, quota - (e * source_size + start))))) AS BIGINT) AS taken,
       CASE WHEN size > 0 THEN y.slot END AS first_slot
FROM o LEFT JOIN y ON y.g = o.g AND y.rank = ((o.start + 1) * o.blocks - 1) // greatest(o.quota, 1) AND o.start < o.quota"""


def _op12() -> str:
    k, digits, top = fingerprints.SHINGLE_WORDS, fingerprints.HEX_DIGITS, fingerprints.limit(fingerprints.FRACTION)

    def sketch(text: str) -> str:
        words = f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
        return f"""(SELECT CASE WHEN len(low) > 0 OR len(h) = 0 THEN list_sort(list_distinct(low)) ELSE [list_min(h)] END FROM
            (SELECT h, list_filter(h, lambda x: x < '{top}') AS low FROM (SELECT CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE
                list_transform(range(greatest(len(w) - {k - 1}, 1)), lambda i: substr(md5(array_to_string(w[i + 1:i + {k}], ' ')), 1, {digits})) END AS h
                FROM (SELECT {words} AS w))))"""

    def near(a: str, b: str, jaccard: bool) -> str:
        shared = f"CAST(len(list_intersect({a}, {b})) AS DOUBLE)"
        of, some = (f"(len({a}) + len({b}) - {shared})", f"len({a}) + len({b})") if jaccard else (f"len({a})", f"len({a})")
        return f"CASE WHEN {some} > 0 THEN {shared} / {of} WHEN len({b}) > 0 THEN 0.0 ELSE 1.0 END"

    return f"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) - 1 AS pos
           FROM documents),
p AS (SELECT u.doc_id, u.t, CAST(length(u.t) AS BIGINT) AS n_chars, n.doc_id AS next_id, n.t AS nt,
             substr(u.t, 1, length(u.t) - length(u.t) // 2) || substr(n.t, 1, length(u.t) // 2) AS edited
      FROM u JOIN u AS n ON n.pos = (u.pos + 1) % (SELECT count(*) FROM u)),
k AS (SELECT *, {sketch("t")} AS s, {sketch("edited")} AS e, {sketch("nt")} AS n FROM p)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(s, ',') AS fingerprint,
       array_to_string(e, ',') AS edited_fingerprint, {near("s", "e", False)} AS near_edited, {near("s", "n", False)} AS near_next,
       next_id, {near("s", "e", True)} AS jaccard_edited, {near("s", "n", True)} AS jaccard_next FROM k"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_secret_scans": _op1(),
        "op2_warc": OP2,
        "op4_exact_dedup": OP4,
        "op5_top_k": OP5,
        "op7_sharding": _op7(),
        "op10_mixing": _op10(),
        "op12_fingerprints": _op12(),
    }
