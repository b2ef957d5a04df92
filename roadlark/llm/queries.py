"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlark.llm import (
    chunks,
    decontaminate,
    licenses,
    mixing,
    ngram_join,
    pages,
    quality,
    repair,
    secrets,
    suffixes,
    topk,
    trie,
    warc,
)
from roadlark.llm.common import Scratch, ordered_digests, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


SQL["op5_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(generate_series(1, len(a.q)), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 20 = 0
), r AS (
  SELECT query_id, vec_id, score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunks.removed(texts).select(
        "doc_id", "n_bytes", "n_spans", "n_repeated", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.classify(documents, labels)
    return scored.select("doc_id", "quality", "harmless", "keep")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(documents, benchmark)


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.removed(texts).select(
        F.col("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


# Dynamic programming turn by turn: the cheapest, then least edits into each state of the role order
# (0: nothing yet, 1: after s, 2: after u, 3: after a).
SQL["op11_repair"] = """
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), drawn AS (
  SELECT *, xor(list_reduce(list_concat([4294967295],
      list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 20 AS draw
  FROM raw
), live AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, (VALUES (0), (1)) v(copy) WHERE draw <> 0 AND (copy = 0 OR draw = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS i FROM live
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM placed
), conv AS (
  SELECT d.conv_id, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN (
    SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
  ) j ON j.conv_id IS NOT DISTINCT FROM d.conv_id
), ins(q, q2, paid, edits, turns) AS (
  VALUES (0, 0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
    (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:'])
), edit(q2, letter, needs, q3, price, named) AS (
  VALUES (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL),
    (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
    (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (3, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant')
), best(conv_id, i, q, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM conv
  UNION ALL
  SELECT conv_id, i, q3, x.cost, x.audit, x.said FROM (
    SELECT b.conv_id, j.i, e.q3, min({'cost': b.cost + n.paid + e.price + CASE WHEN j.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END,
      'audit': b.audit || n.edits || e.letter,
      'said': list_concat(b.said, n.turns, CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.named, j.role) || ':' || j.text] END)}) AS x
    FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i + 1 JOIN ins n ON n.q = b.q JOIN edit e ON e.q2 = n.q2
    WHERE (e.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (e.needs IS NULL OR e.needs = left(j.role, 1))
    GROUP BY b.conv_id, j.i, e.q3)
), done AS (
  SELECT c.conv_id, min({'cost': b.cost + n.paid, 'audit': b.audit || n.edits, 'said': list_concat(b.said, n.turns)}) AS x
  FROM conv c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n JOIN ins n ON n.q = b.q AND n.q2 IN (0, 3)
  GROUP BY c.conv_id
)
SELECT c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, CAST(d.x.cost AS BIGINT) AS cost, d.x.audit AS audit,
  sha256(array_to_string(d.x.said, chr(10))) AS repaired_sha256
FROM conv c JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"), Scratch(spark, "op12_trie"))


# DuckDB has no CRC-32: each byte of the id's digits takes eight shifts.
SQL["op12_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295],
      list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, t.pos + 1 AS depth, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)) + 1, t.role, t.text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN c b ON b.conv_id = c.base
), p AS (
  SELECT *, md5(string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM r
), q AS (
  SELECT conv_id, depth, node, words, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS above FROM p
  UNION ALL SELECT conv_id, 0, '', 0, NULL FROM c
), n AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(above) AS above, count(*) AS n_convs,
    any_value(words) AS words FROM q GROUP BY node
), k AS (
  SELECT n.*, (SELECT count(*) FROM n m WHERE m.above = n.node) AS n_children,
    (SELECT m.conv_id FROM n m WHERE m.node = n.above) AS parent_conv_id
  FROM n
), s AS (
  SELECT q.node, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((k.n_convs - 1) * k.words) AS saved
  FROM k JOIN q ON q.conv_id = k.conv_id AND q.depth <= k.depth GROUP BY q.node
), e AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM (
    SELECT conv_id, max_by(node, depth) AS node FROM q GROUP BY conv_id) GROUP BY node
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, k.parent_conv_id, k.n_convs, k.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM k JOIN s USING (node) LEFT JOIN e USING (node)
"""


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op13_warc")
    path = f"{scratch.root}/archives"
    warc.write(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read(spark, path, payloads=False), scratch)
    return warc.resolved(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# DuckDB has no base32: the digest's 160 bits are cut into letters of five.
SQL["op13_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, html, sha1(html) AS hex, octet_length(encode(html)) AS n,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS age,
    first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS newest
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex || '0', 1 + CAST(floor(i * 5 / 4) AS BIGINT), 2) AS BIGINT)
      >> CAST(3 - (i * 5) % 4 AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN age = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN age = 1 THEN NULL ELSE newest END AS refers_to
FROM d
"""


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11_repair")
    repaired = repair.repair(repair.damage(table(spark, sf_dir, "conversations")), scratch)
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = repaired.whole.withColumn("repaired_sha256", F.sha2(said, 256))
    pieces = repaired.pieces.select("conv_id", "part", "seg", F.when(F.size("roles") > 0, said).alias("piece"))
    digests = ordered_digests(pieces, ["conv_id"], ["part", "seg"], "piece", b"\n")
    digests = digests.select(F.col("conv_id").alias("id"), F.col("digest").alias("repaired_sha256"))
    large = repaired.large.join(digests, F.col("conv_id").eqNullSafe(F.col("id")))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return whole.select(columns).unionByName(large.select(columns))
