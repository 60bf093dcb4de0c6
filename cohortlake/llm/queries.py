"""The registered queries of this subpackage, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import (
    conversation_repair, decontamination, extraction, filter_audit, metric_search, mixing, near_duplicates, packing, substrings, token_counts,
    toxicity, urls, vector_links,
)
from cohortlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS ord
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, source_size * 2 AS cap,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2) OVER b, 0)) / sum(w) OVER a AS lev
  FROM s WINDOW b AS (ORDER BY source_size * 1.0::DOUBLE / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    a AS (ORDER BY source_size * 1.0::DOUBLE / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT source, source_size, greatest(ceil(source_size / 524288), 1)::BIGINT AS shards,
    least(coalesce(first_value(CASE WHEN lev * w <= cap THEN lev END IGNORE NULLS) OVER (
      ORDER BY source_size * 1.0::DOUBLE / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * w, cap), cap)::DOUBLE AS target
  FROM l),
n AS (SELECT round(sum(target) / 32)::BIGINT AS seats, sum(target) AS total, count(*) AS k FROM t),
c AS (
  SELECT source, target, unnest(generate_series(
      greatest(floor(target / total * seats)::BIGINT - k, 0), floor(target / total * seats)::BIGINT + k)) AS i, seats, total, k
  FROM t, n WHERE target > 0),
q AS (
  SELECT source, count(*) + any_value(base) AS seats FROM (
    SELECT source, greatest(floor(target / total * seats)::BIGINT - k, 0) AS base, seats,
      sum(greatest(floor(target / total * seats)::BIGINT - k, 0)) FILTER (i = greatest(floor(target / total * seats)::BIGINT - k, 0)) OVER () AS given,
      row_number() OVER (ORDER BY target / (2 * i + 1) DESC, encode(source) NULLS LAST) AS r FROM c)
  WHERE r <= seats - given GROUP BY source),
p AS (
  SELECT d.*, t.source_size, t.target, coalesce(q.seats, 0) AS source_seats, (('0x' || ord[1:8])::BIGINT % t.shards) AS shard
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON d.source IS NOT DISTINCT FROM q.source),
h AS (SELECT source, shard, sum(size)::BIGINT AS line, any_value(source_seats)::BIGINT AS seats FROM p GROUP BY ALL),
hn AS (SELECT *, sum(line) OVER (PARTITION BY source) AS total, count(*) OVER (PARTITION BY source) AS k FROM h),
hc AS (
  SELECT *, greatest(floor(line / total * seats)::BIGINT - k, 0) AS base,
    unnest(generate_series(greatest(floor(line / total * seats)::BIGINT - k, 0), floor(line / total * seats)::BIGINT + k)) AS i
  FROM hn WHERE line > 0),
hq AS (
  SELECT source, shard, count(*) + any_value(base) AS won FROM (
    SELECT *, sum(base) FILTER (i = base) OVER (PARTITION BY source) AS given,
      row_number() OVER (PARTITION BY source ORDER BY line / (2 * i + 1) DESC, shard) AS r FROM hc)
  WHERE r <= seats - given GROUP BY ALL),
x AS (
  SELECT h.source, h.shard, line, ceil(line / 32)::BIGINT AS nb, least(coalesce(won, 0) * 32, line * 2)::BIGINT AS words,
    ('0x' || md5('mix-1:' || coalesce(h.source, 'null') || ':' || h.shard)[1:8])::BIGINT AS st
  FROM h LEFT JOIN hq ON h.source IS NOT DISTINCT FROM hq.source AND h.shard = hq.shard),
y AS (
  SELECT source, shard, line, CASE WHEN line > 0 THEN words // line ELSE 0 END AS passes,
    CASE WHEN line > 0 THEN words % line ELSE 0 END AS rest, CASE WHEN line > 0 THEN st % nb * 32 ELSE 0 END AS fr FROM x),
z AS (
  SELECT p.*, sum(size) OVER (PARTITION BY source, shard ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM p)
SELECT doc_id, size, source_size, target,
  (passes * size + greatest(least(e, least(fr + rest, line)) - greatest(e - size, fr), 0)
   + greatest(least(e, fr + rest - line) - greatest(e - size, 0), 0))::BIGINT AS taken
FROM z JOIN y ON z.source IS NOT DISTINCT FROM y.source AND z.shard = y.shard
"""


@query("op1_source_mix", MIX_SQL)
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


REPEATS_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
e AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i, len(ws) AS n, ws FROM w),
v AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again
  FROM e WHERE i + 19 <= n),
c AS (
  SELECT e.doc_id, e.i, e.word, coalesce(bool_or(v.again) OVER (
    PARTITION BY e.doc_id ORDER BY e.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM e LEFT JOIN v ON e.doc_id = v.doc_id AND e.i = v.i)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, (count(*) FILTER (c.gone))::BIGINT AS n_removed,
  sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (NOT c.gone), '')) AS kept_sha256
FROM w LEFT JOIN c ON w.doc_id = c.doc_id GROUP BY w.doc_id, w.ws
"""


@query("op7_substring_dedup", REPEATS_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(table(spark, sf_dir, "documents"))


@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.judge(docs.select("doc_id", "text"), labels).select(
        "doc_id", F.round("severity", 6).alias("severity"), "rejected"
    )


TOP_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op4_mtree_top_k", TOP_SQL)
def op4_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return metric_search.top_k(vectors, vectors.where("vec_id % 50 = 0"))


LINKS_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r(id, reach) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
  coalesce(c.component_id, e.vec_id) = e.vec_id AS kept, 1.0::DOUBLE AS recall
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.id
"""


@query("op6_embedding_near_dedup", LINKS_SQL)
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.near_duplicates(table(spark, sf_dir, "embeddings")).drop("search_recall", "completed")


LEAKS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
i AS (
  SELECT item_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM benchmark),
g AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS gram
  FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS k FROM i WHERE len(ws) > 0)),
e AS (SELECT r, ws, unnest(generate_series(1, len(ws))) AS k FROM d),
o AS (
  SELECT e.r, e.k, n.n, array_to_string(ws[k:k + n.n - 1], ' ') AS gram FROM e, (SELECT DISTINCT n FROM g) n WHERE k + n.n - 1 <= len(ws)),
h AS (SELECT o.r, o.k, o.n, g.item_id FROM o JOIN g ON o.n = g.n AND o.gram = g.gram),
c AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS w FROM (SELECT DISTINCT r, k, n FROM h)) GROUP BY r),
w AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(w.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(w.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN w ON d.r = w.r
"""


@query("op11_benchmark_decontamination", LEAKS_SQL)
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(d.doc_id > d.least, false)::INT AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits FROM f v, f w, f x, f y, f z
  WHERE v.b | w.b | x.b | y.b | z.b = 31),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS prior FROM (SELECT *, unnest([1, 2, 3, 4, 5])::INT AS step FROM o)),
r AS (
  SELECT part, filter_order, step, own, sum(n) FILTER (mask & (own | prior) = 0) AS kept, sum(n) FILTER (mask & own > 0 AND mask & prior = 0) AS removed,
    sum(n) FILTER (mask & own > 0 AND mask & prior > 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER (mask & own > 0 AND mask & prior = 0) AS good_lost, sum(toxic) FILTER (mask & own > 0 AND mask & prior = 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))
