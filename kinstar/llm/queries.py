"""The registered query of each operator, over its whole table, and its DuckDB
SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.llm import (decontaminate, licenses, lm_score, near_dup, packing, ranked, resample, secrets, substring,
                         token_counts, topk, toxicity, warc)
from kinstar.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_crf_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))

    def digest(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"), count("crf"))


def op2_minhash_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"))


def op3_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document: all its leaked items, and the best covered one."""
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    best = F.struct((F.col("covered_words") / F.col("item_words")).alias("coverage"), (-F.col("item_id")).alias("order"), "item_id", "n_tiles")
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.max(best).alias("best"), F.sort_array(F.collect_list("item_id")).alias("item_ids")).select(
        "doc_id", "n_items", "item_ids", "best.item_id", "best.coverage", "best.n_tiles", F.lit(True).alias("contaminated"))


def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.severity(docs.select("doc_id", "text"), model).drop("text")


def op9_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder, end_id, width = scratch_path(spark, "tokens"), 50256, token_counts.id_width(50257)
    placed = token_counts.write_token_files(_table(spark, sf_dir, "documents"), folder,
                                            public_tokenizers.path("byte_bpe_50k.json"), end_id, width)
    counted = token_counts.scan_token_files(spark, folder, placed, end_id, width)
    return placed.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_level_wise_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.page_records(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    warc.write_archive(records, folder, min_bytes=1000)
    return warc.read_archive(spark, folder, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digests(packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op4_score_at_a_time_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_recurrent_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"))


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op11_importance_resampling": op11_importance_resampling,
    "op12_recurrent_lm_score": op12_recurrent_lm_score,
    "op13_max_sketch_search": op13_max_sketch_search,
    "op1_crf_secret_scan": op1_crf_secret_scan,
    "op2_minhash_license_scan": op2_minhash_license_scan,
    "op3_greedy_string_tiling": op3_greedy_string_tiling,
    "op5_ordinal_toxicity": op5_ordinal_toxicity,
    "op9_separator_scan": op9_separator_scan,
    "op4_score_at_a_time_topk": op4_score_at_a_time_topk,
    "op7_karmarkar_karp_packing": op7_karmarkar_karp_packing,
    "op10_warc_writer": op10_warc_writer,
    "op8_level_wise_doubling": op8_level_wise_doubling,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms_sql(table: str) -> str:
    return rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM {table}"


ORACLE = {
    "op13_max_sketch_search": f"""
WITH word AS (SELECT doc_id, unnest(w) AS t FROM (SELECT doc_id, {_terms_sql('documents')})),
tf AS (SELECT doc_id, t, count(*) AS tf FROM word GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM size),
part AS (SELECT doc_id, 100 - 90 + ((90 * n * docs) // len) AS m FROM size, total),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, docs),
asked AS (SELECT DISTINCT item_id, unnest(w) AS t FROM (SELECT item_id, {_terms_sql('benchmark')})),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weight USING (t) JOIN part USING (doc_id) GROUP BY ALL)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
""",
    # A byte's contribution to a CRC is that of the byte at the end, moved by a zero byte per place.
    "op11_importance_resampling": f"""
WITH RECURSIVE bits AS (
  SELECT b::UINTEGER AS b, b::UINTEGER AS v, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT b, if(v % 2 = 1, xor(v // 2, 3988292384::UINTEGER), v // 2)::UINTEGER, k + 1 FROM bits WHERE k < 8),
step AS MATERIALIZED (SELECT b, v FROM bits WHERE k = 8),
word AS (
  SELECT 'd' AS side, doc_id AS id, w FROM (SELECT doc_id, {_terms_sql('documents')})
  UNION ALL SELECT 't', item_id, w FROM (SELECT item_id, {_terms_sql('benchmark')})),
feature AS MATERIALIZED (
  SELECT side, id, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT side, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM word, range(1, 4) t(n))),
text AS MATERIALIZED (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)),
moved AS (
  SELECT b, v, 0 AS d, 4294967295::UINTEGER AS one FROM step
  UNION ALL
  SELECT m.b, xor(m.v // 256, s.v)::UINTEGER, m.d + 1, m.one FROM moved m JOIN step s ON s.b = m.v % 256
  WHERE m.d < (SELECT max(len(h)) // 2 FROM text)),
ones AS (
  SELECT 0 AS d, 4294967295::UINTEGER AS v
  UNION ALL
  SELECT o.d + 1, xor(o.v // 256, s.v)::UINTEGER FROM ones o JOIN step s ON s.b = o.v % 256
  WHERE o.d < (SELECT max(len(h)) // 2 FROM text)),
crc AS (
  SELECT f, xor(xor(bit_xor(m.v), any_value(o.v)), 4294967295::UINTEGER) % 10000 AS bucket
  FROM (SELECT f, len(h) // 2 AS size, unnest(range(0, len(h) // 2)) AS i, h FROM text) x
  JOIN moved m ON m.d = size - 1 - i
    AND m.b = (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1
  JOIN ones o ON o.d = size GROUP BY f),
held AS MATERIALIZED (SELECT side, id, bucket, count(*) AS c FROM feature JOIN crc USING (f) GROUP BY ALL),
bucket AS (
  SELECT bucket, coalesce(sum(c) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (WHERE side = 't'), 0)::DOUBLE AS t
  FROM held GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g
  FROM bucket),
scored AS (
  SELECT d.doc_id, greatest(len(w) - 19, 0) > 0 AS may, coalesce(n, 0)::BIGINT AS n_features, coalesce(x.weight, 0)::BIGINT AS weight,
         coalesce(x.weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('42:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT doc_id, {_terms_sql('documents')}) d
  LEFT JOIN (SELECT id, sum(c) AS n, sum(c * g) AS weight FROM held JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id) x ON x.id = d.doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 5 * count(*) OVER () // 100 AS drawn FROM scored WHERE may)
SELECT scored.doc_id, n_features, weight, score, if(r <= drawn, r, NULL)::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
""",
    "op4_score_at_a_time_topk": """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum([a[1] * a[2] FOR a IN list_zip(q.e, v.e)])::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
""",
    "op10_warc_writer": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
""",
    "op8_level_wise_doubling": r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i AS start, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)),
late AS (
  SELECT doc_id, start FROM win
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, start) > 1),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(start, start + 20)))) AS g FROM late GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(coalesce(g, []), i)], ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
""",
    "op6_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words),
class AS (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep, s FROM sets),
item AS (SELECT doc_id, n, unnest(s) AS x FROM class WHERE doc_id = rep),
pair AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS c
  FROM item a JOIN item b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT u, v FROM pair WHERE 100 * c >= 85 * (nu + nv - c)),
both_ways AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT u AS src, u AS dst FROM both_ways UNION SELECT r.src, b.v FROM reach r JOIN both_ways b ON r.dst = b.u),
root AS (SELECT src, min(dst) AS component FROM reach GROUP BY src)
SELECT c.doc_id, c.n AS n_shingles, CASE WHEN c.n = 0 THEN c.doc_id ELSE coalesce(r.component, c.rep) END AS component_id,
  c.doc_id = CASE WHEN c.n = 0 THEN c.doc_id ELSE coalesce(r.component, c.rep) END AS kept
FROM class c LEFT JOIN root r ON r.src = c.rep
""",
}
