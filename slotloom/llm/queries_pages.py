"""Registered queries of the operators on pages, embeddings and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotloom.llm import blocks, mining, nearest, shards, urls, warc
from slotloom.session import scratch_path

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op3_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest.nearest(table, table.where("vec_id % 100 = 0"))


def op6_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    raw, resolved = scratch_path(spark, "warc"), scratch_path(spark, "warc_resolved")
    warc.write_pages(spark.read.parquet(f"{folder}/pages.parquet"), raw)
    warc.write_resolved(spark, raw, resolved)
    return warc.report(spark, resolved)


OP6_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""


def op7_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return shards.shard(docs, 8, carry=["doc_id"]).select("row.doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return urls.filter_urls(pages, urls.rules_table(spark, RULES)).select("row.page_id", "host", "path", "rule", "verdict")


OP10_SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rh, rp, rv) AS (VALUES {rules}),
m AS (SELECT page_id, host, path, rh || rp AS rule, rv,
      row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, rh || rp) AS k
      FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM m WHERE k = 1""".replace(
    "{rules}", ", ".join(str(r) for r in RULES))

def op11_block_labeller(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return blocks.extract(pages).select("row.page_id", "row.url", "text", "n_chars")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(table.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
      FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10"""

QUERIES = {
    "op3_learned_partitions": (op3_learned_partitions, None),
    "op6_warc_revisits": (op6_warc_revisits, OP6_SQL),
    "op7_sampled_splitters": (op7_sampled_splitters, None),
    "op10_url_filters": (op10_url_filters, OP10_SQL),
    "op11_block_labeller": (op11_block_labeller, None),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
