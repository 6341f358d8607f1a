"""Registered queries of the operators on documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotloom.llm import matrices, near, packing, pieces, ranked, repeats, rules


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return repeats.drop_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS x FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
hit AS (SELECT r, s FROM win WHERE x IN (SELECT x FROM win GROUP BY x HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM hit),
word AS (SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.r, string_agg(t, ' ' ORDER BY word.p) AS text FROM word LEFT JOIN gone ON gone.r = word.r AND gone.p = word.p
    WHERE gone.r IS NULL GROUP BY word.r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r LEFT JOIN n ON n.r = d.r"""


def op2_packed_matrices(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    written = matrices.write_matrices(docs, matrices.matrices_folder(spark))
    return matrices.segments(written).withColumnRenamed("doc", "doc_id")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = rules.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return rules.judge(docs, found).select("row.doc_id", *rules.COUNTS, "base_failed", "kept")


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return near.near_duplicates(docs, carry=["doc_id"]).select("row.doc_id", "class_id")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return pieces.encode(docs, with_ids=False).select("row.doc_id", "n_tokens", "ids_crc32", "parity", "round_trip")


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return packing.pack(docs).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return ranked.search(docs, spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents),
tok AS (SELECT r, doc_id, unnest(t) AS t FROM d),
size AS (SELECT r, doc_id, count(*) AS n FROM tok GROUP BY r, doc_id),
g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
tf AS (SELECT r, t, count(*) AS tf FROM tok GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY t, n_docs),
item AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({terms}) AS t FROM benchmark) GROUP BY item_id, t),
s AS (SELECT item_id, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM item JOIN w USING (t) JOIN tf USING (t) JOIN size USING (r), g GROUP BY item_id, doc_id, r),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""".replace(
    "{terms}", r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, OP1_SQL),
    "op2_packed_matrices": (op2_packed_matrices, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_minhash_near_dedup": (op5_minhash_near_dedup, None),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_best_fit_packing": (op9_best_fit_packing, None),
    "op12_ranked_search": (op12_ranked_search, OP12_SQL),
}
