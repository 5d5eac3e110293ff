"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import documents
from daybook.llm.tokens import tokenizer_path
from daybook.session import scratch_dir


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import packing
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import decontamination
    return decontamination.judged(documents(spark, sf_dir),
                                  spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import suffix_array
    found = suffix_array.repeated_bytes(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import token_files
    out = scratch_dir(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), out, tokenizer_path())
    return token_files.read_documents(spark, out)


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import suffix_tree
    found = suffix_tree.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import url_filter
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import fingerprints
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import simhash
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import language_model
    return language_model.score_documents(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import toxicity
    return toxicity.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import centroids
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm import mixing
    return mixing.mixed_documents(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_packing": op1_packing, "op2_decontamination": op2_decontamination,
            "op3_suffix_array": op3_suffix_array,
            "op4_token_files": op4_token_files,
            "op5_suffix_tree": op5_suffix_tree, "op6_url_filter": op6_url_filter, "op7_fingerprints": op7_fingerprints,
            "op8_simhash": op8_simhash,
            "op9_language_model": op9_language_model, "op10_toxicity": op10_toxicity,
            "op11_centroids": op11_centroids, "op12_hard_negatives": op12_hard_negatives,
            "op13_mixing": op13_mixing}


# Bytes of all texts, windows of 50 of them by sha256, and what a window of a document with
# a smaller id covers.
_OP3 = r"""
WITH bytes AS (
  SELECT doc_id, unnest(range(1, octet_length(b) + 1)) AS i,
         unnest(regexp_extract_all(hex(b), '..')) AS byte
  FROM (SELECT doc_id, encode(COALESCE(text, '')) AS b FROM documents)),
windows AS (
  SELECT doc_id, i, byte,
         COUNT(*) OVER ahead AS n, sha256(STRING_AGG(byte, '') OVER ahead) AS h
  FROM bytes
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
marked AS (
  SELECT doc_id, i, byte, n = 50 AND MIN(doc_id) OVER (PARTITION BY n, h) < doc_id AS again
  FROM windows),
judged AS (
  SELECT doc_id, i, byte, BOOL_OR(again) OVER (
           PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
edges AS (
  SELECT *, gone AND NOT COALESCE(LAG(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens
  FROM judged),
totals AS (
  SELECT doc_id, COUNT(*) AS n_bytes, COUNT(*) FILTER (WHERE gone) AS n_removed,
         COUNT(*) FILTER (WHERE opens) AS n_spans,
         STRING_AGG(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM edges GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_bytes, 0) AS n_bytes, COALESCE(n_removed, 0) AS n_removed,
       COALESCE(n_spans, 0) AS n_spans, sha256(unhex(COALESCE(kept, ''))) AS kept_sha256
FROM documents d LEFT JOIN totals USING (doc_id)
"""

# The same for windows of 35 words that stand at two places or more.
_OP5 = r"""
WITH words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)),
windows AS (
  SELECT doc_id, i, word,
         COUNT(*) OVER ahead AS n, sha256(STRING_AGG(word, ' ') OVER ahead) AS h
  FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
marked AS (
  SELECT doc_id, i, word, n = 35 AND COUNT(*) OVER (PARTITION BY n, h) > 1 AS again FROM windows),
judged AS (
  SELECT doc_id, i, word, BOOL_OR(again) OVER (
           PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
totals AS (
  SELECT doc_id, COUNT(*) AS n_words, COUNT(*) FILTER (WHERE gone) AS n_removed,
         STRING_AGG(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_removed, 0) AS n_removed,
       sha256(COALESCE(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN totals USING (doc_id)
"""


_OP11_ROUND = """
a{0} AS MATERIALIZED (
  SELECT v.row, MIN(STRUCT_PACK(d := {2}, k := c.k)) AS best
  FROM v CROSS JOIN c{0} c GROUP BY v.row),
c{1} AS MATERIALIZED (
  SELECT c.k, COALESCE(m.c, c.c) AS c
  FROM c{0} c LEFT JOIN (
    SELECT k, LIST(mean ORDER BY i) AS c
    FROM (SELECT k, i, (s - ((s % n) + n) % n) // n AS mean
          FROM (SELECT a.best.k AS k, u.i, SUM(u.x) AS s, COUNT(*) AS n
                FROM a{0} a JOIN u USING (row) GROUP BY a.best.k, u.i)) GROUP BY k) m
  USING (k)),"""
_OP11_DISTANCE = ("CAST(list_sum(list_transform(list_zip(v.c, c.c), "
                  "lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)")


def _op11(rounds: int = 10) -> str:
    """Lloyd's rounds one after another, every vector against all eight centroids."""
    steps = "".join(_OP11_ROUND.format(r, r + 1, _OP11_DISTANCE) for r in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS row, vec_id, sha256('3:' || COALESCE(CAST(vec_id AS VARCHAR), '')) AS h,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS MATERIALIZED (SELECT row, unnest(c) AS x, unnest(range(64)) AS i FROM v),
c0 AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER (ORDER BY h, vec_id, c) - 1 AS k, c FROM v ORDER BY h, vec_id, c LIMIT 8),
{steps}
last AS MATERIALIZED (
  SELECT v.row, v.vec_id, MIN(STRUCT_PACK(d := {_OP11_DISTANCE}, k := c.k)) AS best
  FROM v CROSS JOIN c{rounds} c GROUP BY v.row, v.vec_id)
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(SUM(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(SUM(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM last JOIN c{rounds} c ON c.k = best.k
"""


# Every anchor against all rows.
_OP12 = """
WITH r AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS row, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.row, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
  FROM r a JOIN r b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS at
  FROM s WHERE same),
n AS (
  SELECT p.row, p.at, p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         ROW_NUMBER() OVER (PARTITION BY p.row, p.at ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON s.row = p.row AND NOT s.same
  WHERE p.at <= 5 AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express; tests hold the others to brute force."""
    return {"op3_suffix_array": _OP3, "op5_suffix_tree": _OP5, "op11_centroids": _op11(),
            "op12_hard_negatives": _OP12}
