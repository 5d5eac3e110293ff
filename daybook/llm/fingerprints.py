"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL functions only.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's shingles, ascending. The
sketch of a union is the bottom k of two sketches' union, so parts of a text or corpus can be
sketched apart and merged. From two sketches follow estimates of resemblance, containment
and the number of distinct shingles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text, shuffle_partitions

K = 128
SHINGLE_WORDS = 5
_SPACES = "\t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; a null text has none."""
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), _SPACES, " " * len(_SPACES))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """xxhash64 of every run of ``n`` words (of the whole text if it has fewer; none if none)."""
    def of(hashes: Column) -> Column:
        size = F.size(hashes)
        return (F.when(size >= n, F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))),
                                              lambda i: F.xxhash64(F.slice(hashes, i, F.lit(n)))))
                .when(size > 0, F.array(F.xxhash64(hashes)))
                .otherwise(F.array().cast("array<bigint>")))
    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, n: int = SHINGLE_WORDS) -> Column:
    """Sketch of a text: at most ``k`` hashes, ascending; empty for a text without words."""
    return bottom_k(shingle_hashes(text, n), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what ``a`` and ``b`` were made from."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1: the share of the union's sketch that both hold.

    Equal sketches give 1, two empty ones too; an empty and another one give 0.
    """
    return _let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch has fewer than ``k``."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``.

    |A and B| is the resemblance times the size of the union, whose sketch is at hand.
    """
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``doc_id``, found in two steps; -1 for a null id."""
    if not bounds:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    step = math.isqrt(len(bounds) - 1) + 1
    coarse = F.array(*[F.lit(x) for x in bounds[step - 1::step]]).cast("array<bigint>")
    fine = F.array(*[F.lit(x) for x in bounds]).cast("array<bigint>")
    blocks = F.size(F.filter(coarse, lambda x: x <= doc_id))
    inside = F.size(F.filter(F.slice(fine, blocks * step + 1, F.lit(step)), lambda x: x <= doc_id))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(blocks * step + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """Add each document's sketch, and text and sketch of the next one by descending id.

    After the last document comes the first again. Null ids come last, equal ids follow in
    descending text. Ids are dealt to ranges of about equal row counts; within a range a
    window finds the next row, and the first rows of the ranges, one for each, link a range
    to the next one. Whole texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs)
    n = shuffle_partitions(spark)
    at = [i / n for i in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", at, 10_000).alias("b")).head()["b"]
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(found or []))))
    # one row for each range: without the hint the texts are shuffled to find their heads
    tops = F.broadcast(rows.groupBy("bucket").agg(F.max("doc_id").alias("top")))
    heads = (rows.alias("r").join(tops.alias("t"), F.col("r.doc_id").eqNullSafe(F.col("t.top"))
                                  & (F.col("r.bucket") == F.col("t.bucket")))
             .groupBy("r.bucket").agg(F.max("r.text").alias("text")))
    down = Window.orderBy(F.col("bucket").desc())
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("bucket", F.coalesce(F.lead("text").over(down),
                                              F.first("text").over(whole)).alias("head_text"))
    heads = heads.withColumn("head_sketch", sketch(F.col("head_text")))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(),
                                                 F.col("text").desc())
    return (rows.withColumn("sketch", sketch(F.col("text"))).join(heads, "bucket")
            .select("doc_id", "text", "sketch",
                    F.coalesce(F.lead("text").over(order), "head_text").alias("next_text"),
                    F.coalesce(F.lead("sketch").over(order), "head_sketch").alias("next_sketch")))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text counts as
    empty and has an empty fingerprint. The last third of an edited text (code points, rounded
    down) is replaced by as many code points from the next document's start, or all it has.
    Repeated ids and rows each give a row; an empty table gives none.
    """
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
                      F.substr("next_text", F.lit(1), third))
    rows = (with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"))))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
