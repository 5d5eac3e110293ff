"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is set if more than half of a text's shingle hashes have it. To find all
fingerprints at ``max_bits`` or fewer differing bits, fingerprints are cut into segments; two
that near agree in one segment up to ``max_bits // segments`` bits. Every distinct fingerprint
stands in a table for each segment, and enumerates the small Hamming ball about its own
segment to fetch matches, whose whole distance is then verified.

A segment value shared by more than ``CROWD`` fingerprints would give too many candidates.
Those fingerprints, and all whose ball reaches such a value, are linked another exact way for
the default of two bits: two fingerprints differ in at most two bits if and only if the balls
of radius one about them meet, so each lists its 65 neighbours, and those that list the same
one (65 at most) are linked in a star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text, materialize, session_of
from daybook.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 2
CROWD = 256
SEED = 42


def simhash(text: str | None, n: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of a whole text as an unsigned number; 0 if it has no words.

    A-Z are lower-cased, words end at ASCII white space, repeated shingles count again.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < n:
        words, n = [b" ".join(words)], 1
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - n + 1
    for at in range(0, total, 65536):
        part = words[at:at + 65536 + n - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(n))))
        hashes = np.array([digest(s, seed) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int((counts * 2 > total).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row."""
    session_of(docs)

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([simhash(t, n) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "fp": pa.array(values.view(np.int64))})

    return id_and_text(docs).mapInArrow(hash_texts, "doc_id long, fp long")


def _ball(value: Column, first: int, bits: int, radius: int) -> Column:
    """All numbers that differ from ``value`` in at most ``radius`` of ``bits`` bits from ``first``."""
    masks, layer = [0], [0]
    for _ in range(radius):
        layer = sorted({m | 1 << i for m in layer for i in range(first, first + bits)} - set(masks))
        masks += layer
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]),
                       lambda m: value.bitwiseXOR(m))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that join all of ``fps`` (distinct ``fp``) within ``max_bits`` bits.

    Every pair that no crowded segment value holds apart is an edge; crowded ones are joined
    by stars over the neighbours they share (for ``max_bits`` 2, the only such case).
    """
    width, radius = 64 // segments, max_bits // segments

    def segment(value: Column, k: int) -> Column:
        mask = ((1 << width) - 1) << (k * width)
        return value.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))

    table = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), segment(F.col("fp"), k).alias("value"))
        for k in range(segments)])).alias("s")).select("fp", "s.*")
    def probes_of(k: int) -> Column:
        near = _ball(segment(F.col("fp"), k), k * width, width, radius)
        return F.transform(near, lambda v: F.struct(F.lit(k).alias("k"), v.alias("value")))

    probes = fps.select("fp", F.explode(F.concat(*map(probes_of, range(segments)))).alias("s"))
    probes = probes.select("fp", "s.*")
    crowded = materialize(table.groupBy("k", "value").count().filter(F.col("count") > crowd)
                          .select("k", "value"), "simhash-crowded")
    if crowded.isEmpty():
        tame, stars = table, None
    elif max_bits != 2:
        raise ValueError("crowded segment values: choose more segments or a higher crowd")
    else:
        tame = table.join(crowded, ["k", "value"], "left_anti")
        near = probes.join(crowded, ["k", "value"], "left_semi").select("fp").distinct()
        met = near.select("fp", F.explode(_ball(F.col("fp"), 0, 64, 1)).alias("z"))
        stars = (met.select("fp", F.min("fp").over(Window.partitionBy("z")).alias("least"))
                 .filter("fp <> least")
                 .select(F.col("least").alias("a"), F.col("fp").alias("b")))
    found = (probes.withColumnRenamed("fp", "a")
             .join(tame.withColumnRenamed("fp", "b"), ["k", "value"])
             .filter((F.col("a") < F.col("b"))
                     & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    return found if stars is None else found.unionByName(stars)


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits``
    bits; rows with a null id take part and get it too (null if no linked row has an id).
    Null texts count as empty: fingerprint zero, linked like any other. Repeated ids and rows
    each give a row; an empty table gives none.
    """
    found = materialize(fingerprints(docs, n), "simhash")
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits))
    labelled = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
                .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(ids, "root").select("fp", "component_id")
    return found.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs``, all columns, with one row of each group of linked rows: that of the least id.

    A group without any id keeps the row of the least text hash. Repeated rows of the kept id
    and text count once (the first of them); other columns may be of any type.
    """
    names, text_hash = docs.columns, F.xxhash64(F.coalesce("text", F.lit("")))
    session_of(docs)

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([simhash(t, n) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "fp": pa.array(values.view(np.int64))})

    found = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                    text_hash.alias("text_hash"))
                        .mapInArrow(hash_texts, "doc_id long, text_hash long, fp long"), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = found.groupBy("fp").agg(F.min(row).alias("first"))
    roots = components(links(distinct.select("fp"), max_bits))
    kept = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
            .select("first.*"))
    # a null id joins as 0 beside its flag
    keys = [F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), text_hash]
    # the text and the row's number decide between rows of one key, whatever other columns hold
    marked = docs.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)],
                         F.struct(F.coalesce("text", F.lit("")), F.monotonically_increasing_id()).alias("_order"),
                         F.struct(*names).alias("_row"))
    wanted = kept.select(F.col("no_id").alias("_k0"), F.coalesce("doc_id", F.lit(0)).alias("_k1"),
                         F.col("text_hash").alias("_k2"))
    by = ["_k0", "_k1", "_k2"]
    one = marked.join(wanted, by, "left_semi").groupBy(*by).agg(F.min_by("_row", "_order").alias("_row"))
    return one.select(*[F.col("_row")[c].alias(c) for c in names])
