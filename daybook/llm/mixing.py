"""Mixing sources to target weights, in SQL functions only.

The words of a source, its documents in a fixed order, form one stream that is cut into blocks
of ``BLOCK_WORDS``. Output shards have a fixed number of slots, and each slot takes one block:

1. Every slot draws a source, with the chances the targets give; the counts of a shard are a
   multinomial draw.
2. Draws beyond what a source's target needs are settled: those places go to the sources that
   were drawn too rarely. So a source's slots are exactly as many as its target takes.
3. A source's j-th slot is mapped through a pseudorandom permutation of its block numbers
   (swap-or-not rounds, exact on any range), a new one for every pass over the source.
4. Blocks and the documents' pieces in them meet in a join by (source, block number).

The last, shorter block of a source is taken at the end of a pass, and the last slot of a source
is cut where its target is reached, so the words taken equal the target to less than one word.
No source is taken more than twice over, so no word is either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import materialize, shuffle_partitions

BLOCK_WORDS = 64
# Weights by source, in code point order, repeating.
WEIGHTS = (3, 1, 2)
MIX_FACTOR = 1.5
MOST_TIMES = 2
SEED = 13
ROUNDS = 12
SHARD_SLOTS = 1024
MOST_SHARDS = 4096
_CELLS = 4096
_STEP = 4096


def n_words(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, factor: float = MIX_FACTOR,
            most_times: int = MOST_TIMES) -> DataFrame:
    """(s, source, source_size, target) from (source, source_size), one row for each source.

    Sources are numbered by code point, a null source last, and weigh ``weights`` in turn.
    Together they take ``factor`` of all words. A source stops at ``most_times`` its size and
    the excess goes to the others by weight: with sources ordered by size over weight those
    that stop come first, and the first that doesn't sets the words per weight of the rest.
    The windows hold a row for each source, no more.
    """
    numbered = sizes.select("source", "source_size", (F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("s"))
    weight = F.array(*map(F.lit, weights))[F.col("s") % len(weights)].cast("double")
    cap = F.col("source_size") * most_times
    order = Window.orderBy(cap / F.col("weight"), "s")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shares = numbered.withColumn("weight", weight).select(
        "*", ((F.sum("source_size").over(Window.partitionBy()) * factor
               - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(onward))
        .alias("each"))
    stops = F.col("each") > cap / F.col("weight")
    first = F.when(~stops, F.struct(cap / F.col("weight"), "s"))
    each = F.coalesce(F.min_by(F.col("each"), first).over(Window.partitionBy()), F.lit(0.0))
    return shares.select("s", "source", "source_size",
                         F.least(cap.cast("double"), each * F.col("weight")).alias("target"))


def _permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """``index`` of [0, n) mapped by a permutation that ``key`` chooses.

    A round pairs every number x with k - x and swaps the pair if a hash of its larger number
    says so; any n works, nothing is walked twice.
    """
    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        return F.when(F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(1) == 1, other).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, swap)


def plan_sources(sized: DataFrame, block_words: int, weights, factor: float,
                 most_times: int) -> DataFrame:
    """Targets with each source's whole blocks, rest, and slots by number, written."""
    sizes = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    plan = targets(sizes, weights, factor, most_times)
    words = F.round("target").cast("long")
    plan = plan.select("*", words.alias("words"), F.floor(F.col("source_size") / block_words).alias("full"),
                       (F.col("source_size") % block_words).alias("tail"))
    plan = plan.withColumn("per_pass", F.col("full") + F.when(F.col("tail") > 0, 1).otherwise(0))
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    plan = plan.withColumn("rest", F.col("words") - passes * F.col("source_size"))
    plan = plan.withColumn("whole", passes * F.col("per_pass") + F.expr(f"rest div {block_words}"))
    plan = plan.withColumn("cut", F.col("rest") % block_words)
    plan = plan.withColumn("slots", F.col("whole") + F.when(F.col("cut") > 0, 1).otherwise(0))
    order = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumn("ticket", F.coalesce(F.sum("slots").over(order), F.lit(0)))
    return materialize(plan, "mix-plan")


def _draw_counts(plan: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, s, n): how often each shard's slots drew each source.

    A slot draws one of ``n_slots`` tickets, of which a source has as many as slots. The
    ticket finds its source by cells of the ticket range, so the join is by equality.
    """
    spark = plan.sparkSession
    width = -(-n_slots // _CELLS)
    cells = materialize(plan.where("slots > 0").select(
        "s", "ticket", "slots",
        F.explode(F.sequence(F.expr(f"ticket div {width}"),
                             F.expr(f"(ticket + slots - 1) div {width}"))).alias("cell")), "mix-cells")
    parts = max(shuffle_partitions(spark), -(-n_slots // (1 << 22)))
    drawn = spark.range(0, n_slots, 1, parts).select(
        F.expr(f"id div {shard_slots}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(n_slots)).alias("drawn"))
    return (drawn.withColumn("cell", F.expr(f"drawn div {width}")).join(cells, "cell")
            .where("drawn >= ticket AND drawn < ticket + slots")
            .groupBy("shard", "s").agg(F.count("*").alias("n")))


def _slots(plan: DataFrame, counts: DataFrame) -> DataFrame:
    """(shard, s, j): the settled slots, the j-th of each source."""
    spark = plan.sparkSession
    by_shard = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("first", F.coalesce(F.sum("n").over(by_shard), F.lit(0)))
    ranked = ranked.join(plan.select("s", "slots"), "s").withColumn(
        "keep", F.greatest(F.lit(0), F.least("n", F.col("slots") - F.col("first"))))
    ranked = materialize(ranked, "mix-counts")
    # places that a source drew beyond its slots, and the slots that others lack, by number
    free = ranked.groupBy("shard").agg(F.sum(F.col("n") - F.col("keep")).alias("free")).where("free > 0")
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    free = free.withColumn("at", F.coalesce(F.sum("free").over(order), F.lit(0)))
    places = free.select("shard", F.explode(F.expr("sequence(at, at + free - 1)")).alias("place"))
    drawn = ranked.groupBy("s").agg(F.sum("n").alias("drawn"))
    lack = plan.select("s", "slots").join(drawn, "s", "left").select(
        "s", F.coalesce("drawn", F.lit(0)).alias("drawn"), "slots").where("drawn < slots")
    order = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    lack = lack.withColumn("at", F.coalesce(F.sum(F.col("slots") - F.col("drawn")).over(order), F.lit(0)))
    wanted = lack.select("s", "drawn", "at", F.explode(F.expr("sequence(at, at + slots - drawn - 1)"))
                         .alias("place"))
    settled = wanted.join(places, "place").select(
        "shard", "s", (F.col("drawn") + F.col("place") - F.col("at")).alias("j"))
    # kept draws in steps of bounded length, dealt out before they are listed one by one
    steps = ranked.where("keep > 0").select(
        "shard", "s", (F.col("first") + F.col("keep")).alias("end"),
        F.explode(F.expr(f"sequence(first, first + keep - 1, {_STEP}L)")).alias("from"))
    steps = steps.repartition(shuffle_partitions(spark), "s", "from")
    kept = steps.select("shard", "s", F.explode(F.expr(
        f"sequence(`from`, least(`from` + {_STEP}, `end`) - 1)")).alias("j"))
    return kept.unionByName(settled)


def slot_blocks(plan: DataFrame, shard_slots: int | None = None, seed: int = SEED) -> DataFrame:
    """(shard, s, j, block, words) of every output slot.

    ``words`` is how much of the block the slot takes from its start: all of it but in a
    source's last slot. Without ``shard_slots`` a shard has 1,024 slots, or more so that
    there are 4,096 shards at most.
    """
    n_slots = plan.agg(F.sum("slots")).head()[0] or 0
    if not n_slots:
        return plan.sparkSession.createDataFrame(
            [], "shard long, s int, j long, block long, words long")
    shard_slots = shard_slots or max(SHARD_SLOTS, -(-n_slots // MOST_SHARDS))
    block_words = plan.head()["block_words"]
    slots = _slots(plan, _draw_counts(plan, n_slots, shard_slots, seed)).join(
        plan.select("s", "full", "tail", "per_pass", "whole", "cut"), "s")
    slots = slots.withColumns({"pass": F.expr("j div per_pass"), "index": F.expr("j % per_pass")})
    spread = _permuted(F.col("index"), F.greatest("full", F.lit(1)), F.lit(seed), F.col("s"), F.col("pass"))
    block = F.when(F.col("index") < F.col("full"), spread).otherwise(F.col("full"))
    length = F.when(F.col("index") < F.col("full"), F.lit(block_words)).otherwise(F.col("tail"))
    return slots.select("shard", "s", "j", block.alias("block"),
                        F.when(F.col("j") < F.col("whole"), length).otherwise(F.col("cut"))
                        .cast("long").alias("words"))


def write_sized(docs: DataFrame) -> DataFrame:
    """(row, part, doc_id, source, size, text_hash), one row a document, in ranges, written.

    The order is source, id, text hash; equal rows of it are interchangeable, and a row number
    splits them. A range (``part``) is bounded by its size, whatever a source's share is.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("source").cast("string").alias("source"),
                        n_words(F.col("text").cast("string")).alias("size"),
                        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                        F.monotonically_increasing_id().alias("row"))
    ranges = sized.repartitionByRange("source", "doc_id", "text_hash", "row")
    return materialize(ranges.withColumn("part", F.spark_partition_id()), "mix-sized")


def pieces(sized: DataFrame, plan: DataFrame, block_words: int) -> DataFrame:
    """(row, doc_id, s, size, block, start, at, length): what each block holds of a document.

    ``start`` counts in the document, ``at`` in the block. A document without words has one
    row whose block is null. A document's place in its source is the sum of the ranges before
    its own, and of its range up to it.
    """
    own = sized.join(plan.select("s", "source"), sized["source"].eqNullSafe(plan["source"])).select(
        "row", "part", "doc_id", "s", "size", "text_hash")
    ahead = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(own.groupBy("s", "part").agg(F.sum("size").alias("in_part")).select(
        "s", "part", F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("first")), "mix-ranges")
    before = (Window.partitionBy("s", "part").orderBy("doc_id", "text_hash", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = own.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.join(ranges, ["s", "part"]).withColumn("offset", F.col("first") + F.col("inside"))
    blocks = F.when(F.col("size") > 0, F.expr(
        f"sequence(offset div {block_words}, (offset + size - 1) div {block_words})"))
    cut = placed.select("row", "doc_id", "s", "size", "offset", F.explode_outer(blocks).alias("block"))
    edge = F.col("block") * block_words - F.col("offset")
    cut = cut.withColumns({"start": F.greatest(edge, F.lit(0)), "at": F.greatest(-edge, F.lit(0))})
    return cut.withColumn("length", F.least(F.col("size") - F.col("start"),
                                            F.lit(block_words) - F.col("at"))).drop("offset")


def _planned(docs: DataFrame, block_words, weights, factor, most_times):
    sized = write_sized(docs)
    plan = plan_sources(sized, block_words, weights, factor, most_times)
    return sized, plan.withColumn("block_words", F.lit(block_words))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS, factor: float = MIX_FACTOR,
        most_times: int = MOST_TIMES, shard_slots: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself: (shard, source, slot, at, doc_id, start, length), a row for each piece.

    Slot ``slot`` of a source stands in ``shard`` and takes, at its word ``at``, the words
    ``start`` to ``start + length`` of the document.
    """
    sized, plan = _planned(docs, block_words, weights, factor, most_times)
    found = (pieces(sized, plan, block_words).where("block IS NOT NULL")
             .join(slot_blocks(plan, shard_slots, seed), ["s", "block"])
             .withColumn("length", F.least("length", F.col("words") - F.col("at"))).where("length > 0"))
    return found.join(plan.select("s", "source"), "s").select(
        "shard", "source", F.col("j").alias("slot"), "at", "doc_id", "start", "length")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS,
                    factor: float = MIX_FACTOR, most_times: int = MOST_TIMES,
                    shard_slots: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every document.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; other columns are ignored. A null
    text has size 0, null sources are one source, the last. Repeated ids and rows count each;
    a null id is kept. A document without words takes none; an empty table gives no rows.
    """
    sized, plan = _planned(docs, block_words, weights, factor, most_times)
    slots = slot_blocks(plan, shard_slots, seed).select("s", "block", "words")
    words = F.coalesce("words", F.lit(0))  # no slot takes the block
    inside = F.greatest(F.lit(0), F.least(F.col("at") + F.col("length"), words) - F.col("at"))
    taken = (pieces(sized, plan, block_words).join(slots, ["s", "block"], "left")
             .groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("s").alias("s"),
                                 F.first("size").alias("size"),
                                 F.coalesce(F.sum(inside), F.lit(0)).cast("long").alias("taken")))
    return taken.join(plan.select("s", "source", "source_size", "target"), "s").select(
        "doc_id", "size", "source", "source_size", "target", "taken")
