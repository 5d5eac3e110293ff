"""Hard negatives by a GNAT-style multiway tree over all vectors.

Scores are inner products of whole-number vectors. Every row gets one component more, so that
all rows have the same norm, and an anchor gets a zero there; then

    distance(anchor, row)^2 = |anchor|^2 + M^2 - 2 score,

and a window of scores is an annulus of distances about the anchor. The tree's nodes have up to
``FANOUT`` split points; a row goes to the nearest (multiway hyperplanes), and each split point
stores the least and largest distance to the rows of every sibling's subtree. A subtree whose
range from any split point misses what the triangle inequality leaves of the annulus is out.
Leaves that remain are scored exactly.

The split points come from a bounded sample, every row is indexed. Rows stand in blocks by leaf,
and an anchor meets only the blocks of leaves that its annuli reach, in an equality join. A
leaf of many blocks is dealt to many slices, so no leaf meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.centroids import finite, scaled
from daybook.llm.common import materialize, session_of

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
FANOUT = 16
# Rows (the smallest by hash) that the tree is built from; they also give first thresholds.
SAMPLE_ROWS = 2048
LEAF_SAMPLE = 32
DEPTH = 3
BLOCK_ROWS = 2048
SLICE_BLOCKS = 8
ANCHORS_AT_ONCE = 512
# Components beyond this count as it: inner products of 64 of them still fit a long.
LIMIT = 1 << 26

_BLOCK = "leaf int, uid long, ids array<long>, labels array<int>, body binary, low array<double>, high array<double>"
_ANCHOR = ("anchor_row long, anchor_id long, label int, vector array<int>, positives "
           "array<struct<id:long,score:long>>")


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (row of a, row of b) as int64, in floating point where that is exact."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    most = (int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Tree:
    """Split points of all nodes and, once ``ranges`` are set, who can be left out.

    A node is a pair (points, children); a child is the number of a node, or ~leaf.
    """

    def __init__(self, sample: np.ndarray, norm: int, dims: int):
        self.norm, self.dims = norm, dims
        self.slack = 1e-6 * math.sqrt(max(norm, 1))  # far above the rounding of any distance here
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.n_leaves = 0
        self.ranges: list[tuple[np.ndarray, np.ndarray]] = []
        self._grow(sample, 0)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """The rows with the component that brings each to the common norm."""
        rows = rows.astype(np.float64)
        rest = np.sqrt(np.maximum(self.norm - (rows * rows).sum(1), 0.0))
        return np.concatenate([rows, rest[:, None]], 1)

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return np.sqrt(np.maximum(square, 0.0))

    def _grow(self, sample: np.ndarray, depth: int) -> int:
        """Adds the subtree over ``sample``; its node, or ~leaf."""
        points = self._spread(sample) if len(sample) > LEAF_SAMPLE or not depth else sample[:0]
        if depth == DEPTH or depth and len(points) < 2:
            self.n_leaves += 1
            return ~(self.n_leaves - 1)
        at = len(self.nodes)
        self.nodes.append((self.lifted(points), []))
        nearest = self.distances(self.lifted(sample), self.nodes[at][0]).argmin(1)
        for j in range(len(points)):
            self.nodes[at][1].append(self._grow(sample[nearest == j], depth + 1))
        return at

    def _spread(self, sample: np.ndarray) -> np.ndarray:
        """Up to FANOUT different rows, far apart, of the first 3 * FANOUT."""
        some = sample[:3 * FANOUT]
        chosen, lifted = [0], self.lifted(some)
        least = self.distances(lifted, lifted[:1])[:, 0]
        while len(chosen) < FANOUT and least.max() > self.slack:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, self.distances(lifted, lifted[chosen[-1]][None])[:, 0])
        return some[chosen]

    def route(self, rows: np.ndarray) -> tuple[np.ndarray, list[list]]:
        """Leaf of each row, and the distances to the split points on its way, node by node."""
        lifted, leaf = self.lifted(rows), np.zeros(len(rows), np.int64)
        seen: list[list] = []

        def down(at: int, which: np.ndarray) -> None:
            points, children = self.nodes[at]
            d = self.distances(lifted[which], points)
            nearest = d.argmin(1)
            seen.append([at, which, d])
            for j, child in enumerate(children):
                mine = which[nearest == j]
                if child < 0:
                    leaf[mine] = ~child
                elif len(mine):
                    down(child, mine)

        if len(rows):
            down(0, np.arange(len(rows)))
        return leaf, seen

    def paths(self) -> dict[int, list[tuple[int, int]]]:
        """For each leaf, the (node, child) steps that lead to it."""
        found: dict[int, list[tuple[int, int]]] = {}

        def down(at: int, way: list[tuple[int, int]]) -> None:
            for j, child in enumerate(self.nodes[at][1]):
                if child < 0:
                    found[~child] = [*way, (at, j)]
                else:
                    down(child, [*way, (at, j)])

        down(0, [])
        return found

    def set_ranges(self, by_leaf: dict[int, tuple[list, list]]) -> None:
        """Ranges (split point, child) of every node from those of the leaves below it.

        A leaf's lists run over the split points of the nodes on its path, root first. A
        child without rows keeps an empty range, which nothing meets.
        """
        self.ranges = [(np.full((len(p),) * 2, np.inf), np.full((len(p),) * 2, -np.inf))
                       for p, _ in self.nodes]
        paths = self.paths()
        for leaf, (low, high) in by_leaf.items():
            first = 0
            for node, j in paths[leaf]:
                n = len(self.nodes[node][0])
                lows, highs = self.ranges[node]
                lows[:, j] = np.minimum(lows[:, j], low[first:first + n])
                highs[:, j] = np.maximum(highs[:, j], high[first:first + n])
                first += n

    def reached(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray
                ) -> list[tuple[int, np.ndarray]]:
        """(leaf, numbers of the anchors whose annulus [inner, outer] can hold one of its rows)."""
        queries = np.concatenate([anchors.astype(np.float64), np.zeros((len(anchors), 1))], 1)
        found: list[tuple[int, np.ndarray]] = []

        def down(at: int, which: np.ndarray) -> None:
            points, children = self.nodes[at]
            lows, highs = self.ranges[at]
            d = self.distances(queries[which], points)
            most = d + outer[which, None] + self.slack
            least = np.maximum(d - outer[which, None], inner[which, None] - d) - self.slack
            for j, child in enumerate(children):
                alive = which[((highs[:, j] >= least) & (lows[:, j] <= most)).all(1)]
                if len(alive):
                    found.append((~child, alive)) if child < 0 else down(child, alive)

        if len(anchors):
            down(0, np.arange(len(anchors)))
        return found

    def radius(self, anchors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distance at which a row has this score; infinite for a score of -infinity."""
        square = (anchors.astype(np.float64) ** 2).sum(1) + self.norm - 2 * scores
        return np.sqrt(np.maximum(square, 0.0))


def _padded(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix; missing components count as 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def build_index(rows: DataFrame, norm: int, dims: int) -> tuple[Tree, DataFrame, tuple]:
    """(tree, blocks by leaf with slices, sample) of ``rows`` (vec_id, label, vector)."""
    spark = rows.sparkSession
    picked = rows.orderBy(F.xxhash64("vec_id", "label", "vector"), "vec_id").limit(SAMPLE_ROWS).collect()
    sample = np.zeros((len(picked), dims), np.int64)
    for i, r in enumerate(picked):
        sample[i, :len(r["vector"])] = r["vector"]
    tree = Tree(sample, norm, dims)
    shared = spark.sparkContext.broadcast(tree)
    labels = np.array([r["label"] for r in picked], np.int64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = shared.value.route(_padded(batch.column("vector"), dims))
            yield pa.RecordBatch.from_pydict({
                "leaf": pa.array(leaf, pa.int32()),
                **{c: batch.column(c) for c in ("vec_id", "label", "vector")}})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        leaf, held, parts = None, 0, []

        def block() -> pa.RecordBatch:
            nonlocal n
            n += 1
            table = pa.Table.from_batches(parts)
            body = _padded(table.column("vector"), dims)
            low, high = [], []
            for _, _, d in shared.value.route(body)[1]:  # one way down: all rows have one leaf
                low += d.min(0).tolist()
                high += d.max(0).tolist()
            return pa.RecordBatch.from_pydict({
                "leaf": pa.array([leaf], pa.int32()), "uid": pa.array([part << 28 | n], pa.int64()),
                "ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.int32())),
                "body": [body.astype("<i4").tobytes()],
                "low": pa.array([low], pa.list_(pa.float64())),
                "high": pa.array([high], pa.list_(pa.float64()))})

        for batch in batches:
            leaves = np.asarray(batch.column("leaf"))
            edges = [0, *(np.flatnonzero(np.diff(leaves)) + 1).tolist(), len(leaves)]
            for a, b in zip(edges, edges[1:]):
                while a < b:
                    if held and (leaves[a] != leaf or held >= BLOCK_ROWS):
                        yield block()
                        held, parts = 0, []
                    step = min(b - a, BLOCK_ROWS - held)
                    leaf, held = int(leaves[a]), held + step
                    parts.append(batch.slice(a, step))
                    a += step
        if held:
            yield block()

    routed = rows.mapInArrow(route, "leaf int, vec_id long, label int, vector array<long>")
    salted = routed.withColumn("_salt", F.xxhash64("vec_id", F.monotonically_increasing_id()))
    ordered = salted.repartitionByRange("leaf", "_salt").sortWithinPartitions("leaf").drop("_salt")
    blocks = materialize(ordered.mapInArrow(pack, _BLOCK), "gnat-blocks")
    edges = blocks.select("leaf", F.posexplode(F.arrays_zip("low", "high")))
    edges = edges.groupBy("leaf", "pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"))
    by_leaf: dict[int, tuple[list, list]] = {}
    for r in edges.orderBy("leaf", "pos").collect():  # leaves times split points on a path, at most
        low, high = by_leaf.setdefault(r["leaf"], ([], []))
        low.append(r["low"])
        high.append(r["high"])
    tree.set_ranges(by_leaf)
    return tree, blocks, (sample, labels)


def _slices(blocks: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The blocks with a slice of their leaf, and the number of slices of each leaf."""
    count = {r["leaf"]: -(-r["count"] // SLICE_BLOCKS) for r in blocks.groupBy("leaf").count().collect()}
    known = blocks.sparkSession.createDataFrame(list(count.items()), "leaf int, n_slices int")
    return (blocks.join(F.broadcast(known), "leaf")
            .withColumn("slice", F.pmod(F.xxhash64("uid"), F.col("n_slices")).cast("int"))
            .select("leaf", "slice", "uid", "ids", "labels", "body")), count


def _anchors(blocks: DataFrame, is_anchor, dims: int) -> DataFrame:
    """The anchors among the blocks' rows, in few files, by leaf."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, uid = batch.column("ids")[i].as_py(), batch.column("uid")[i].as_py()
                at = [k for k, x in enumerate(ids) if x is not None and is_anchor(x)]
                body = np.frombuffer(batch.column("body")[i].as_py(), "<i4").reshape(-1, dims)
                labels = batch.column("labels")[i].as_py()
                yield pa.RecordBatch.from_pydict({
                    "anchor_row": pa.array([uid << 12 | k for k in at], pa.int64()),
                    "anchor_id": pa.array([ids[k] for k in at], pa.int64()),
                    "label": pa.array([labels[k] for k in at], pa.int32()),
                    "vector": pa.array([body[k].tolist() for k in at], pa.list_(pa.int32())),
                    "positives": pa.array([None] * len(at), pa.list_(pa.struct(
                        [("id", pa.int64()), ("score", pa.int64())])))})

    return materialize(blocks.select("uid", "ids", "labels", "body").mapInArrow(pick, _ANCHOR),
                       "gnat-anchors")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ANCHORS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _best(scores: np.ndarray, ids: list, among: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` numbers of ``among`` by score, then by id, a null id last."""
    if len(among) > 4 * n:  # what lies below the n-th score can't be among them
        edge = np.partition(scores[among], len(among) - n)[len(among) - n]
        among = among[scores[among] >= edge]
    return np.array(sorted(among.tolist(), key=lambda k: (-scores[k], ids[k] is None, ids[k] or 0))[:n],
                    np.int64)


def _search(index, anchors: DataFrame, windows, per_leaf, schema: str) -> DataFrame:
    """Anchors meet the blocks of the leaves they reach; ``per_leaf`` scores each meeting.

    ``windows(vectors, labels, positives, sample)`` gives (anchor number, low, high) arrays,
    the score windows; ``per_leaf`` gives rows of ``schema``.
    """
    tree, (blocks, n_slices), (sample, sample_labels), dims = index
    spark = anchors.sparkSession
    shared = spark.sparkContext.broadcast((tree, sample, sample_labels, n_slices))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample, sample_labels, n_slices = shared.value
        for table in _chunks(batches):
            vectors, labels = _padded(table.column("vector"), dims), np.asarray(table.column("label"))
            positives = table.column("positives").to_pylist()
            who, low, high = windows(vectors, labels, positives, dot(vectors, sample), sample_labels)
            asked = vectors[who]
            inner = tree.radius(asked, high) - tree.slack
            outer = tree.radius(asked, low) + tree.slack
            for leaf, alive in tree.reached(asked, inner, outer):
                mine, back = np.unique(who[alive], return_inverse=True)
                queries = [pa.array(x) for x in (back.astype(np.int32), alive_rank(who)[alive],
                                                 low[alive], high[alive])]
                body = pa.table({
                    "anchor_row": table.column("anchor_row").take(mine),
                    "anchor_id": table.column("anchor_id").take(mine),
                    "label": pa.array(labels[mine], pa.int32()),
                    "vector": pa.FixedSizeListArray.from_arrays(
                        pa.array(vectors[mine].astype(np.int32).ravel()), dims)})
                packed = _ipc(body), _ipc(pa.table(dict(zip(("who", "query", "low", "high"), queries))))
                n = n_slices[leaf]
                yield pa.RecordBatch.from_pydict({
                    "leaf": pa.array([leaf] * n, pa.int32()), "slice": pa.array(range(n), pa.int32()),
                    "anchors": [packed[0]] * n, "queries": [packed[1]] * n})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                asked, queries = _table(row["anchors"]), _table(row["queries"])
                vectors = asked.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dims)
                body = np.frombuffer(row["body"], "<i4").reshape(-1, dims)
                out = per_leaf(asked, queries, dot(vectors, body), row["ids"],
                               np.array(row["labels"], np.int64), row["uid"])
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_arrow(schema))

    chunks = max(1, -(-anchors.count() // ANCHORS_AT_ONCE))
    probes = anchors.coalesce(chunks).mapInArrow(
        probe, "leaf int, slice int, anchors binary, queries binary")
    # neither side has a proven bound, whatever Spark makes of the sizes of packed rows
    return (blocks.join(probes.hint("merge"), ["leaf", "slice"]).drop("leaf", "slice")
            .mapInArrow(meet, schema))


def alive_rank(who: np.ndarray) -> np.ndarray:
    """For each window its number among its anchor's windows (they stand together, in order)."""
    first = np.searchsorted(who, who, side="left")
    return (np.arange(len(who)) - first).astype(np.int32)


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


_FOUND = ("anchor_row long, anchor_id long, query int, found_id long, score long")


def _threshold(scores: np.ndarray, n: int) -> float:
    """A score that the n-th best of all rows reaches, from some of them; -inf if too few."""
    return float(np.partition(scores, len(scores) - n)[len(scores) - n]) if len(scores) >= n else -np.inf


def positives_of(index, anchors: DataFrame, n: int) -> DataFrame:
    """The anchors with their first ``n`` other rows of the same label."""
    def windows(vectors, labels, _, scores, sample_labels):
        # one of the sample's rows may be the anchor itself, so the threshold is one lower
        low = np.array([_threshold(s[sample_labels == x], n + 1) for s, x in zip(scores, labels)])
        return np.arange(len(vectors)), low, np.full(len(vectors), np.inf)

    def per_leaf(asked, queries, scores, ids, labels, uid):
        out, rows = [], asked.column("anchor_row").to_pylist()
        names, own = asked.column("anchor_id").to_pylist(), asked.column("label").to_pylist()
        for who, low in zip(queries.column("who").to_pylist(), queries.column("low").to_pylist()):
            mine = scores[who]
            good = (labels == own[who]) & (mine >= low)
            if rows[who] >> 12 == uid:
                good[rows[who] & 4095] = False
            out += [{"anchor_row": rows[who], "anchor_id": names[who], "query": 0,
                     "found_id": ids[k], "score": int(mine[k])}
                    for k in _best(mine, ids, np.flatnonzero(good), n)]
        return out

    found = _search(index, anchors, windows, per_leaf, _FOUND)
    order = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(),
                                                     F.col("found_id").asc_nulls_last())
    best = (found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= n)
            .groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct(
                "at", F.col("found_id").alias("id"), "score"))).alias("found")))
    kinds = "array<struct<id:long,score:long>>"
    return materialize(anchors.drop("positives").join(best, "anchor_row").withColumn(
        "positives", F.transform("found", lambda x: F.struct(
            x["id"].alias("id"), x["score"].alias("score"))).cast(kinds)).drop("found"), "gnat-positives")


def negatives_of(index, anchors: DataFrame, n: int, low: int, high: int) -> DataFrame:
    """For each anchor and positive its first ``n`` rows of other labels in the window."""
    def windows(vectors, labels, positives, scores, sample_labels):
        who, lows, highs = [], [], []
        for i, found in enumerate(positives):
            other = scores[i][sample_labels != labels[i]]
            for p in found:
                least, most = -((-low * p["score"]) // 100), high * p["score"] // 100
                known = _threshold(other[(other >= least) & (other <= most)], n)
                who.append(i)
                lows.append(max(float(least), known) if least <= most else np.inf)
                highs.append(float(most))
        return np.array(who, np.int64), np.array(lows), np.array(highs)

    def per_leaf(asked, queries, scores, ids, labels, uid):
        out, rows = [], asked.column("anchor_row").to_pylist()
        names, own = asked.column("anchor_id").to_pylist(), asked.column("label").to_pylist()
        columns = [queries.column(c).to_pylist() for c in ("who", "query", "low", "high")]
        for who, query, least, most in zip(*columns):
            mine = scores[who]
            good = np.flatnonzero((labels != own[who]) & (mine >= least) & (mine <= most))
            out += [{"anchor_row": rows[who], "anchor_id": names[who], "query": query,
                     "found_id": ids[k], "score": int(mine[k])} for k in _best(mine, ids, good, n)]
        return out

    found = _search(index, anchors, windows, per_leaf, _FOUND)
    order = Window.partitionBy("anchor_row", "query").orderBy(F.col("score").desc(),
                                                              F.col("found_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    positives = anchors.select("anchor_row", F.posexplode("positives").alias("query", "positive"))
    return best.join(positives, ["anchor_row", "query"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), "rank",
        F.col("found_id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"))


def mine(rows: DataFrame, label: Column, anchor_every: int = 100, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` needs ``vec_id`` and ``embedding``, ``label`` is an expression over it. Anchors
    are the rows whose id is divisible by ``anchor_every``; a negative scores ``low`` to
    ``high`` percent of the positive. Rows with a null label or vector, or a null or
    non-finite component, take no part. Vectors of unequal length are compared as if filled up
    with zeros. Repeated ids and rows are rows of their own; a null id is no anchor and comes
    last among ties. A positive of a negative score has no negatives, an anchor without
    positives gives no rows, an empty table gives none. Components beyond ±2^26 after scaling
    count as that bound.
    """
    spark = session_of(rows)
    vector = F.col("embedding").cast("array<double>")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"),
                       vector.alias("vector")).where(F.col("label").isNotNull() & finite(F.col("vector")))
    kept = materialize(kept.select("vec_id", "label", scaled(F.col("vector"), scale, LIMIT).alias("vector")),
                       "gnat-rows")
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    norm, dims = kept.agg(F.max(square), F.max(F.size("vector"))).head()
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")
    if norm is None:
        return spark.createDataFrame([], out)
    dims = max(dims, 1)
    tree, blocks, sample = build_index(kept, norm, dims)
    index = (tree, _slices(blocks), sample, dims)
    anchors = _anchors(blocks, lambda x: x % anchor_every == 0, dims)
    return negatives_of(index, positives_of(index, anchors, positives), negatives, low, high)
