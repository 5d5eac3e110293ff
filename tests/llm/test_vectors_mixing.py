"""Clustering, hard negatives and mixing, held to plain Python over small awkward tables."""

import hashlib
import math
import random
import struct
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import catalog, centroids, mixing, negatives

CLASH = ["ids", "body", "pivots", "vector", "leaf", "uid", "slice", "row", "part", "s", "size", "block",
         "cluster", "distance", "score", "rank", "target", "words", "labels", "low", "high"]


def vectors(seed=1, n=150, dims=64):
    """(vec_id, embedding, label): groups about centres, copies, ties, and rows that take no part."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.4, 0.4) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.08) for x in centres[i % 5]], i % 5) for i in range(n)]
    rows += [(200 + i, rows[3][1], i % 3) for i in range(12)]  # copies
    rows += [(100, rows[7][1], 2), (100, rows[8][1], 2), (None, rows[9][1], 4), (300, [0.0] * dims, 1)]
    rows += [(301, None, 1), (302, [math.nan] * dims, 1), (303, [math.inf, *[0.1] * (dims - 1)], 2),
             (304, [None, *[0.1] * (dims - 1)], 2), (305, [0.1] * (dims - 1), 3), (306, [], 0),
             (307, rows[4][1], None), (308, [1.0e9] * dims, 1)]
    return rows


def table(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.repartition(partitions).withColumns({c: F.lit(7) for c in CLASH})


def whole(vector, scale, limit):
    return [max(-limit, min(limit, math.floor(scale * x))) for x in vector]


def finite(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def lloyd(rows, k=8, rounds=10, dims=64):
    kept = [(i, whole(v, 1024, centroids.LIMIT)) for i, v, _ in rows
            if v is not None and len(v) == dims and finite(v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for i, v in sorted(kept, key=lambda r: (name(r[0]), r[0] or 0, r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c
                 for j, c in enumerate(cents)]
    found = [(i, *nearest(v)) for i, v in kept]
    by = Counter()
    for _, d, j in found:
        by[j] += d
    return sorted(((i, j, d, by[j], sum(by.values()), centroids.centroid_hash(cents[j]))
                   for i, d, j in found), key=str)


def test_clusters_equal_brute_force(spark):
    for rows in (vectors(), vectors(2, 40)[:5], vectors()[3:4] * 20):
        got = centroids.cluster(table(spark, rows)).collect()
        assert sorted((tuple(r) for r in got), key=str) == lloyd(rows)


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], 1)]):
        df = centroids.cluster(table(spark, rows))
        assert df.count() == 0 and df.columns[:3] == ["vec_id", "cluster", "distance"]


@pytest.mark.parametrize("spread", [3, 1000, 1 << 26])
def test_ptolemaic_bounds_never_exceed_distances(spread):
    rng = np.random.default_rng(spread)
    rows, cents = (rng.integers(-spread, spread, (n, 16)) for n in (400, 9))
    cents[0], rows[:5] = rows[7], cents[1]  # distances of zero
    pivots = centroids.choose_pivots(rows[:64])
    pairs = centroids.pivot_pairs(pivots)
    low = centroids.lower_bounds(centroids.pivot_distances(rows, pivots),
                                 centroids.pivot_distances(cents, pivots), pivots, pairs)
    exact = np.array([centroids.squared(rows, c) for c in cents]).T
    assert (low <= exact).all() and (low > 0.2 * exact).any()


def test_bounds_spare_distances():
    rng = np.random.default_rng(5)
    cents = rng.integers(-5000, 5000, (8, 64))
    rows = np.concatenate([c + rng.integers(-40, 40, (100, 64)) for c in cents])
    pivots = centroids.choose_pivots(rows[::7])
    near, best, checked = centroids.assign(rows, centroids.pivot_distances(rows, pivots), cents, pivots,
                                           centroids.pivot_pairs(pivots))
    exact = np.array([centroids.squared(rows, c) for c in cents]).T
    assert (near == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert checked < 0.4 * exact.size


def mined(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    kept = [(i, y, whole(v, 256, negatives.LIMIT)) for i, v, y in rows if y is not None and finite(v)]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for at, (i, y, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, z) for b_at, (j, z, w) in enumerate(kept) if b_at != at]
        for ps, j, _ in sorted((t for t in scored if t[2] == y), key=order)[:n_pos]:
            fit = [t for t in scored if t[2] != y and low * ps <= 100 * t[0] <= high * ps]
            out += [(i, j, r + 1, t[1], ps, t[0]) for r, t in enumerate(sorted(fit, key=order)[:n_neg])]
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [{}, {"SAMPLE_ROWS": 60, "BLOCK_ROWS": 8, "SLICE_BLOCKS": 1,
                                           "LEAF_SAMPLE": 8, "FANOUT": 4, "ANCHORS_AT_ONCE": 3}])
def test_negatives_equal_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(negatives, name, value)
    for rows, every in ((vectors(), 100), (vectors(4, 300, 16), 10), (vectors()[3:4] * 9, 1)):
        got = negatives.mine(table(spark, rows), F.col("label"), every).collect()
        assert sorted((tuple(r) for r in got), key=str) == mined(rows, every)


def test_negatives_of_nothing(spark):
    for rows in ([], [(100, None, 1)], [(100, [0.5], 1)], [(100, [], 1), (200, [], 1), (3, [], 2)]):
        got = negatives.mine(table(spark, rows), F.col("label")).collect()
        assert sorted((tuple(r) for r in got), key=str) == mined(rows)


def test_tree_loses_no_row_of_an_annulus():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-90, 90, 12) + rng.integers(-15, 15, (300, 12)) for _ in range(6)])
    norm = int((rows ** 2).sum(1).max())
    tree = negatives.Tree(rows[rng.permutation(len(rows))[:400]], norm, 12)
    leaf, seen = tree.route(rows)
    by_leaf = {}
    for x in np.unique(leaf):
        low, high = [], []
        for _, _, d in tree.route(rows[leaf == x])[1]:
            low += d.min(0).tolist()
            high += d.max(0).tolist()
        by_leaf[int(x)] = low, high
    tree.set_ranges(by_leaf)
    asked = rows[::90]
    scores = negatives.dot(asked, rows)
    top = np.sort(scores, 1)[:, -40:]
    for least, most in ((top[:, 0], np.full(len(asked), np.inf)), (top[:, 0] * 0.3, top[:, 30] * 0.9)):
        found = dict.fromkeys(range(len(asked)), frozenset())
        reached = tree.reached(asked, tree.radius(asked, most) - tree.slack,
                               tree.radius(asked, least) + tree.slack)
        for x, alive in reached:
            for a in alive:
                found[int(a)] |= {x}
        for a in found:
            needed = set(leaf[(scores[a] >= least[a]) & (scores[a] <= most[a])].tolist())
            assert needed <= found[a]
    assert sum(map(len, found.values())) < 0.9 * len(asked) * tree.n_leaves


# --- mixing -----------------------------------------------------------------------------

def corpus(seed=1):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab cd Straße x\x0by".split(" ")) for _ in range(n))
    rows = [(i, f"s{rng.choice([0, 0, 0, 0, 1, 2, 10])}", text(rng.randint(0, 300))) for i in range(120)]
    rows += [(500, "s0", text(9000)), (501, "tiny", "one two"), (502, "none", ""), (503, "none", None),
             (504, None, text(70)), (505, None, text(64)), (506, "", text(100)), (None, "s1", text(40)),
             (7, "s1", text(30)), (7, "s1", text(30)), (508, "ü", text(128)), (509, "￿", text(5)),
             (510, "\U00010000", text(200))]
    return rows + [rows[3]] * 3


def docs_of(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return df.repartition(partitions).withColumns({c: F.lit(7) for c in CLASH})


def count_words(text):
    return len((text or "").encode().split())  # bytes split at ASCII white space


def shares(sizes, weights=(3, 1, 2), factor=Fraction(3, 2), most=2):
    """Targets by sharing, stopping and sharing the excess again, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total, target = list(order), factor * sum(sizes.values()), {}
    while left:
        each = total / sum(weight[s] for s in left)
        over = [s for s in left if each * weight[s] > most * sizes[s]]
        for s in over or left:
            target[s] = Fraction(most * sizes[s]) if over else each * weight[s]
        total -= sum(target[s] for s in over)
        left = [s for s in left if s not in target]
    return order, target


def spark_hash(*values):
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, np.int32) else "<q", v)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def permuted(x, n, s, turn, seed=13):
    for r in range(1, mixing.ROUNDS + 1):
        key = (np.int32(seed), np.int32(s), turn, np.int32(r))
        other = (spark_hash(*key) % n - x) % n
        if spark_hash(*key, max(x, other)) & 1:
            x = other
    return x


def mixed(rows, size=64):
    """(doc_id, size, source, source_size, target, taken), block by block."""
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += count_words(text)
    order, target = shares(sizes)
    out = []
    for s, source in enumerate(order):
        mine = sorted(((i is not None, i or 0, spark_hash(t) if t is not None else 42, count_words(t), i)
                       for i, x, t in rows if x == source))
        total, words = sizes[source], round(target[source])
        stream = [d for d, row in enumerate(mine) for _ in range(row[3])]
        full, tail = divmod(total, size)
        taken, j, left = Counter(), 0, words
        while left > 0:
            turn, index = divmod(j, full + (tail > 0))
            block = permuted(index, full, s, turn) if index < full else full
            got = stream[block * size:(block + 1) * size][:left]
            taken.update(got)
            left, j = left - len(got), j + 1
        out += [(row[4], row[3], source, total, float(target[source]), taken[d]) for d, row in enumerate(mine)]
    return out


def test_mixing_equals_brute_force(spark):
    rows = corpus()
    got = [tuple(r) for r in mixing.mixed_documents(docs_of(spark, rows)).collect()]
    want = mixed(rows)
    plain = lambda out: sorted(((*r[:4], round(r[4], 6), r[5]) for r in out), key=str)
    assert plain(got) == plain(want)
    again = mixing.mixed_documents(docs_of(spark, rows[::-1], 5)).collect()
    assert plain(map(tuple, again)) == plain(want)
    assert all(r[5] <= 2 * r[1] for r in got)
    for source in {r[2] for r in got}:
        mine = [r for r in got if r[2] == source]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= 0.5


def test_mix_pieces_fill_their_slots(spark):
    rows = corpus(2)
    docs = docs_of(spark, rows)
    found = mixing.mix(docs, shard_slots=16).collect()
    slots = defaultdict(list)
    for r in found:
        slots[(r["source"], r["slot"])].append(r)
    for pieces in slots.values():  # gapless from word 0, in one shard, not longer than a block
        pieces.sort(key=lambda r: r["at"])
        assert [r["at"] for r in pieces] == [sum(p["length"] for p in pieces[:i]) for i in range(len(pieces))]
        assert sum(r["length"] for r in pieces) <= 64 and len({r["shard"] for r in pieces}) == 1
    per_shard = Counter(p[0]["shard"] for p in slots.values())
    assert set(sorted(per_shard.values())[1:]) == {16} and len(per_shard) > 10
    mix = Counter(p[0]["source"] for p in slots.values() if p[0]["shard"] == 0)
    assert len(mix) > 1  # a shard has several sources
    totals = Counter()
    for r in found:
        totals[r["doc_id"]] += r["length"]
    want = Counter()
    for r in mixing.mixed_documents(docs).collect():
        want[r["doc_id"]] += r["taken"]
    assert +totals == +want


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 64, 1000, 1023):
        got = spark.range(n).select(mixing._permuted(
            F.col("id"), F.lit(n).cast("long"), F.lit(13), F.lit(2), F.lit(1).cast("long")).alias("x"))
        values = [r["x"] for r in got.collect()]
        assert sorted(values) == list(range(n))
        assert values == [permuted(x, n, 2, 1) for x in range(n)]
        if n > 500:  # looks random: neighbours don't stay near each other
            assert np.corrcoef(values, range(n))[0, 1] < 0.15


def test_mixing_of_nothing(spark):
    assert mixing.mixed_documents(docs_of(spark, [])).count() == 0
    got = mixing.mixed_documents(docs_of(spark, [(1, "a", None), (2, None, " ")])).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2]
    assert all(r["size"] == r["taken"] == r["target"] == 0 for r in got)


def test_targets_of_random_sources(spark):
    rng = random.Random(8)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 3000]) for i in range(rng.randint(1, 12))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = shares(sizes)[1]
        assert got.keys() == want.keys()
        assert all(abs(got[s] - float(want[s])) < 1e-6 for s in got)


def test_registered_vector_and_mixing_queries(spark):
    sf = "/root/testdata/sf0.001"
    assert catalog.op11_centroids(spark, sf).count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    got = catalog.op13_mixing(spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    plain = lambda out: sorted((r[0], r[1], r[3], round(r[4], 6), r[5]) for r in out)
    assert plain(tuple(r) for r in got) == plain(mixed([tuple(r) for r in rows]))
