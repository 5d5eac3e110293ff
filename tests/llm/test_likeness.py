"""SimHash (op8), fingerprints (op7), decontamination (op2), pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from daybook.llm import catalog, decontamination, fingerprints, simhash, toxicity
from daybook.llm.components import components
from daybook.llm.tokens import tokenizer_path
from llm_cases import empty, messy, sentence, texts


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values, max_bits):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_simhash_components(spark):
    rows = texts()
    got = simhash.near_duplicates(messy(spark)).collect()
    fps = [plain_simhash(t) for _, t in rows]
    root = plain_components(fps, 2)
    least = {}
    for (doc_id, _), fp in zip(rows, fps):
        if doc_id is not None:
            least[root[fp]] = min(least.get(root[fp], doc_id), doc_id)
    want = Counter((doc_id, f"{fp:016x}", least.get(root[fp])) for (doc_id, _), fp in zip(rows, fps))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("crowd,segments", [(256, 2), (0, 2), (1, 2), (256, 4)])
def test_links_find_every_near_pair(spark, crowd, segments):
    rng = random.Random(crowd)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, 1, 3, (1 << 64) - 1}
    for v in list(values):  # chains, and a crowd about one value
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
            v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.links(fps, 2, segments, crowd)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in found.collect())
    got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(found).collect()}
    root = plain_components(values, 2)
    groups, plain = {}, {}
    for v in values:
        groups.setdefault(got.get(v, v), set()).add(v)
        plain.setdefault(root[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(edges.repartition(5)).collect()
    assert len(got) == 300 and {r.root for r in got} == {0}


def test_keep_one_of_each_group(spark):
    docs = messy(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    near = simhash.near_duplicates(docs).collect()
    groups = {r.fingerprint: r.component_id for r in near}
    assert len(rows) == len({plain_components([plain_simhash(t) for _, t in texts()], 2)[f]
                             for f in {plain_simhash(t) for _, t in texts()}})
    for r in rows:
        assert r.doc_id == groups[f"{plain_simhash(r.text):016x}"]


def test_keep_one_with_columns_that_have_no_order(spark):
    docs = messy(spark).withColumn("props", F.create_map(F.lit("k"), F.col("doc_id")))
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema and kept.count() == simhash.keep_one(messy(spark)).count()


def shingles(text):
    words = [w for w in (text or "").lower().translate(
        {ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_plain_sets(spark):
    got = fingerprints.fingerprint_documents(messy(spark)).collect()
    rows = sorted(texts(), key=lambda r: r[1] or "", reverse=True)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    want = Counter()
    exact, small = {}, 0
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        key = (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest())
        want[key] += 1
        exact[key] = (jaccard(shingles(text), shingles(edited)),
                      jaccard(shingles(text), shingles(after)),
                      max(len(shingles(text) | shingles(edited)), len(shingles(text) | shingles(after))))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    for r in got:
        near_edited, near_next, size = exact[r.doc_id, r.n_chars, r.edited_sha256]
        close = 1e-12 if size <= fingerprints.K else 0.2
        small += size <= fingerprints.K
        assert abs(r.near_edited - near_edited) <= close and abs(r.near_next - near_next) <= close
    assert small > 30
    assert fingerprints.fingerprint_documents(empty(spark)).count() == 0
    plan = fingerprints.fingerprint_documents(messy(spark))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString()


def test_sketches_merge_and_estimate(spark):
    a, b = [f"w{i}" for i in range(3000)], [f"w{i}" for i in range(1000, 5000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:1500]), " ".join(a[1496:]))],
                               "a string, b string, a1 string, a2 string")
    s = {c: fingerprints.sketch(F.col(c), 256) for c in df.columns}
    r = df.select(
        fingerprints.distinct_shingles(s["a"], 256).alias("n"),
        fingerprints.resemblance(s["a"], s["b"], 256).alias("j"),
        fingerprints.containment(s["a"], s["b"], 256).alias("c"),
        (fingerprints.merge(s["a1"], s["a2"], 256) == s["a"]).alias("merged"),
        fingerprints.distinct_shingles(fingerprints.sketch(F.lit("one two"))).alias("few")).head()
    assert r.merged and r.few == 1
    assert abs(r.n / 2996 - 1) < 0.25 and abs(r.j - 0.4) < 0.12 and abs(r.c - 2 / 3) < 0.2


def test_hot_ids_and_many_ranges(spark):
    rows = [(i, f"text number {i} of many words here") for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {r.doc_id: r for r in fingerprints.with_next(messy(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(got[i].next_text == rows[(i - 1) % 300][1] for i in range(300))


def brute_tiles(a, b, least):
    """Greedy tiling by trying every pair of places, longest first."""
    used_a, used_b, out = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                       and i + k not in used_a and j + k not in used_b):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        out.append(best)
        used_a |= set(range(best[1], best[1] + best[0]))
        used_b |= set(range(best[2], best[2] + best[0]))


@pytest.mark.parametrize("seed", range(30))
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    b = [rng.randint(1, 4 + seed) for _ in range(rng.randint(1, 40))]
    a = [rng.randint(1, 4 + seed) for _ in range(30)]
    for _ in range(3):
        s = rng.randrange(len(b))
        at = rng.randrange(len(a))
        a[at:at] = b[s:s + rng.randint(2, 15)]
    least = min(rng.choice([2, 3, 5]), len(b))
    got, want = decontamination.tiles(a, b, least), brute_tiles(a, b, least)
    assert sum(t[0] for t in got) == sum(t[0] for t in want)
    assert sorted(t[0] for t in got) == sorted(t[0] for t in want)
    for k, i, j in got:
        assert a[i:i + k] == b[j:j + k]


def test_decontamination_cases(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, 40)) for i in range(6)] + [(6, "tiny item"), (7, None), (8, " . "),
                                                          (None, sentence(rng, 30)), (9, None)]
    w = [decontamination.words_of(t) for _, t in items]
    moved = " ".join(w[1][24:] + w[1][12:24] + w[1][:12])  # sentences in another order
    rows = [(1, f"{sentence(rng, 50)} {items[0][1]} {sentence(rng, 9)}"), (2, f"so {moved} end"),
            (3, " ".join(w[2][:12])), (4, sentence(rng, 80)), (5, None), (6, ""),
            (7, "a TINY, item!"), (8, items[9][1]), (1, items[3][1]), (None, items[4][1]),
            (10, " ".join(x for i, x in enumerate(w[5]) if i % 6 != 5))]
    marks = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    docs = messy(spark, rows)
    for block_words in (1 << 20, 30):
        got = {(r.doc_id, r.n_words): r for r in
               decontamination.judged(docs, marks, block_words=block_words).collect()}
        assert len(got) == len(rows)
        flagged = {k[0]: r.item_id for k, r in got.items() if r.contaminated}
        by_words = {k: r for k, r in got.items()}
        assert flagged[2] == 1 and flagged[7] == 6 and flagged[8] is None and flagged[None] == 4
        assert flagged[10] == 5 and not {3, 4, 5, 6} & set(flagged)
        three = next(r for k, r in by_words.items() if k[0] == 3)
        assert three.item_id == 2 and three.coverage == 12 / len(w[2]) and three.n_tiles == 1
        assert next(r for k, r in by_words.items() if k[0] == 2).n_tiles >= 2
    kept = decontamination.drop_contaminated(docs, marks)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 4, 5, 6])
    nothing = marks.filter("false")
    assert not any(r.contaminated for r in decontamination.judged(docs, nothing).collect())
    assert decontamination.drop_contaminated(docs, nothing).count() == len(rows)
    assert decontamination.judged(empty(spark), marks).count() == 0


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash", "suffix-array", "decontamination", "packing"]
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, counts = df.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, SF_SMALL).toPandas(), df.schema)
        assert df.columns == columns, name
        counts.append(df.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] > 100
    assert all(r.n_chars == len(r.text) for r in df.collect())
    pieces = corpus_pipeline.run(spark, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == counts[3]


def plain_without_repeats(rows):
    """Texts without the bytes of 50-byte strings that a document of a smaller id has."""
    first = {}
    for doc_id, text in rows:
        data = text.encode()
        for i in range(len(data) - 49):
            window = data[i:i + 50]
            first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data, gone = text.encode(), set()
        for i in range(len(data) - 49):
            if first[data[i:i + 50]] < doc_id:
                gone |= set(range(i, i + 50))
        out.append((doc_id, bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore")))
    return out


def plain_coverage(text, item):
    """Share of an item's words that greedy tiles of five words or more cover."""
    a, b = decontamination.words_of(text), decontamination.words_of(item)
    least = min(5, len(b))
    runs = {tuple(b[j:j + least]) for j in range(len(b) - least + 1)}
    if not b or not any(tuple(a[i:i + least]) in runs for i in range(len(a) - least + 1)):
        return 0.0
    return sum(t[0] for t in brute_tiles(a, b, least)) / len(b)


def test_pipeline_equals_plain_python(spark):
    """What run() packs, recomputed stage by stage; of the model only its weights are Spark's."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect()]
    machine, terms = toxicity.train(docs, labels), toxicity._Terms()
    rows = [r for r in rows if machine.score(terms.of(r[1])) < 0.5]
    component = plain_components([plain_simhash(t) for _, t in rows], 2)
    least = {}
    for doc_id, text in rows:
        root = component[plain_simhash(text)]
        least[root] = min(least.get(root, doc_id), doc_id)
    rows = plain_without_repeats([r for r in rows if r[0] in set(least.values())])
    items = [r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [r for r in rows if all(plain_coverage(r[1], item) < 0.5 for item in items)]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}
    got = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got.keys() == want.keys() and 100 < len(want) < 200
    for doc_id, pieces in got.items():
        at = 0
        for p in sorted(pieces, key=lambda r: r.start):
            ids = want[doc_id][at:at + p.length]
            assert p.start == at and p.doc_tokens == len(want[doc_id])
            assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += p.length
        assert at == len(want[doc_id])


def test_pipeline_on_messy_rows(spark):
    docs = messy(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() > 0, name
        assert stage(spark, empty(spark), SF_SMALL).count() == 0, name


def test_every_operator_has_a_query(spark):
    names = [n.split("_")[0] for n in catalog.queries()]
    assert names == [f"op{i}" for i in range(1, 14)]
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
