"""Language model (op9), toxicity (op10), URL filter (op6)."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import language_model as lm
from daybook.llm import toxicity, url_filter
from llm_cases import empty, messy, texts

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens_of(text):
    return [*(text or "").translate(UPPER).encode().split(), "end"]


@pytest.mark.parametrize("order,chunk_bytes", [(1, 1 << 20), (2, 1500), (3, 1 << 20)])
def test_language_model_equals_plain_counts(spark, monkeypatch, order, chunk_bytes):
    learned = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights",
                        lambda *a, **k: learned.append(learn(*a, **k)) or learned[-1])
    got = lm.score_documents(messy(spark), order=order, chunk_bytes=chunk_bytes).collect()
    weights = learned[0]
    assert np.allclose(weights.sum(1), 1) and (weights > 0).all()
    counts, contexts = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for doc_id, text in texts():
        if not lm.held_out(doc_id):
            w = ["start"] * (order - 1) + tokens_of(text)
            for i in range(order - 1, len(w)):
                for n in range(1, order + 1):
                    counts[n][tuple(w[i - n + 1:i + 1])] += 1
                    contexts[n][tuple(w[i - n + 1:i])] += 1
    total, types = sum(counts[1].values()), len(counts[1])
    want = []
    for doc_id, text in texts():
        w, score, base, known = ["start"] * (order - 1) + tokens_of(text), 0.0, 0.0, 0
        for i in range(order - 1, len(w)):
            c = counts[1][(w[i],)]
            seen = contexts[order][tuple(w[i - order + 1:i])] if order > 1 else total
            mix = weights[min(int(seen).bit_length(), lm.BUCKETS - 1)]
            p = mix[0] / (types + 1)
            for n in range(1, order + 1):
                h = contexts[n][tuple(w[i - n + 1:i])]
                last = contexts[order][tuple(w[i - order + 1:i])]
                if n > 1 and not last:
                    p += mix[n] / (types + 1)
                elif h:
                    p += mix[n] * counts[n][tuple(w[i - n + 1:i + 1])] / h
            score += math.log10(p)
            base += math.log10((c + 0.1) / (total + 0.1 * (types + 1)))
            known += c > 0
        want.append((doc_id, lm.held_out(doc_id), len(w) - order + 1, known, total,
                     round(base, 6), round(score, 6)))
    if order < 3:  # a third-order context may be known where a longer one is not
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                        round(r.base_score, 6), round(r.score, 6)) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == \
        Counter((d, n, k, b) for d, _, n, k, _, b, _ in want)
    assert all(math.isfinite(r.score) for r in got)


def test_model_beats_base_on_held_out_text(spark):
    rng = random.Random(2)
    chain = {w: rng.sample(range(300), 4) for w in range(300)}
    rows = []
    for i in range(300):
        w, out = rng.randrange(300), []
        for _ in range(60):
            out.append(f"w{w}")
            w = rng.choice(chain[w])
        rows.append((i, " ".join(out)))
    got = [r for r in lm.score_documents(messy(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


def test_weights_follow_the_better_estimate():
    level = lm._level(np.array([0.5, 0.0, 1e-3]))
    good = ((5 * lm.LEVELS + level[0]) * lm.LEVELS + level[2])
    bad = ((2 * lm.LEVELS + level[1]) * lm.LEVELS + level[2])
    w = lm.learn_weights(np.array([bad, good]), np.array([10.0, 10.0]), 2, 100_000)
    assert w[5].argmax() == 2 and w[2].argmax() == 1
    assert (w[9] == w[5]).all() and (w[1] == 1 / 3).all()


def test_language_model_edges(spark):
    assert lm.score_documents(empty(spark)).count() == 0
    only_held = [(i, "a b c") for i in range(200) if lm.held_out(i)][:5]
    got = lm.score_documents(messy(spark, only_held)).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.score == 0 and r.n_known == 0 for r in got)


def toxic_rows(n, seed):
    """A document is toxic if it has an insult with a group's name; either alone is clean."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 60))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insult"] * insult + ["group"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    return rows, labels


def test_pairs_of_terms_are_learned(spark):
    rows, labels = toxic_rows(3000, 1)
    y = np.array([t for _, t in labels])
    terms = toxicity._Terms()
    slots = [terms.of(t) for _, t in rows]
    train, test = range(0, 2400), range(2400, 3000)
    machine = toxicity.fit([slots[i] for i in train], y[:2400], y[:2400].mean(),
                           settings=toxicity.Settings(pair_epochs=30))
    right = np.mean([(machine.score(slots[i]) >= 0.5) == y[i] for i in test])
    linear = toxicity.Machine(machine.w0, machine.w, machine.v * 0)
    assert right > 0.95
    assert right >= np.mean([(linear.score(slots[i]) >= 0.5) == y[i] for i in test])


def test_rare_pair_among_many_terms_is_learned():
    """Terms that alone tell nothing, and over 10,000 others, at the epochs of production."""
    rng = random.Random(5)

    def text(*more):
        return " ".join([*(f"word{rng.randrange(12000)}" for _ in range(40)), *more])

    rows = []
    for i in range(4000):
        u = rng.random()
        if i % 180 == 7:  # both terms are as frequent in toxic texts as in clean ones
            rows.append((text("jerk", "tribe"), 1))
        elif u < 0.11:
            rows.append((text(f"slur{rng.randrange(20)}"), 1))
        else:
            rows.append((text(*["tribe"] * (u < 0.16), *["jerk"] * (0.16 <= u < 0.21)), 0))
    terms = toxicity._Terms()
    slots, y = [terms.of(t) for t, _ in rows], np.array([t for _, t in rows])
    assert len(np.unique(np.concatenate(slots))) > 10_000
    machine = toxicity.fit(slots, y, y.mean())

    def called_toxic(*more):
        return np.mean([machine.score(terms.of(text(*more))) >= 0.5 for _ in range(200)])

    assert called_toxic("jerk", "tribe") > 0.5 and called_toxic("slur3") > 0.9
    assert max(called_toxic("jerk"), called_toxic("tribe"), called_toxic()) < 0.02


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = toxicity.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    for slots in ([], [4], [1, 7, 30, 31, 49]):
        pairs = sum(machine.v[i] @ machine.v[j] for i in slots for j in slots if i < j)
        want = 0.3 + sum(machine.w[i] for i in slots) + pairs
        assert abs(machine.margin(np.array(slots, int)) - want) < 1e-9
    rows = toxicity._Rows.of([np.array(s, int) for s in ([1, 7, 30], [], [4, 49])])
    margins = toxicity._margins(rows, machine.w0, machine.w) + toxicity._pairs(rows, machine.v)
    assert np.allclose(margins, [machine.margin(np.array(s, int)) for s in ([1, 7, 30], [], [4, 49])])


def test_held_out_folds_of_the_given_tables(spark):
    """Each fold scored by a machine, settings included, that saw the other four only."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").orderBy("doc_id").collect()
    terms = toxicity._Terms()
    texts, y = [terms.of(r["text"]) for r in rows], np.array([r["toxic"] for r in rows])
    ids = [r["doc_id"] for r in rows]
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in ids])
    areas, found = [], []
    for k in range(5):
        train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        mine = [texts[i] for i in train]
        settings = toxicity.choose(spark, [ids[i] for i in train], mine, y[train])
        machine = toxicity.fit(mine, y[train], y[train].mean(), settings=settings)
        scores = np.array([machine.score(texts[i]) for i in test])
        toxic, clean = scores[y[test] == 1], scores[y[test] == 0]
        areas.append(np.mean((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean)))
        found.append(((scores >= 0.5) & (y[test] == 1)).sum())
    assert np.mean(areas) > 0.93 and sum(found) > 0.5 * y.sum()


def test_settings_of_few_or_alike_rows_are_the_defaults(spark):
    texts = [np.array([1, 2]), np.array([3])]
    assert toxicity.choose(spark, [1, 2], texts, np.array([0, 1])) == toxicity.Settings()
    assert toxicity.choose(spark, [], [], np.array([])) == toxicity.Settings()
    assert toxicity.choose(spark, list(range(40)), texts * 20, np.zeros(40)) == toxicity.Settings()


def test_repeated_id_gives_the_fit_one_row(spark, monkeypatch):
    rows = [(i, f"words of {i} {'nasty' if i % 2 else 'kind'}") for i in range(20)]
    hot = [(3, f"another text {i % 7}") for i in range(1500)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, prior, settings: seen.append(
        sorted((bytes(t), int(y)) for t, y in zip(texts, labels))))
    for partitions in (1, 5):
        toxicity.train(messy(spark, rows + hot, partitions), marks)
    text = min({t for i, t in rows + hot if i == 3},
               key=lambda t: (xxhash.xxh64_intdigest(t, 42) + (1 << 63)) % (1 << 64))
    terms = toxicity._Terms()
    want = sorted((bytes(terms.of(t if i != 3 else text)), i % 2) for i, t in rows)
    assert seen == [want, want]


def test_toxicity_learns_only_from_training_rows(spark):
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, f"plain words here {'nasty' if bad else 'kind'} {i % 7}"))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, int(bad) ^ held))  # held-out labels are all wrong
    rows += [(1000, None), (1001, ""), (None, "nasty"), (5, rows[5][1])]
    labels += [(None, 1), (7, None), (9, 0)]
    docs = messy(spark, rows).drop("toxic")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("score", F.lit(1.0))
    got = toxicity.judged(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == (r.doc_id % 3 == 0)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1
    kept = toxicity.drop_toxic(docs, spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int"))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id and r.doc_id < 600} == \
        {i for i in range(1, 600) if i % 3}
    assert toxicity.judged(empty(spark).drop("toxic"), marks).count() == 0
    none = marks.filter("false")
    assert {r.score for r in toxicity.judged(docs, none).collect()} == {0.5}


def brute_parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    at = min(ends, default=len(rest))
    host, tail = rest[:at].translate(UPPER), rest[at:]
    ends = [i for i in (tail.find(c) for c in "?#") if i >= 0]
    return host, tail[:min(ends, default=len(tail))]


def brute_rule(host, path):
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return best or (None, None)


def test_urls_against_plain_rules(spark):
    hosts = ["example.org", "a.example.org", "Example.ORG", "notexample.org", "org", "x.org", "com",
             "b.com", "c.net", "éxample.com", "a.com:8080", "", "x.İ.org"]
    tails = ["", "/", "/es/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/", "/fr", "/de/9?x=/fr/",
             "?a=b", "#top", "/a//b?x#y", "/a#b?c"]
    urls = [f"{s}{h}{t}" for s in ("http://", "https://", "://", "") for h in hosts for t in tails]
    urls += [None, "", "http:/x.org/", "a://b://c.org/", " http://x.org/ "]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[0]), (3, urls[3])],
                                  "page_id long, url string")
    pages = pages.withColumns({c: F.lit(1) for c in ["host", "path", "rule", "label", "features",
                                                     "suffix", "n", "depth"]})
    got = url_filter.judge(pages).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is not None:
            host, path = brute_parts(urls[r.page_id])
            rule, verdict = brute_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
            assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
            assert (r.p_block is None) == (rule is not None)
    plan = url_filter.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_trees_learn_what_the_rules_show(spark):
    rng = random.Random(1)
    rules = [("allow", "good.org", "/"), ("block", "bad.org", "/")]
    rows = []
    for i in range(800):  # blocked ones have many digits and parameters
        bad, site = i % 2, ("bad.org", "good.org")[i % 2 == 0] if i < 400 else "other.net"
        tail = (f"/{rng.randrange(10**9)}?a={rng.randrange(99)}&b=1&c=2" if bad
                else "/" + "".join(rng.choice("abcdefgh") for _ in range(12)))
        rows.append((i, f"http://{site}{tail}"))
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    rest = [r for r in got if r.rule is None]
    assert len(rest) == 400
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in rest) > 380


def test_copies_of_a_url_leave_room_for_the_others(spark):
    rules = [("allow", "good.org", "/"), ("block", "bad.org", "/")]
    good = [f"http://good.org/{w}" for w in "abcdefghijklmnopqrst"]
    bad = [f"http://bad.org/{i}?a={i}&b=1&c=2" for i in range(10, 30)]
    hashes = {u: xxhash.xxh64_intdigest(u, 42) for u in good + bad}
    hot = min(good + bad, key=lambda u: (hashes[u] + (1 << 63)) % (1 << 64))
    rows = list(enumerate(good + bad + [hot] * 300 + ["http://x.net/abc", "http://x.net/7?a=7&b=1&c=2"]))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages, rules, train_rows=40).collect()}
    assert len(got) == len(rows)
    assert (got[340].verdict, got[341].verdict) == ("allow", "block")
    assert got[340].p_block is not None


def test_url_edges(spark):
    def pages(rows):
        return spark.createDataFrame(rows, "page_id long, url string")
    assert url_filter.judge(pages([])).count() == 0
    assert [r.verdict for r in url_filter.judge(pages([(1, "http://a.net/"), (2, None)])).collect()] \
        == ["allow", "allow"]
    one = url_filter.judge(pages([(1, "http://a.com/de/"), (2, "http://b.net/")])).collect()
    assert {r.page_id: r.verdict for r in one} == {1: "block", 2: "block"}
    text = spark.createDataFrame([("aab",), ("",)], "t string")
    got = [r[0] for r in text.select(url_filter.entropy(F.col("t"))).collect()]
    assert abs(got[0] - 0.9182958) < 1e-6 and got[1] == 0
