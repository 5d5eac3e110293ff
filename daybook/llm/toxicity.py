"""Toxicity: a factorization machine over hashed terms.

Terms are a text's distinct words and their beginnings, hashed to a fixed number of slots.
The score is sigmoid(w0 + sum of w_i + sum over pairs of <v_i, v_j>): the pair terms let two
words count together (an insult and a group's name) where neither does alone.

The machine is fitted on a bounded sample of labelled rows, at most ``PER_CLASS`` of each
label, those with the smallest id hashes; scoring covers every row. Weights have a fixed size
(slots times factors), so they are broadcast.

Every slot of the sample has a weight and factors. Weights come first: a slot moves as freely
as its own evidence (chi-square of its texts against the labels) allows, so a word of one or
two texts hardly does, however many there are. Factors then learn what the weights leave
unexplained. How much evidence counts, how strongly factors are held, and for how many
passes they help, is chosen on a part of the training rows that those fits leave out; the
fits run as Spark tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import BATCH_ROWS, crc32_mod, id_and_text, rows_of, session_of

SLOTS = 1 << 18
FACTORS = 4
PER_CLASS = 6_000
# Chi-squares at which a slot moves at half pace, and pulls on factors, that are tried.
EVIDENCE = (10.0, 30.0, 100.0)
HOLDS = (5e-4, 4e-3)
# Of the training rows, one in so many judges the settings.
INNER_FOLDS = 4
# Factors learn for so many epochs at least; trials end after as many that do not help.
PATIENCE = 6
# Sampled texts that a slot's factors need to count by half.
TRUST_TEXTS = 30
STEMS = (4, 6)
WEIGHT_EPOCHS = 24
EPOCHS = 24
MINI_BATCH = 64
_MARKS = ".,;:!?|()[]{}<>\"'`*#"
# Words whose slots a worker keeps.
_CACHE = 500_000


def _slots_of(word: str) -> tuple[int, ...]:
    """Slots of a word as it stands in the text: of itself and of its beginnings."""
    word = word.strip(_MARKS).lower()
    if not word:
        return ()
    terms = [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]
    return tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % SLOTS for t in terms)


class _Terms(dict):
    """Slots by word; ``kept`` limits them to slots that have weights."""

    def __init__(self, kept: np.ndarray | None = None):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[int, ...]:
        slots = _slots_of(word)
        if self.kept is not None:
            slots = tuple(s for s in slots if self.kept[s])
        self[word] = slots
        return slots

    def of(self, text: str | None) -> np.ndarray:
        """Distinct slots of a whole text, ascending."""
        if len(self) > _CACHE:
            self.clear()
        found = set().union(*map(self.__getitem__, set(text.split()))) if text else ()
        return np.sort(np.fromiter(found, np.int64, len(found)))


@dataclass
class Machine:
    """w0, w and V; a machine without V is its linear part."""
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, slots: np.ndarray) -> float:
        pairs = self.v[slots]
        return float(self.w0 + self.w[slots].sum()
                     + 0.5 * ((pairs.sum(0) ** 2).sum() - (pairs ** 2).sum()))

    def score(self, slots: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.margin(slots)))))


@dataclass(frozen=True)
class Settings:
    evidence: float = 30.0
    hold: float = 5e-4
    pair_epochs: int = EPOCHS


class _Rows:
    """Texts as slot numbers one after another, with sums by text."""

    def __init__(self, index: np.ndarray, sizes: np.ndarray):
        self.index, self.sizes = index.astype(np.int32), sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> "_Rows":
        return cls(np.concatenate([np.zeros(0, np.int32), *texts]),
                   np.array([len(t) for t in texts], np.int64))

    def part(self, which: np.ndarray) -> "_Rows":
        """The texts for which ``which`` is true."""
        return _Rows(self.index[np.repeat(which, self.sizes)], self.sizes[which])

    def numbered(self) -> tuple[np.ndarray, "_Rows"]:
        """The slots that occur, and the texts by their numbers among them."""
        active = np.unique(self.index)
        return active, _Rows(np.searchsorted(active, self.index), self.sizes)

    def batch(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slots, number of the text within the batch) of the texts ``which``."""
        sizes = self.sizes[which]
        owner = np.repeat(np.arange(len(which)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.index[np.repeat(self.starts[which], sizes) + inside], owner

    def each(self, of_batch, at_once: int = 256) -> np.ndarray:
        """``of_batch(slots, owner, n)`` for all texts, some at a time: bounds what is held."""
        parts = [np.arange(a, min(a + at_once, len(self.sizes)))
                 for a in range(0, len(self.sizes), at_once)]
        return np.concatenate([np.zeros(0), *[of_batch(*self.batch(p), len(p)) for p in parts]])


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(owner, values, n)
    return np.stack([np.bincount(owner, column, n) for column in values.T], 1)


def evidence_of(rows: _Rows, labels: np.ndarray, n_slots: int) -> np.ndarray:
    """Chi-square of each slot: how far its toxic texts are from the share of all texts."""
    n, share = len(labels), labels.mean()
    seen = np.bincount(rows.index, minlength=n_slots).astype(float)
    bad = np.bincount(rows.part(labels > 0).index, minlength=n_slots)
    spread = seen * share * (1 - share) * np.maximum(1 - seen / n, 1e-9)
    return (bad - seen * share) ** 2 / np.maximum(spread, 1e-9)


def fit_weights(rows: _Rows, labels: np.ndarray, n_slots: int, evidence: float,
                epochs: int = WEIGHT_EPOCHS, rate: float = 0.5, lasso: float = 1e-5,
                seed: int = 11) -> tuple[float, np.ndarray]:
    """(w0, w) by AdaGrad with lasso on the logistic loss, each slot at the pace of its evidence."""
    chi = evidence_of(rows, labels, n_slots)
    pace = chi ** 2 / (chi ** 2 + evidence ** 2)
    share, rng = labels.mean(), np.random.default_rng(seed)
    w, g, w0 = np.zeros(n_slots), np.full(n_slots, 1e-6), math.log(share / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), MINI_BATCH):
            which = order[at:at + MINI_BATCH]
            index, owner = rows.batch(which)
            margin = w0 + _sums(w[index] * pace[index], owner, len(which))
            miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[which]
            slots, inverse = np.unique(index, return_inverse=True)
            step = np.bincount(inverse, miss[owner], len(slots)) * pace[slots] / len(which)
            g[slots] += step ** 2
            stride = rate / np.sqrt(g[slots])
            moved = w[slots] - stride * step
            w[slots] = np.sign(moved) * np.maximum(np.abs(moved) - stride * lasso, 0)
            w0 -= 0.1 * rate * miss.mean()
    return w0, w * pace


def fit_factors(rows: _Rows, labels: np.ndarray, base: np.ndarray, n_slots: int, hold: float,
                epochs: int, factors: int = FACTORS, rate: float = 0.3, seed: int = 11, each=None
                ) -> np.ndarray:
    """Factors that explain what the margins ``base`` leave of the labels.

    A slot's factors are drawn to zero as a group by ``hold`` in every step, also where no
    text of the batch has the slot. ``each`` gets the factors after every epoch, and ends the
    fit by a true answer.
    """
    seen = np.bincount(rows.index, minlength=n_slots)
    trust = (seen / (seen + TRUST_TEXTS))[:, None]
    rng = np.random.default_rng(seed)
    v, g = rng.normal(0, 0.05, (n_slots, factors)), np.full(n_slots, 1e-3)
    step, drawn = 0, np.zeros(n_slots, np.int64)  # steps whose pull a slot has had

    def draw(slots: np.ndarray) -> None:
        due = step - drawn[slots]
        length = np.sqrt((v[slots] ** 2).sum(1)) + 1e-12
        v[slots] *= np.maximum(1 - rate / np.sqrt(g[slots]) * hold * due / length, 0)[:, None]
        drawn[slots] = step

    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), MINI_BATCH):
            which = order[at:at + MINI_BATCH]
            index, owner = rows.batch(which)
            slots, inverse = np.unique(index, return_inverse=True)
            draw(slots)
            vx = v[index] * trust[index]
            sums = _sums(vx, owner, len(which))
            margin = base[which] + 0.5 * ((sums ** 2).sum(1) - _sums((vx ** 2).sum(1), owner, len(which)))
            miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[which]
            move = _sums(miss[owner][:, None] * trust[index] * (sums[owner] - vx), inverse, len(slots))
            move /= len(which)
            g[slots] += (move ** 2).sum(1)
            v[slots] -= (rate / np.sqrt(g[slots]))[:, None] * move
            step += 1
        draw(np.arange(n_slots))
        if each and each(v * trust):
            break
    return v * trust


def _margins(rows: _Rows, w0: float, w: np.ndarray) -> np.ndarray:
    return w0 + rows.each(lambda index, owner, n: _sums(w[index], owner, n))


def _pairs(rows: _Rows, v: np.ndarray) -> np.ndarray:
    def of(index: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        vx = v[index]
        return 0.5 * ((_sums(vx, owner, n) ** 2).sum(1) - _sums((vx ** 2).sum(1), owner, n))
    return rows.each(of)


def _loss(margins: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margins) - labels * margins))


def fit(texts: list[np.ndarray], labels: np.ndarray, prior: float, factors: int = FACTORS,
        settings: Settings = Settings()) -> Machine:
    """Weights, then factors; ``prior`` is the share of label 1 to reckon with.

    Without texts, or with one label only, the machine is the prior alone.
    """
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    machine = Machine(math.log(prior / (1 - prior)), np.zeros(SLOTS, np.float32),
                      np.zeros((SLOTS, factors), np.float32))
    labels = np.asarray(labels, np.float64)
    if len(texts) == 0 or labels.min() == labels.max():
        return machine
    active, rows = _Rows.of(texts).numbered()
    w0, w = fit_weights(rows, labels, len(active), settings.evidence)
    v = np.zeros((len(active), factors))
    if settings.pair_epochs:
        v = fit_factors(rows, labels, _margins(rows, w0, w), len(active), settings.hold,
                        settings.pair_epochs, factors)
    # the sample's label share is not that of all labelled rows
    share = labels.mean()
    machine.w0 = w0 + math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    machine.w[active], machine.v[active] = w, v
    return machine


def _trial(texts: _Rows, labels: np.ndarray, held: np.ndarray, evidence: float,
           hold: float | None) -> tuple[float, int]:
    """(loss on the rows ``held``, epochs of factors with that loss) of a fit on the others.

    Without ``hold`` only weights are fitted.
    """
    active, numbered = texts.numbered()
    rows, rest, y, judged_y = numbered.part(~held), numbered.part(held), labels[~held], labels[held]
    del numbered
    w0, w = fit_weights(rows, y, len(active), evidence)
    base = _margins(rest, w0, w)
    losses = [_loss(base, judged_y)]
    if hold is not None:
        def judge_epoch(v: np.ndarray) -> bool:
            losses.append(_loss(base + _pairs(rest, v), judged_y))
            return len(losses) - 1 - int(np.argmin(losses)) >= PATIENCE

        fit_factors(rows, y, _margins(rows, w0, w), len(active), hold, EPOCHS, each=judge_epoch)
    best = int(np.argmin(losses))
    return losses[best], best


def choose(spark, ids: list[int], texts: list[np.ndarray], labels: np.ndarray) -> Settings:
    """Settings by the loss on one in ``INNER_FOLDS`` of these rows, which the trials leave out.

    First the evidence, weights alone; then the pull on factors and the epochs they help: if
    none does, the strongest pull, which leaves factors only where texts insist. Every trial is a Spark task over the broadcast sample. Rows too few or too
    alike to tell get the defaults.
    """
    labels = np.asarray(labels, np.float64)
    held = np.array([zlib.crc32(f"inner {i}".encode()) % INNER_FOLDS == 0 for i in ids], bool)
    if min((labels[held] == k).sum() for k in (0, 1)) < 2 or min(
            (labels[~held] == k).sum() for k in (0, 1)) < 2:
        return Settings()
    shared = spark.sparkContext.broadcast((_Rows.of(texts), labels, held))

    def tried(trials: list[tuple]) -> list[tuple]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for evidence, hold in rows_of(batches, "evidence", "hold"):
                loss, epochs = _trial(*shared.value, evidence, hold)
                yield pa.RecordBatch.from_pydict({
                    "evidence": [evidence], "hold": pa.array([hold], pa.float64()),
                    "loss": [loss], "epochs": pa.array([epochs], pa.int32())})

        df = spark.createDataFrame(trials, "evidence double, hold double").repartition(len(trials))
        found = df.mapInArrow(run, "evidence double, hold double, loss double, epochs int")
        return sorted((r["loss"], r["evidence"], r["hold"] or 0.0, r["epochs"]) for r in found.collect())

    _, evidence, _, _ = tried([(e, None) for e in EVIDENCE])[0]
    _, _, hold, epochs = tried([(evidence, h) for h in HOLDS])[0]
    shared.destroy()
    return Settings(evidence, hold if epochs else max(HOLDS), max(epochs, PATIENCE))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
          per_class: int = PER_CLASS) -> Machine:
    """Fit on the labelled rows for which ``usable`` (over doc_id) holds.

    ``labels`` needs ``doc_id`` and ``toxic``. Rows with a null id or label are no labels;
    of several labels of an id the highest counts. The sample is joined to the texts as a
    broadcast of at most twice ``per_class`` ids; of several rows of an id the one of the
    least text hash counts.
    """
    session_of(docs)
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("toxic").cast("int").alias("toxic"))
              .filter("doc_id IS NOT NULL AND toxic IS NOT NULL"))
    if usable is not None:
        marked = marked.filter(usable)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    picks = [marked.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(per_class) for kind in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, least = _Terms(), {}  # at most the picked ids
        for doc_id, toxic, text_hash, text in rows_of(batches, "doc_id", "toxic", "text_hash",
                                                      "text"):
            if doc_id not in least or text_hash < least[doc_id][1]:
                least[doc_id] = toxic, text_hash, terms.of(text).astype("<i4").tobytes()
        held = list(least.items())
        for at in range(0, len(held), BATCH_ROWS):
            ids, rows = zip(*held[at:at + BATCH_ROWS])
            toxic, hashes, slots = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "toxic": pa.array(toxic, pa.int32()),
                "text_hash": pa.array(hashes, pa.int64()), "slots": pa.array(slots, pa.binary())})

    found = (id_and_text(docs).join(picked, "doc_id")
             .select("doc_id", "toxic", F.xxhash64("text").alias("text_hash"), "text")
             .mapInArrow(features, "doc_id long, toxic int, text_hash long, slots binary")
             .groupBy("doc_id").agg(F.min(F.struct("text_hash", "toxic", "slots")).alias("row"))
             .select("doc_id", "row.toxic", "row.slots").collect())
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), bytes(r["slots"])))
    texts = [np.frombuffer(r["slots"], "<i4").astype(np.int64) for r in found]
    marks = np.array([r["toxic"] for r in found])
    settings = choose(docs.sparkSession, [r["doc_id"] for r in found], texts, marks)
    return fit(texts, marks, counts.get(1, 0) / total if total else 0.5, settings=settings)


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """Score (0 to 1) of every row's whole text: (doc_id, score), a row for each row.

    Null and empty texts get the score of a text without terms. Null and repeated ids and
    repeated rows are scored like any other; an empty table gives none.
    """
    kept = (machine.w != 0) | (machine.v != 0).any(1)
    shared = session_of(docs).sparkContext.broadcast((machine, kept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, has_weight = shared.value
        terms = _Terms(has_weight)
        for batch in batches:
            scores = [model.score(terms.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": pa.array(scores, pa.float64())})

    return id_and_text(docs).mapInArrow(score, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text scores below ``threshold``."""
    machine = train(docs, labels)
    kept = (machine.w != 0) | (machine.v != 0).any(1)
    shared = session_of(docs).sparkContext.broadcast((machine, kept))
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, has_weight = shared.value
        terms = _Terms(has_weight)
        for batch in batches:
            yield batch.filter(pa.array([model.score(terms.of(t)) < threshold
                                         for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def judged(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Scores by a machine that never saw the labels of fold 0 (crc32 of the id, by ``folds``)."""
    in_training = crc32_mod(F.col("doc_id"), folds) != 0
    scores = score_documents(docs, train(docs, labels, in_training))
    return scores.select("doc_id", (crc32_mod(F.col("doc_id"), folds) == 0).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
