"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates of all orders up to
``ORDER`` and a uniform one. The weights depend on how often the context was seen: contexts
fall into buckets by the logarithm of their count, each with weights of its own. They are
learned by expectation-maximisation on held-out counts: every training token in turn is
deleted from the counts and predicted from the rest, so all training data serve both ends.

N-grams are counted by their owners (see ``chunks``): a chunk of documents sends its distinct
n-grams with its own training counts and gets the corpus counts back, so neither a frequent
n-gram nor a frequent word brings its occurrences together. For the mixture weights, training
tokens are summed in cells of nearly equal probabilities; the cells are of a fixed number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.anchors import window_hashes
from daybook.llm.chunks import (answered, asked, by_owner, chunk_rows, compress, decompress,
                                owners_for, pack_ascending, release, table_of, texts_in,
                                unpack_ascending, word_hashes, write_chunks)
from daybook.llm.common import id_and_text, materialize

ORDER = 2
FOLDS = 10
CHUNK_BYTES = 8 << 20
OWNER_BYTES = 16 << 20
# Context buckets: count 0, then one for each power of two.
BUCKETS = 24
# Cells for the probability of each order: none, then steps of a quarter of a decade.
LEVELS = 40
EM_ROUNDS = 60
_START, _END = np.uint64(0x51), np.uint64(0xE4D)
_COUNTED = "chunk_id long, owner int, body binary, types long, tokens long"


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(np.float64))[1], BUCKETS - 1)


def _level(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        steps = np.floor(-4 * np.log10(p))
    return np.where(p > 0, 1 + np.clip(np.nan_to_num(steps, posinf=0), 0, LEVELS - 2), 0).astype(int)


@dataclass
class _Tokens:
    """Symbols of a chunk: each document's starts, words and end, one after the other."""
    symbols: np.ndarray
    place: np.ndarray  # of every counted symbol: the tokens and each document's last start
    token: np.ndarray  # which of these are tokens
    train: np.ndarray  # which belong to training documents
    sizes: np.ndarray  # tokens of each document
    held_out: np.ndarray


def held_out(doc_id: int | None, folds: int = FOLDS) -> bool:
    """Whether a document's labels and counts stay unseen; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def _tokens(rows: pa.Table, order: int, folds: int) -> _Tokens:
    parts, sizes = [], []
    # so many starts that no n-gram reaches into the document before
    starts, end = np.full(order, _START), np.array([_END])
    for text in texts_in(rows, rows.column_names.index("text")):
        mine = word_hashes(text.lower().split())
        parts += [starts, mine, end]
        sizes.append(len(mine) + 1)
    sizes = np.array(sizes, np.int64)
    out = np.array([held_out(i, folds) for i in rows.column("doc_id").to_pylist()], bool)
    first = np.cumsum(sizes + order) - sizes  # of each document's tokens
    marked = min(order - 1, 1)
    counts = sizes + marked
    inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return _Tokens(np.concatenate(parts) if parts else np.empty(0, np.uint64),
                   np.repeat(first - marked, counts) + inner, inner >= marked,
                   np.repeat(~out, counts), sizes, out)


def _grams(tokens: _Tokens, n: int) -> np.ndarray:
    """Hash of the ``n`` symbols that end at each counted place."""
    return window_hashes(tokens.symbols, n)[tokens.place - (n - 1)]


def _pack_counts(counts: np.ndarray) -> bytes:
    planes = counts.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return compress(np.ascontiguousarray(planes).tobytes())


def _unpack_counts(body: bytes) -> np.ndarray:
    planes = np.frombuffer(decompress(body), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8")


def _count(chunks: DataFrame, order: int, folds: int, owners: int) -> DataFrame:
    """Corpus counts of every chunk's n-grams; owner (n - 1) * owners + k counts order n."""
    def ask(rows: pa.Table) -> Iterator[tuple[int, bytes]]:
        tokens = _tokens(rows, order, folds)
        for n in range(1, order + 1):
            hashes, inverse = np.unique(_grams(tokens, n), return_inverse=True)
            counts = np.bincount(inverse, tokens.train, len(hashes)).astype(np.int64)
            for owner, part in by_owner(hashes, owners):
                body = _pack_counts(counts[part])
                yield ((n - 1) * owners + owner,
                       len(body).to_bytes(4, "little") + body + pack_ascending(hashes[part]))

    start = window_hashes(np.array([_START]), 1)[0]

    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        hashes, counts = [], []
        for body in table.column("body").to_pylist():
            n = int.from_bytes(body[:4], "little")
            counts.append(_unpack_counts(body[4:4 + n]))
            hashes.append(unpack_ascending(body[4 + n:]))
        values, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate(counts), len(values)).astype(np.int64)
        words = totals[values != start] if owner < owners else totals[:0]
        rows, at = [], 0
        for number, mine in zip(table.column("chunk_id").to_pylist(), hashes):
            rows.append((number, owner, _pack_counts(totals[inverse[at:at + len(mine)]]), 0, 0))
            at += len(mine)
        rows.append((-1, owner, b"", int((words > 0).sum()), int(words.sum())))
        return table_of(_COUNTED, rows)

    return asked(chunks, ask).groupBy("owner").applyInArrow(answer, _COUNTED)


def _counts_of(tokens: _Tokens, answers: dict[int, bytes], n: int, owners: int) -> np.ndarray:
    """Corpus count of the n-gram at each counted place."""
    hashes, inverse = np.unique(_grams(tokens, n), return_inverse=True)
    counts = np.zeros(len(hashes), np.int64)
    for owner, part in by_owner(hashes, owners):
        counts[part] = _unpack_counts(answers[(n - 1) * owners + owner])
    return counts[inverse]


def _estimates(tokens: _Tokens, answers: dict, order: int, owners: int, total: int,
               deleted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: estimates of orders 1 up, count of its longest context, its own count.

    ``deleted`` takes the token itself out of all counts first.
    """
    less = int(deleted)
    here = np.flatnonzero(tokens.token)
    counts = [_counts_of(tokens, answers, n, owners) for n in range(1, order + 1)]
    estimates = []
    for n in range(1, order + 1):
        seen = counts[n - 1][here] - less
        # the symbol before a token is always a counted place of its document
        context = np.full(len(here), total) if n == 1 else counts[n - 2][here - 1]
        context = context - less
        estimates.append(np.where(context > 0, seen / np.maximum(context, 1), 0.0))
    return np.array(estimates), context, counts[0][here]


def learn_weights(cells: np.ndarray, counts: np.ndarray, order: int, types: int,
                  rounds: int = EM_ROUNDS) -> np.ndarray:
    """Mixture weights (bucket, order 0 up) by expectation-maximisation on cell counts.

    A bucket without any deleted token keeps the weights of the nearest bucket below that has
    some (equal ones if none has). The uniform part never falls under a millionth.
    """
    levels, rest = [], cells.copy()
    for _ in range(order):
        levels.append(rest % LEVELS)
        rest //= LEVELS
    centre = np.concatenate([[0.0], 10.0 ** (-(np.arange(LEVELS - 1) + 0.5) / 4)])
    p = np.stack([np.full(len(cells), 1.0 / (types + 1)), *(centre[x] for x in levels)], axis=1)
    weights = np.full((BUCKETS, order + 1), 1.0 / (order + 1))
    last = weights[0]
    for b in range(BUCKETS):
        mine = rest == b
        if mine.any():
            w, x, n = last.copy() * 0 + 1.0 / (order + 1), p[mine], counts[mine][:, None]
            for _ in range(rounds):
                parts = w * x
                w = (n * parts / parts.sum(1, keepdims=True)).sum(0) / n.sum()
            w = np.maximum(w, 1e-6)
            last = w / w.sum()
        weights[b] = last
    return weights


def score_documents(docs: DataFrame, order: int = ORDER, folds: int = FOLDS,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: log10 probability of its whole text, learned from the training documents.

    Training documents are those whose crc32 (of the id as text) modulo ``folds`` is not 0.
    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is
    the end token alone; a null id is held out; repeated ids and rows are documents like any
    other; an empty table gives none. Without training tokens every score is that of the
    uniform estimate.
    """
    spark = docs.sparkSession
    chunks = write_chunks(id_and_text(docs), "text", chunk_bytes)
    owners = owners_for(chunks, OWNER_BYTES)
    found = materialize(_count(chunks, order, folds, owners), "ngram-counts")
    release(spark)
    sums = found.filter("chunk_id < 0").agg(F.sum("types"), F.sum("tokens")).head()
    types, total = sums[0] or 0, sums[1] or 0
    both = answered(chunks, found.filter("chunk_id >= 0").select("chunk_id", "owner", "body"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, (answers,) in chunk_rows(batches, 1):
            tokens = _tokens(rows, order, folds)
            p, context, _ = _estimates(tokens, answers, order, owners, total, deleted=True)
            train = tokens.train[tokens.token]
            cell = _bucket(np.maximum(context, 0))
            for n in range(order, 0, -1):
                cell = cell * LEVELS + _level(p[n - 1])
            values, counts = np.unique(cell[train], return_counts=True)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(values, pa.int64()),
                                              "n": pa.array(counts, pa.int64())})

    # at most BUCKETS * LEVELS ** order rows, whatever the input
    table = both.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    summed = sorted((r["cell"], r["n"]) for r in table.collect())
    weights = learn_weights(np.array([c for c, _ in summed], np.int64),
                            np.array([n for _, n in summed], np.float64), order, types)
    release(spark)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, (answers,) in chunk_rows(batches, 1):
            tokens = _tokens(rows, order, folds)
            p, context, seen = _estimates(tokens, answers, order, owners, total, deleted=False)
            w = weights[_bucket(context)]
            mixed = w[:, 0] / (types + 1) + sum(w[:, n + 1] * p[n] for n in range(order))
            # an estimate without a context or a total has no say: the uniform one takes over
            empty = np.array([context <= 0 if n else np.full(len(context), total == 0)
                              for n in range(order)])
            mixed += sum(w[:, n + 1] * empty[n] for n in range(order)) / (types + 1)
            base = np.log10((seen + 0.1) / (total + 0.1 * (types + 1)))
            first = np.cumsum(tokens.sizes) - tokens.sizes
            yield from pa.Table.from_arrays([
                rows.column("doc_id"), pa.array(tokens.held_out), pa.array(tokens.sizes),
                pa.array(np.add.reduceat((seen > 0).astype(np.int64), first)),
                pa.array(np.full(len(first), total)), pa.array(np.add.reduceat(base, first)),
                pa.array(np.add.reduceat(np.log10(mixed), first))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                 "score"]).to_batches()

    return both.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                           "train_tokens long, base_score double, score double")
