"""Removal of repeated word sequences by prefix-partitioned suffix trees.

Suffixes of the corpus are split by variable-length prefixes into groups that fit in memory,
and each group's subtree is built by itself. The prefix of a suffix runs from its first word
to the end of its window's anchor (see ``anchors``): suffixes with equal windows share it, and
those whose anchor occurs once in the corpus, which have no equal, need no tree. Prefixes that
too many parts of the corpus share grow to the whole window.

A subtree is grown from the root down, a word a level for all its suffixes together. Nodes
with a single suffix are leaves; the nodes left at the depth of a window are the deep internal
nodes, and the suffixes below one of them are the places of a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm import anchors
from daybook.llm.chunks import (ANSWER_SCHEMA, answered, asked, chunk_rows, owners_for, release,
                                texts_in, word_hashes, write_chunks)
from daybook.llm.common import id_and_text, materialize

WINDOW_WORDS = 35
GRAM = 8
CHUNK_BYTES = 2 << 20
OWNER_BYTES = 4 << 20
# Suffixes of the prefix groups whose subtrees are built together.
GROUP_SUFFIXES = 250_000


def _word_symbols(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word hashes, words a text, and all words (ASCII white space ends a word)."""
    words, sizes = [], []
    for text in texts_in(rows, rows.column_names.index("text")):
        mine = text.split()
        words += mine
        sizes.append(len(mine))
    return word_hashes(words), np.array(sizes, np.int64), words


def prefix_groups(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int
                  ) -> Iterator[np.ndarray]:
    """Suffixes, by index, of whole prefix groups, about ``limit`` at a time.

    The prefix of suffix i is ``words[starts[i]:ends[i]]``; suffixes of one prefix stay
    together. Prefixes are told apart by hash; two that collide just share a tree.
    """
    base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xF1DE83E19937733D)
    with np.errstate(over="ignore"):
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(words), base))])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(
            (words.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)])
        back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(words), inverse))])
        prefix = (sums[ends] - sums[starts]) * back[starts]
    order = np.argsort(prefix, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], prefix[order][1:] != prefix[order][:-1]]))
    at = 0
    while at < len(order):
        later = np.searchsorted(heads, at + limit)
        end = int(heads[later]) if later < len(heads) else len(order)
        yield order[at:end]
        at = end


def deep_nodes(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The internal node at ``depth`` words that each suffix lies below; -1 for leaves above.

    Grows the tree level by level: a node's children are its suffixes' next words.
    """
    node = np.zeros(len(starts), np.int64)
    live = np.arange(len(starts))
    width = int(words.max()) + 1 if len(words) else 1
    for level in range(depth):
        key = node * width + words[starts[live] + level]
        _, node, sizes = np.unique(key, return_inverse=True, return_counts=True)
        inner = sizes[node] > 1
        live, node = live[inner], node[inner]
        node = np.unique(node, return_inverse=True)[1] if not inner.all() else node
    out = np.full(len(starts), -1)
    out[live] = node
    return out


def _with_repeats(docs: DataFrame, window: int, chunk_bytes: int, crowd: int):
    """Chunks with their answers, and the function that finds a chunk's repeated words."""
    gram = min(GRAM, window)
    spark = docs.sparkSession
    chunks = write_chunks(docs, "text", chunk_bytes)
    owners = owners_for(chunks, OWNER_BYTES)
    codes = materialize(anchors.repeated_anchors(chunks, _word_symbols, window, gram, owners,
                                                 crowd), "anchor-codes")
    release(spark)

    def pieces(rows: pa.Table, answers: dict) -> tuple:
        symbols, sizes, words = _word_symbols(rows)
        spans = anchors.spans_of(symbols, sizes, window, gram)
        asks = anchors.pieces_of(spans, anchors.codes_of(spans, answers, owners),
                                 lambda a, b: b" ".join(words[a:b]), symbols, window, owners)
        return asks, sizes, words

    def ask(rows: pa.Table, answers: dict) -> Iterator[tuple[int, bytes]]:
        asks, _, _ = pieces(rows, answers)
        yield from anchors.pack_pieces(asks, np.bincount(asks.piece, minlength=len(asks.text)))

    def answer(table: pa.Table) -> pa.Table:
        """Mark the starts whose window stands at two places or more."""
        distinct, from_chunks = anchors.merge_pieces(table)
        texts, counts, places = zip(*distinct)
        counts, places = np.array(counts, np.int64), np.array(places, np.int64)
        numbers: dict[bytes, int] = {}
        split = [t.split(b" ") for t in texts]
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in split for w in t),
                            np.int64, sum(map(len, split)))
        at = np.cumsum([0, *map(len, split)])[:-1]
        base = np.cumsum(counts) - counts
        inner = np.arange(int(counts.sum())) - np.repeat(base, counts)
        times = np.zeros(len(texts), np.int64)
        for _, mine, n in from_chunks:
            np.add.at(times, mine, n)
        starts, times = np.repeat(at, counts) + inner, np.repeat(times, counts)
        ends = np.repeat(at + places, counts) + gram
        repeated = times > 1
        for part in prefix_groups(words, starts, ends, GROUP_SUFFIXES):
            node = deep_nodes(words, starts[part], window)
            repeated[part[node >= 0]] = True

        def marks(mine: np.ndarray, _) -> np.ndarray:
            n = counts[mine]
            return repeated[np.repeat(base[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

        return anchors.pack_marks(from_chunks, table.column("owner")[0].as_py(), marks)

    marks = asked(answered(chunks, codes), ask, 1)
    marks = materialize(marks.groupBy("owner").applyInArrow(answer, ANSWER_SCHEMA), "tree-marks")
    release(spark)

    def removed(rows: pa.Table, codes: dict, marks: dict) -> tuple[np.ndarray, np.ndarray, list]:
        asks, sizes, words = pieces(rows, codes)
        starts, bits = anchors.marked_starts(asks, marks)
        return anchors.covered(starts[bits], window, len(words)), sizes, words

    return answered(chunks, codes, marks), removed


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS, chunk_bytes: int = CHUNK_BYTES,
                    crowd: int = anchors.CROWD) -> DataFrame:
    """Per row: id, number of words, number that go, and the kept words joined by one space.

    A word goes if a window of ``window`` words covers it whose sequence also starts anywhere
    else, in the same document too; windows are judged on the input. ``docs`` needs ``doc_id``
    and ``text``; other columns are ignored. A null text has no words; null and repeated ids
    and repeated rows are documents like any other; an empty table gives no rows.
    """
    chunks, removed = _with_repeats(id_and_text(docs), window, chunk_bytes, crowd)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, (codes, marks) in chunk_rows(batches, 2):
            gone, sizes, words = removed(rows, codes, marks)
            lost, texts, at = [], [], 0
            for n in sizes.tolist():
                mine = gone[at:at + n]
                lost.append(int(mine.sum()))
                kept = words[at:at + n] if not lost[-1] else [
                    words[at + i] for i in np.flatnonzero(~mine).tolist()]
                texts.append(b" ".join(kept).decode())
                at += n
            yield from pa.Table.from_arrays(
                [rows.column("doc_id"), pa.array(sizes), pa.array(lost, pa.int64()),
                 pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"]).to_batches()

    return chunks.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
