"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, ``MIN_MATCH`` words in a row, are compared
by running Karp-Rabin greedy string tiling: the longest runs of words that both have and that
no tile covers yet are marked as tiles, again and again, down to runs of ``MIN_MATCH`` words.
Tiles may stand in any order, so a passage whose sentences were moved about is still covered.
A document that covers at least ``COVERAGE`` of an item's words is contaminated.

The benchmark is a stated query set: it is read in blocks of bounded size, each of which is
broadcast and met by every document. Documents are never shuffled or gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.anchors import window_hashes
from daybook.llm.common import id_and_text, rows_of, session_of

MIN_MATCH = 5
COVERAGE = 0.5
# Words of the items that are broadcast at once.
BLOCK_WORDS = 2_000_000
_FIRST_SEARCH = 20
_WORD = re.compile(r"\w+")

RESULT = ("doc_id long, n_words long, item_id long, coverage double, tiled_words long, "
          "n_tiles long, n_items long, contaminated boolean")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []


def _free_runs(marked: bytearray, n: int) -> Iterator[tuple[int, int]]:
    """Unmarked stretches of at least ``n`` words: (start, end)."""
    at = 0
    while (at := marked.find(0, at)) >= 0:
        end = marked.find(1, at)
        end = len(marked) if end < 0 else end
        if end - at >= n:
            yield at, end
        at = end


def _rolling(words: list[int], start: int, end: int, n: int) -> Iterator[tuple[int, int]]:
    """(hash, place) of every ``n`` words within a stretch, by Karp-Rabin's rolling sum."""
    base, mod = 1_000_003, (1 << 61) - 1
    lead, value = pow(base, n - 1, mod), 0
    for i in range(start, end):
        if i >= start + n:
            value -= (words[i - n] + 1) * lead
        value = (value * base + words[i] + 1) % mod
        if i >= start + n - 1:
            yield value, i - n + 1


def _matches(a: list[int], b: list[int], marked_a: bytearray, marked_b: bytearray, n: int
             ) -> tuple[list[tuple[int, int, int]], int]:
    """Maximal common unmarked runs of ``n`` words or more: (length, place in a, in b).

    Returns none but the length of one that is over twice ``n``, if there is such a run:
    the search then starts again at that length.
    """
    table: dict[int, list[int]] = {}
    for s, e in _free_runs(marked_b, n):
        for value, at in _rolling(b, s, e, n):
            table.setdefault(value, []).append(at)
    found = []
    for s, e in _free_runs(marked_a, n):
        reached: dict[int, int] = {}  # by diagonal: runs already found go to here
        for value, i in _rolling(a, s, e, n):
            for j in table.get(value, ()):
                if i < reached.get(i - j, 0) or a[i:i + n] != b[j:j + n]:
                    continue
                k = n
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                       and not marked_a[i + k] and not marked_b[j + k]):
                    k += 1
                if k > 2 * n:
                    return [], k
                reached[i - j] = i + k - n + 1
                found.append((k, i, j))
    return found, 0


def tiles(a: list[int], b: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word lists: (length, place in a, place in b) of each tile.

    Longest runs are marked first; of equally long ones the first in ``a``, then in ``b``. A
    run that a tile has cut into counts again with what is left, if that is long enough.
    """
    marked_a, marked_b = bytearray(len(a)), bytearray(len(b))
    out, n = [], max(min_match, min(_FIRST_SEARCH, len(a), len(b)))
    while True:
        found, longer = _matches(a, b, marked_a, marked_b, n)
        if longer:
            n = longer
            continue
        while found:
            found.sort(key=lambda m: (-m[0], m[1], m[2]))
            cut = []
            for k, i, j in found:
                if not any(marked_a[i:i + k]) and not any(marked_b[j:j + k]):
                    marked_a[i:i + k] = marked_b[j:j + k] = b"\x01" * k
                    out.append((k, i, j))
                else:  # the stretches that are still free, on both sides
                    free, at = [x or y for x, y in zip(marked_a[i:i + k], marked_b[j:j + k])], 0
                    while at < k:
                        end = next((e for e in range(at, k) if free[e]), k)
                        if end - at >= n:
                            cut.append((end - at, i + at, j + at))
                        at = end + 1
            found = cut
        if n <= min_match:
            return out
        n = max(min_match, n // 2)


class Block:
    """Some benchmark items, ready to meet documents: word numbers, seeds, item words."""

    def __init__(self, items: list[tuple[int | None, list[str]]], min_match: int):
        self.min_match, self.ids = min_match, [i for i, _ in items]
        self.numbers: dict[str, int] = {}
        self.items = [[self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
                      for _, words in items]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: hashes, items
        lengths = [min(min_match, len(w)) for w in self.items]
        for n in sorted(set(lengths) - {0}):
            pairs = sorted({(int(h), k) for k, w in enumerate(self.items) if lengths[k] == n
                            for h in window_hashes(np.array(w, np.uint64), n)})
            self.seeds[n] = (np.array([h for h, _ in pairs], np.uint64),
                             np.array([k for _, k in pairs], np.int64))

    def partners(self, words: list[int]) -> list[int]:
        """The items that share a seed with a document; short items need all their words."""
        found: set[int] = set()
        numbers = np.array(words, np.uint64)
        for n, (hashes, items) in self.seeds.items():
            mine = np.unique(window_hashes(numbers, n))
            a, b = (np.searchsorted(hashes, mine, side=s) for s in ("left", "right"))
            for x, y in zip(a[b > a].tolist(), b[b > a].tolist()):
                found.update(items[x:y].tolist())
        return sorted(found)

    def judge(self, words: list[str]) -> list[tuple[float, int | None, int, int]]:
        """(coverage, item id, tiled words, tiles) of every item that shares a seed."""
        numbers = list(map(self.numbers.get, words, [0] * len(words)))
        out = []
        for k in self.partners(numbers):
            item = self.items[k]
            got = tiles(numbers, item, min(self.min_match, len(item)))
            tiled = sum(t[0] for t in got)
            if tiled:
                out.append((tiled / len(item), self.ids[k], tiled, len(got)))
        return out


def _blocks(benchmark: DataFrame, min_match: int, block_words: int) -> Iterator[Block]:
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        words = words_of(row[1])
        held.append((row[0], words))
        size += len(words)
        if size >= block_words:
            yield Block(held, min_match)
            held, size = [], 0
    if held:
        yield Block(held, min_match)


def judged(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
           coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: the item it covers best, and whether it is contaminated.

    ``item_id``, ``coverage``, ``tiled_words`` and ``n_tiles`` are of the item with the
    highest coverage (then the smallest id; a null id last), null, 0, 0 and 0 if no item
    shares ``min_match`` words in a row; ``n_items`` counts the items covered by at least
    ``coverage``. Items shorter than a seed must stand in the document whole; items without
    words cover nothing. Null texts have no words. Null and repeated ids and repeated rows are
    judged like any other; empty tables give no rows, or rows without an item.
    """
    spark = session_of(docs)
    blank = {"n_words": F.lit(None).cast("long"), "item_id": F.lit(None).cast("long"),
             "coverage": F.lit(0.0), "tiled_words": F.lit(0).cast("long"),
             "n_tiles": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long")}
    out = id_and_text(docs).withColumns(blank)
    names = out.columns
    schema = out.schema

    def meet(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [_better(row, block.value, coverage)
                        for row in rows_of([batch], *names)]
                columns = [batch.column(0), batch.column(1)] + [
                    pa.array(c, batch.schema.field(i + 2).type)
                    for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        return run

    empty = Block([], min_match)
    blocks = list(_shared(spark, _blocks(benchmark, min_match, block_words))) or [
        spark.sparkContext.broadcast(empty)]
    for block in blocks:  # one after the other in one stage: rows only pass through
        out = out.mapInArrow(meet(block), schema)
    return out.select("doc_id", "n_words", "item_id", "coverage", "tiled_words", "n_tiles",
                      "n_items", (F.col("n_items") > 0).alias("contaminated"))


def _shared(spark, blocks: Iterator[Block]):
    for block in blocks:
        yield spark.sparkContext.broadcast(block)


def _rank(coverage: float, item_id: int | None) -> tuple:
    return -coverage, item_id is None, item_id or 0


def _better(row: tuple, block: Block, least: float) -> tuple:
    """A row's result after one more block of items."""
    _, text, _, item_id, best, tiled, n_tiles, n_items = row
    words = words_of(text)
    for covered, item, words_in, count in block.judge(words):
        n_items += covered >= least
        if not tiled or _rank(covered, item) < _rank(best, item_id):
            best, item_id, tiled, n_tiles = covered, item, words_in, count
    return len(words), item_id, best, tiled, n_tiles, n_items


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                      coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of ``docs``, all columns as they are, that cover no item by ``coverage`` or more."""
    spark = session_of(docs)
    at, schema = docs.columns.index("text"), docs.schema

    def clean(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = [all(x[0] < coverage for x in block.value.judge(words_of(t)))
                        for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(kept, pa.bool_()))
        return run

    for block in _shared(spark, _blocks(benchmark, min_match, block_words)):
        docs = docs.mapInArrow(clean(block), schema)
    return docs
