"""Hierarchical multi-length packing of tokenised documents.

Documents are routed to context-size tiers (powers of two up to ``max_len``), each tier is
packed into windows of its own length, gaps of the longer windows are filled from shorter
tiers, and the windows are dealt to step groups of equal token counts.

Every input partition is packed by itself in blocks of bounded size, so the corpus is never
shuffled and no group of documents has to meet in one task. What a partition cannot bring
to a full window (fewer ids than the smallest tier) is written down as a tail; tails, at most
one per partition, are packed together at the end.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text, materialize, rows_of, session_of
from daybook.llm.tokens import END_ID, encoder

MAX_LEN = 4096
MIN_TIER = 256
# Ids held by a task before it packs them.
BLOCK_TOKENS = 4_000_000
# Windows of a block are dealt to steps of about this many ids.
STEP_TOKENS = 262_144
# Sequence numbers of a partition; the partition's number stands above them.
_SEQ_BITS = 36
# Tails packed by one task.
TAILS_PER_GROUP = 65_536

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, tier int, step_group long")
_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def tiers(max_len: int = MAX_LEN, min_tier: int = MIN_TIER) -> list[int]:
    """Window lengths: the powers of two from ``min_tier`` to ``max_len``."""
    out = [min_tier]
    while out[-1] < max_len:
        out.append(out[-1] * 2)
    if out[-1] != max_len:
        raise ValueError("max_len must be min_tier times a power of two")
    return out


def plan_windows(lengths: list[int], max_len: int = MAX_LEN, min_tier: int = MIN_TIER
                 ) -> tuple[list[tuple[int, list]], list]:
    """Pack documents of the given lengths; return (tier, pieces) windows and the tail.

    A piece is (document index, start, length). A document of ``max_len`` ids or more gives
    whole windows of the longest tier first. What is left of it, or a shorter document, goes
    to the longest tier that it fills at least by half. Each tier takes its documents in
    descending length, one to a window, and fills the window's gap from the longest rest of
    the shorter tiers that fits; where none fits, a shorter rest is cut to the gap, so every
    window is full. Rests that no longer fill a window of their tier move to the next lower
    tier. Fewer than ``min_tier`` ids are left at the end: the tail.
    """
    sizes = tiers(max_len, min_tier)
    windows: list[tuple[int, list]] = []
    shelves: list[list] = [[] for _ in sizes]  # by tier: (length, document, start)

    def shelf(length: int) -> int:
        """The shortest tier that holds ``length`` ids."""
        return next(k for k, size in enumerate(sizes) if length <= size)

    for doc, length in enumerate(lengths):
        start = 0
        while length - start >= max_len:
            windows.append((max_len, [(doc, start, max_len)]))
            start += max_len
        if length > start:
            shelves[shelf(length - start)].append((length - start, doc, start))
    for s in shelves:
        s.sort()
    for k in range(len(sizes) - 1, -1, -1):
        size = sizes[k]
        left = sum(x[0] for s in shelves[:k + 1] for x in s)
        while left >= size and shelves[k]:
            length, doc, start = shelves[k].pop()
            pieces, gap = [(doc, start, length)], size - length
            while gap:
                # the longest rest of the tier that could hold the gap, and below it
                at = shelf(gap)
                while at >= 0 and not (shelves[at] and shelves[at][0][0] <= gap):
                    at -= 1
                if at >= 0:
                    i = _last_fitting(shelves[at], gap)
                    length, doc, start = shelves[at].pop(i)
                    pieces.append((doc, start, length))
                else:  # nothing is short enough: cut the shortest there is
                    at = next(j for j in range(k + 1) if shelves[j])
                    length, doc, start = shelves[at].pop(0)
                    pieces.append((doc, start, gap))
                    rest = (length - gap, doc, start + gap)
                    _insert(shelves[shelf(rest[0])], rest)
                    length = gap
                gap -= length
            windows.append((size, pieces))
            left -= size
        # too few ids for this tier: what stands here is cut for the tiers below
        if k:
            for length, doc, start in shelves[k]:
                below = sizes[k - 1]
                if length > below:
                    windows.append((below, [(doc, start, below)]))
                    length, start = length - below, start + below
                _insert(shelves[shelf(length)], (length, doc, start))
            shelves[k] = []
    return windows, [(doc, start, length) for s in shelves for length, doc, start in s]


def _last_fitting(items: list, gap: int) -> int:
    import bisect
    return bisect.bisect_right(items, (gap, float("inf"), 0)) - 1


def _insert(items: list, item: tuple) -> None:
    import bisect
    bisect.insort(items, item)


def deal_steps(windows: list[tuple[int, list]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step for each window: the longest first, each to the step with the fewest ids."""
    n = max(1, -(-sum(size for size, _ in windows) // step_tokens))
    loads = [(0, step) for step in range(n)]
    steps = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i][0]):
        load, step = heapq.heappop(loads)
        steps[i] = step
        heapq.heappush(loads, (load + windows[i][0], step))
    return steps


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, min_tier: int = MIN_TIER,
         end_id: int = END_ID) -> DataFrame:
    """Pack all documents; one row for each piece (see ``PIECES``).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    is the end id alone. Rows with a null or repeated id are documents of their own. An
    empty table gives no rows. Every id lies in exactly one piece. A window is as long as
    its tier; ``tier`` is ``max_len`` for the windows of tails, which alone need padding.
    """
    session_of(docs)
    tail_limit = min_tier

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        held, n_held, next_seq, next_step = [], 0, part << _SEQ_BITS, part << _SEQ_BITS

        def block(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n_held, next_seq, next_step
            windows, tail = plan_windows([len(ids) for _, ids, _, _ in held], max_len, min_tier)
            steps = deal_steps(windows)
            rows = []

            def piece(window, offset, size, step, item, start, length):
                doc_id, ids, first, total = held[item]
                crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
                rows.append((doc_id, first + start, length, crc, total, window, offset, size,
                             step))

            for (size, pieces), step in zip(windows, steps):
                offset = 0
                for item, start, length in pieces:
                    piece(next_seq, offset, size, next_step + step, item, start, length)
                    offset += length
                next_seq += 1
            next_step += max(steps, default=-1) + 1
            if final:
                for item, start, length in tail:
                    piece(None, None, tail_limit, None, item, start, length)
                held = []
            else:
                held = [(held[item][0], held[item][1][start:start + length],
                         held[item][2] + start, held[item][3]) for item, start, length in tail]
            n_held = sum(len(x[1]) for x in held)
            for at in range(0, len(rows), 65536):
                yield _batch(rows[at:at + 65536])

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            ids = enc.encode_document(text, end_id)
            held.append((doc_id, ids, 0, len(ids)))
            n_held += len(ids)
            if n_held >= BLOCK_TOKENS:
                yield from block(final=False)
        if held:
            yield from block(final=True)

    pieces = materialize(id_and_text(docs).mapInArrow(pack_partition, PIECES), "packing")
    tails = pieces.filter("sequence_id IS NULL")
    n_groups = 1 + tails.count() // TAILS_PER_GROUP

    def pack_tails(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (-r["length"], r["doc_id"] or 0, r["start"]))
        group = int(table.column("tail_group")[0].as_py())
        seq = ((1 << 25) + group) << _SEQ_BITS  # above every partition's numbers
        room: list[tuple[int, int]] = []  # (-free, window): tails go to the emptiest window
        out, n = [], 0
        for r in rows:
            if room and -room[0][0] >= r["length"]:
                free, window = heapq.heappop(room)
            else:
                free, window, n = -max_len, n, n + 1
            out.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"],
                        seq + window, max_len + free, max_len, seq))
            heapq.heappush(room, (free + r["length"], window))
        return pa.Table.from_batches([_batch(out)])

    packed = (tails.withColumn("tail_group", F.pmod(F.xxhash64("doc_id", "start"),
                                                    F.lit(n_groups)))
              .groupBy("tail_group").applyInArrow(pack_tails, PIECES))
    return pieces.filter("sequence_id IS NOT NULL").unionByName(packed)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)
