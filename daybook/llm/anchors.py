"""Anchors: where equal windows of a fixed length must meet.

The anchor of a window of ``length`` symbols is the run of ``gram`` symbols in it with the
smallest hash (the first of several). Equal windows have equal anchors at equal places, so
windows need to be compared only within an anchor, and a window whose anchor occurs once in
the corpus has no equal. Neighbouring windows often share an anchor; such a *span* of starts
is sent to the anchor's owner as one piece of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.chunks import (ANSWER_SCHEMA, asked, by_owner, compress, decompress,
                                pack_ascending, table_of, unpack_ascending)

# An anchor that more chunks than this hold is crowded: its windows go to owners by their
# whole text, one start at a time.
CROWD = 2_000
ONCE, REPEATED, CROWDED = 0, 1, 2

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def window_hashes(symbols: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` symbols (polynomial, built by doubling, mixed)."""
    if len(symbols) < n:
        return np.empty(0, np.uint64)
    part = (symbols.astype(np.uint64) + np.uint64(1)) * _MIX
    part ^= part >> np.uint64(29)
    size, power, done, out = 1, _BASE, 0, None
    with np.errstate(over="ignore"):
        while n:
            if n & 1:  # append this part to what is done
                if out is None:
                    out = part
                else:
                    m = min(len(out), len(part) - done)
                    out = out[:m] * power + part[done:done + m]
                done += size
            n >>= 1
            if n:
                part = part[:-size] * power + part[size:]
                size, power = size * 2, power * power
        out = out * _MIX
        out ^= out >> np.uint64(32)
        return out * _BASE


@dataclass
class Spans:
    """Spans of a chunk: first start, number of starts, place and hash of the anchor."""
    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray


def spans_of(symbols: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> Spans:
    """Spans of documents of the given sizes whose symbols stand one after the other."""
    none = Spans(*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64))
    n = len(symbols) - length + 1
    if n <= 0:
        return none
    grams = window_hashes(symbols, gram)
    key = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    key = np.minimum(key[:n], key[width - size:width - size + n])
    anchor = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(n + 1, bool)  # starts whose window stays in its document
    inside[n] = False
    for end in np.cumsum(sizes)[:-1].tolist():
        inside[max(0, end - length + 1):min(end, n)] = False
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = anchor[1:] != anchor[:-1]
    new |= inside[:n] & ~np.concatenate([[False], inside[:n - 1]])
    first = np.flatnonzero(new & inside[:n])
    stop = np.flatnonzero(~inside | np.append(new, True))
    count = stop[np.searchsorted(stop, first, side="right")] - first
    place = anchor[first]
    # anchors have the smallest hashes about them: mixed anew, they spread over all owners
    with np.errstate(over="ignore"):
        spread = grams[place] * _MIX
        spread ^= spread >> np.uint64(32)
    return Spans(first, count, place, spread * _BASE)


def repeated_anchors(chunks: DataFrame, symbols_of, length: int, gram: int, owners: int,
                     crowd: int = CROWD) -> DataFrame:
    """Answers that tell each chunk which of its anchors occur once, more often, or crowd.

    A chunk's codes stand in the ascending order of its distinct anchor hashes, by owner.
    """
    def ask(rows: pa.Table) -> Iterator[tuple[int, bytes]]:
        symbols, sizes, _ = symbols_of(rows)
        hashes, counts = np.unique(spans_of(symbols, sizes, length, gram).hash,
                                   return_counts=True)
        for owner, part in by_owner(hashes, owners):
            twice = np.packbits(counts[part] > 1).tobytes()
            yield owner, len(twice).to_bytes(4, "little") + twice + pack_ascending(hashes[part])

    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        asks, twice = [], []
        for body in table.column("body").to_pylist():
            n = int.from_bytes(body[:4], "little")
            asks.append(unpack_ascending(body[4 + n:]))
            twice.append(np.unpackbits(np.frombuffer(body[4:4 + n], np.uint8),
                                       count=len(asks[-1])).astype(np.int64))
        values, inverse, n_chunks = np.unique(np.concatenate(asks), return_inverse=True,
                                              return_counts=True)
        seen = n_chunks + np.bincount(inverse, np.concatenate(twice), len(values)).astype(int)
        codes = np.where(n_chunks > crowd, CROWDED, np.where(seen > 1, REPEATED, ONCE))
        codes = codes.astype(np.uint8)[inverse]
        out, at = [], 0
        for number, hashes in zip(table.column("chunk_id").to_pylist(), asks):
            mine = codes[at:at + len(hashes)]
            at += len(hashes)
            if mine.any():
                out.append((number, owner, compress(mine.tobytes())))
        return table_of(ANSWER_SCHEMA, out)

    return asked(chunks, ask).groupBy("owner").applyInArrow(answer, ANSWER_SCHEMA)


def codes_of(spans: Spans, answers: dict[int, bytes], owners: int) -> np.ndarray:
    """The code of each span's anchor from a chunk's answers."""
    hashes, inverse = np.unique(spans.hash, return_inverse=True)
    codes = np.zeros(len(hashes), np.uint8)
    for owner, part in by_owner(hashes, owners):
        if owner in answers:
            codes[part] = np.frombuffer(decompress(answers[owner]), np.uint8)
    return codes[inverse]


@dataclass
class Asked:
    """What a chunk sends for its repeated spans: equal pieces of text once, by owner.

    Piece i has its text, the number of window starts at its front, and the anchor's place.
    ``piece`` gives the piece of each sent span, ``first`` the span's first start.
    """
    owner: list[int]
    text: list[bytes]
    starts: list[int]
    place: list[int]
    piece: np.ndarray
    first: np.ndarray


def pieces_of(spans: Spans, codes: np.ndarray, content, symbols: np.ndarray, length: int,
              owners: int) -> Asked:
    """Spans with repeated anchors as pieces; ``content(a, b)`` is the text of symbols a to b.

    Pieces of crowded anchors have one start and go to the owner of their whole window.
    """
    crowded = codes == CROWDED
    some = codes == REPEATED
    n = int(spans.count[crowded].sum())
    if n:  # one piece for each start
        inner = np.arange(n) - np.repeat(np.cumsum(spans.count[crowded]) - spans.count[crowded],
                                         spans.count[crowded])
        single = np.repeat(spans.first[crowded], spans.count[crowded]) + inner
        whole = window_hashes(symbols, length)[single]
        place = np.repeat(spans.anchor[crowded], spans.count[crowded]) - single
        first = np.concatenate([spans.first[some], single])
        count = np.concatenate([spans.count[some], np.ones(n, np.int64)])
        place = np.concatenate([spans.anchor[some] - spans.first[some], place])
        keys = np.concatenate([spans.hash[some], whole])
    else:
        first, count = spans.first[some], spans.count[some]
        place, keys = spans.anchor[some] - first, spans.hash[some]
    owner = (keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
    order = np.argsort(owner, kind="stable")
    out = Asked([], [], [], [], np.empty(len(order), np.int64), first[order])
    known: dict[tuple, int] = {}
    for k, (o, a, c, p) in enumerate(zip(owner[order].tolist(), first[order].tolist(),
                                         count[order].tolist(), place[order].tolist())):
        text = content(a, a + c + length - 1)
        piece = known.setdefault((o, p, c, text), len(known))
        if piece == len(out.text):
            out.owner.append(o)
            out.text.append(text)
            out.starts.append(c)
            out.place.append(p)
        out.piece[k] = piece
    return out


def pack_pieces(asks: Asked, extra: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One packed row for each owner: texts, starts, places and a number for each piece."""
    owners = np.asarray(asks.owner, np.int64)
    edges = np.flatnonzero(np.diff(owners)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(owners)]):
        if b > a:
            texts = asks.text[a:b]
            head = np.array([b - a], "<i4").tobytes()
            numbers = np.array([[len(t) for t in texts], asks.starts[a:b], asks.place[a:b]], "<i4")
            yield int(owners[a]), compress(head + numbers.tobytes() + extra[a:b].astype("<i8")
                                           .tobytes() + b"".join(texts), level=3)


def unpack_pieces(body: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Texts, starts, places and numbers of a packed row."""
    body = decompress(body)
    n = int.from_bytes(body[:4], "little")
    sizes, starts, place = np.frombuffer(body, "<i4", 3 * n, 4).reshape(3, n)
    extra = np.frombuffer(body, "<i8", n, 4 + 12 * n)
    ends = np.cumsum(sizes) + 4 + 20 * n
    texts = [body[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
    return texts, starts, place, extra


def merge_pieces(table: pa.Table) -> tuple[list[tuple], list[tuple[int, np.ndarray, np.ndarray]]]:
    """All chunks' pieces at an owner: the distinct ones, and each chunk's list of them.

    A distinct piece is (text, starts, place); a chunk's entry has its number, the pieces it
    sent in their order, and their numbers.
    """
    known: dict[tuple, int] = {}
    chunks = []
    for number, body in zip(table.column("chunk_id").to_pylist(),
                            table.column("body").to_pylist()):
        texts, starts, place, extra = unpack_pieces(body)
        mine = np.fromiter((known.setdefault(key, len(known)) for key in
                            zip(texts, starts.tolist(), place.tolist())), np.int64, len(texts))
        chunks.append((number, mine, extra))
    return list(known), chunks


def pack_marks(chunks: list[tuple[int, np.ndarray, np.ndarray]], owner: int, marks) -> pa.Table:
    """Answers of a bit for each start of each piece, in the order the chunk asked.

    ``marks(pieces, numbers)`` gives the bits of a chunk's pieces; chunks without a set bit
    get no answer.
    """
    out = []
    for number, pieces, extra in chunks:
        bits = marks(pieces, extra)
        if bits.any():
            out.append((number, owner, compress(np.packbits(bits).tobytes())))
    return table_of(ANSWER_SCHEMA, out)


def marked_starts(asks: Asked, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each start a chunk sent: its place in the chunk, and its bit; by span, in order."""
    starts = np.asarray(asks.starts, np.int64)
    owners = np.asarray(asks.owner, np.int64)
    bits = np.zeros(int(starts.sum()), bool)
    base = np.cumsum(starts) - starts
    for owner, body in answers.items():
        mine = np.flatnonzero(owners == owner)
        if len(mine):
            a, n = int(base[mine[0]]), int(starts[mine].sum())
            bits[a:a + n] = np.unpackbits(np.frombuffer(decompress(body), np.uint8), count=n)
    counts = starts[asks.piece]
    inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(asks.first, counts) + inner, bits[np.repeat(base[asks.piece], counts) + inner]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0
