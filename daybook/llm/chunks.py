"""Blocks of documents that a task handles as one, and the questions they ask of the corpus.

Operators that compare every passage with the whole corpus work in three steps. Documents are
written once as *chunks* of bounded size. Each chunk *asks*: it sends the distinct hashes it
wants to know about to the hashes' owners, as one packed row for each owner. Owners *answer*
with a packed row for each chunk, in the order asked, and the chunk's next step reads its
answers beside its text. Hashes are merged within a chunk before they are sent, so a hash
that the whole corpus shares reaches its owner once for each chunk.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import session_of, shuffle_partitions
from daybook.session import scratch_dir

_CHUNK_BITS = 30
CHUNK_SCHEMA = "chunk_id long, n_bytes long, rows binary"
ASK_SCHEMA = "owner int, chunk_id long, body binary"
ANSWER_SCHEMA = "chunk_id long, owner int, body binary"


def write_chunks(docs: DataFrame, text: str, chunk_bytes: int) -> DataFrame:
    """All rows of ``docs`` in chunks of about ``chunk_bytes`` text bytes, written and reread.

    A chunk is one row: its number and its documents as a compressed Arrow table with the
    columns of ``docs`` by position. A text longer than the size is a chunk by itself.
    """
    spark = session_of(docs)
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "chunk_id": pa.array([part << _CHUNK_BITS | n], pa.int64()),
                "n_bytes": pa.array([size], pa.int64()), "rows": [_pack_table(held)]})

        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(
                pa.compute.binary_length(batch.column(at)), 0), dtype=np.int64)
            first = 0
            for i, s in enumerate(sizes.tolist()):
                size += s
                if size >= chunk_bytes:
                    held.append(batch.slice(first, i + 1 - first))
                    yield chunk()
                    first, n, held, size = i + 1, n + 1, [], 0
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield chunk()

    path = scratch_dir(spark, "chunks")
    chunks = docs.mapInArrow(cut, CHUNK_SCHEMA)
    chunks.write.option("compression", "none").parquet(path)
    return spark.read.schema(CHUNK_SCHEMA).parquet(path)


def _pack_table(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batches[0].schema, options=options) as out:
        out.write_table(pa.Table.from_batches(batches).combine_chunks())
    return sink.getvalue().to_pybytes()


def rows_in(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def texts_in(rows: pa.Table, at: int) -> list[bytes]:
    """The texts of a chunk as UTF-8 bytes; a null text is empty."""
    return [t or b"" for t in rows.column(at).cast(pa.binary()).to_pylist()]


# Words whose hashes a worker keeps.
_CACHE_WORDS = 1_000_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 1)
        return value


_WORDS = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def owners_for(chunks: DataFrame, bytes_each: int) -> int:
    """As many owners as give each the hashes of about ``bytes_each`` text bytes."""
    total = chunks.agg(F.sum("n_bytes")).head()[0] or 0
    return max(shuffle_partitions(chunks.sparkSession), -(-total // bytes_each))


def owner_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The owner of each 64-bit hash, ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_owner(hashes: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """The owners of ascending hashes, each with its slice."""
    owners = owner_of(hashes, n)
    edges = np.flatnonzero(np.diff(owners)) + 1
    for a, b in zip([0, *edges], [*edges, len(owners)]):
        if b > a:
            yield int(owners[a]), slice(int(a), int(b))


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending 64-bit hashes as compressed differences, bytes of equal weight together."""
    steps = np.diff(values, prepend=np.uint64(0))
    return compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_ascending(body: bytes) -> np.ndarray:
    planes = np.frombuffer(decompress(body), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def compress(body: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(body)


def decompress(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def table_of(schema: str, rows: list[tuple]) -> pa.Table:
    """Rows of (long or int, long or int, bytes) under the names of ``schema``."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[k] for k in kinds]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def answered(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Chunks with their answers of each kind: arrays ``a0``, ``a1``.. of (owner, body)."""
    out = chunks
    for i, answer in enumerate(answers):
        mine = answer.groupBy("chunk_id").agg(
            F.collect_list(F.struct("owner", "body")).alias(f"a{i}"))
        out = out.join(mine, "chunk_id", "left")
    return out


def asked(chunks: DataFrame, ask: Callable[..., Iterator[tuple[int, bytes]]], kinds: int = 0
          ) -> DataFrame:
    """Rows (owner, chunk_id, body) of ``ask(rows, *answers)`` for each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, answers in chunk_rows(batches, kinds):
            out = [(owner, number, body) for owner, body in ask(rows, *answers)]
            if out:
                yield from table_of(ASK_SCHEMA, out).to_batches()

    return chunks.mapInArrow(run, ASK_SCHEMA)


def chunk_rows(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[tuple]:
    """(chunk number, its rows, answers of each kind as {owner: body}), chunk by chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            answers = [{x["owner"]: x["body"] for x in (batch.column(f"a{k}")[i].as_py() or [])}
                       for k in range(kinds)]
            yield (batch.column("chunk_id")[i].as_py(),
                   rows_in(batch.column("rows")[i].as_py()), answers)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files that no DataFrame refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
