"""Token ids in Arrow files: fixed-size lists of ids and masks, open to random access.

Layout of a folder: ``manifest/`` (Parquet, one row for each data file) and, per file,
``<name>.arrow`` (Arrow IPC file; each row is a sequence of ``seq_len`` ids and a mask that
is true for real ids) and ``<name>.docs.arrow`` (document id, first id's place in the file,
number of ids). All batches but a file's last hold ``BATCH_SEQUENCES`` sequences, so sequence
i is row ``i % BATCH_SEQUENCES`` of batch ``i // BATCH_SEQUENCES``: a memory map finds it
without reading or copying anything else. Nothing is compressed.

Files follow ascending document ids (null ids first, equal ids by a hash of their text). Ids are stored in
the smallest unsigned type that holds the vocabulary.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text, rows_of, session_of
from daybook.llm.tokens import END_ID, encoder

SEQ_LEN = 2048
BATCH_SEQUENCES = 64
MOST_READERS = 20_000

_MANIFEST = "part int, name string, n_docs long, n_tokens long, n_sequences long"
_DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()),
                         ("n_tokens", pa.int64())])


def _filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:")
                                    else f"file://{root}")


class _SequenceWriter:
    """Cuts a stream of ids into sequences and writes full batches as they fill."""

    def __init__(self, fs, path: str, seq_len: int, dtype: np.dtype):
        kind = pa.from_numpy_dtype(dtype)
        self.seq_len, self.dtype = seq_len, dtype
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)),
                                 ("mask", pa.list_(pa.bool_(), seq_len))])
        self.sink = fs.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        self.n_tokens += len(ids)
        full = self.seq_len * BATCH_SEQUENCES
        if self.held >= full:
            ids = np.concatenate(self.pending)
            whole = len(ids) // full * full
            for at in range(0, whole, full):
                self._write(ids[at:at + full])
            self.pending, self.held = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        n = -(-len(ids) // self.seq_len)
        mask = np.arange(n * self.seq_len) < len(ids)
        padded = np.zeros(n * self.seq_len, self.dtype)
        padded[:len(ids)] = ids
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len)
                   for x in (padded, mask)]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += n

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.pending))
        self.writer.close()
        self.sink.close()


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, seq_len: int = SEQ_LEN,
                      end_id: int = END_ID) -> DataFrame:
    """Tokenise whole texts into Arrow files below ``out_dir``; return the manifest.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    gives the end id alone, repeated ids and rows give an entry each, an empty table gives an
    empty manifest. Each task writes a file under a name of its own and the manifest, written
    by Spark's commit, names the files that count: a lost or doubled attempt leaves at most a
    file that nothing refers to. A task holds one batch of sequences and its document list.
    """
    session_of(docs)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        fs, root = _filesystem(out_dir)
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        out, entries = None, []
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = _SequenceWriter(fs, f"{root}/{name}.arrow", seq_len, enc.dtype)
            ids = enc.encode_document(text, end_id)
            entries.append((doc_id, out.n_tokens, len(ids)))
            out.add(ids)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{root}/{name}.docs.arrow") as sink, \
                pa.ipc.new_file(sink, _DOC_SCHEMA) as writer:
            for at in range(0, len(entries), 65536):
                columns = zip(*entries[at:at + 65536])
                writer.write_batch(pa.record_batch(
                    [pa.array(c, pa.int64()) for c in columns], schema=_DOC_SCHEMA))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "name": [name], "n_docs": [len(entries)],
            "n_tokens": [out.n_tokens], "n_sequences": [out.n_sequences]})

    # the hash and the row number split an id, or a text, that very many rows share
    keyed = id_and_text(docs).withColumns({"text_hash": F.xxhash64("text"),
                                           "row": F.monotonically_increasing_id()})
    order = ["doc_id", "text_hash", "row"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    path = f"{out_dir.rstrip('/')}/manifest"
    ordered.mapInArrow(write, _MANIFEST).write.parquet(path)
    return docs.sparkSession.read.schema(_MANIFEST).parquet(path)


def open_sequences(path: str) -> tuple[pa.ipc.RecordBatchFileReader, int]:
    """A file's reader, memory-mapped where it lies on a local disk, and its sequence count.

    All batches but the last are full, so the count needs only the last one.
    """
    fs, inner = _filesystem(path)
    local = isinstance(fs, pafs.LocalFileSystem)
    reader = pa.ipc.open_file(pa.memory_map(inner) if local else fs.open_input_file(inner))
    n = reader.num_record_batches
    return reader, (n - 1) * BATCH_SEQUENCES + reader.get_batch(n - 1).num_rows if n else 0


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.Array]:
    """Sequence ``i``: its ids, a view on the file's own memory, and its mask."""
    batch, row = reader.get_batch(i // BATCH_SEQUENCES), i % BATCH_SEQUENCES
    ids, mask = batch.column(0), batch.column(1)
    return (ids.values.slice((ids.offset + row) * ids.type.list_size, ids.type.list_size)
            .to_numpy(zero_copy_only=True), mask[row].values)


class _IdReader:
    """Ranges of a file's ids in ascending order, one batch in memory at a time."""

    def __init__(self, path: str):
        self.reader, _ = open_sequences(path)
        self.at = self.first = 0
        self.ids = np.empty(0, "<u2")

    def ranges(self, start: int, length: int) -> Iterator[np.ndarray]:
        while length:
            while start >= self.first + len(self.ids):
                self.first += len(self.ids)
                batch = self.reader.get_batch(self.at)
                values = batch.column(0).values.to_numpy(zero_copy_only=True)
                self.ids = values[:batch.column(1).values.true_count]
                self.at += 1
            piece = self.ids[start - self.first:start - self.first + length]
            yield piece
            start, length = start + len(piece), length - len(piece)


def read_documents(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per document, from the files alone: place among all ids, count and crc32 of its ids.

    A file's first place is the sum of the id counts of the files before it, a window over
    the manifest (a row for each file). The files are dealt to as many tasks as there are
    files, up to ``MOST_READERS``: a number of partitions that is asked for stays, while AQE
    would merge a shuffle of so few and small rows into one task.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{out_dir.rstrip('/')}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
                            .cast("long").alias("first"))
    files = files.repartitionByRange(max(1, min(manifest.count(), MOST_READERS)), "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(out_dir)
        for name, first in rows_of(batches, "name", "first"):
            ids = _IdReader(f"{out_dir.rstrip('/')}/{name}.arrow")
            with fs.open_input_file(f"{root}/{name}.docs.arrow") as source:
                listing = pa.ipc.open_file(source)
                for b in range(listing.num_record_batches):
                    batch, crcs = listing.get_batch(b), []
                    for start, length in zip(batch.column(1).to_pylist(),
                                             batch.column(2).to_pylist()):
                        crc = 0
                        for piece in ids.ranges(start, length):
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    starts = np.asarray(batch.column(1)) + first
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column(0), "start": pa.array(starts, pa.int64()),
                        "n_tokens": batch.column(2), "ids_crc32": pa.array(crcs, pa.int64())})

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
