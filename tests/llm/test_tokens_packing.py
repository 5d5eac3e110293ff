"""Token files (op4) and packing (op1): exact round trips against plain encodes."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import packing, token_files
from daybook.llm.tokens import Encoder, encoder, tokenizer_path
from daybook.session import local_path, scratch_dir
from llm_cases import empty, messy, texts

PATH = tokenizer_path()


def test_files_are_read_by_many_tasks_and_a_hot_id_is_split(spark):
    """An id on a third of the rows, half of them one text: no file holds most of it."""
    rows = [(7 if i % 3 == 0 else i, "the same words" if i % 6 == 0 else f"words of {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scratch_dir(spark, "hot")
        manifest = token_files.write_token_files(docs, out, PATH, seq_len=64).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert len(manifest) >= 6 and max(m["n_docs"] for m in manifest) < 0.3 * len(rows)
    read = token_files.read_documents(spark, out)  # under the session's own settings
    by_task = read.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(by_task) >= len(manifest) - 2 and sum(r["count"] for r in by_task) == len(rows)


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]


def test_chunked_encoding_equals_whole_texts(plain):
    rng = random.Random(3)
    alphabet = "aZ9'.,|éÉßΣσςİñ́​ \x1c\x85 \n\t　中🙂<|endoftext|>don't we'll"
    cases = [t for _, t in texts() if t] + ["".join(rng.choice(alphabet) for _ in range(60))
                                            for _ in range(400)]
    enc = Encoder(PATH)
    for t in cases:
        assert enc.encode_document(t).tolist() == plain(t), repr(t)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, plain):
    out = scratch_dir(spark, "tok")
    manifest = token_files.write_token_files(messy(spark), out, PATH, seq_len=64).collect()
    def text_hash(t):
        h = xxhash.xxh64_intdigest(t or "", 42)
        return h - (1 << 64) if h >> 63 else h

    rows = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1])))
    want, at = [], 0
    for doc_id, text in rows:
        ids = plain(text)
        want.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    got = [tuple(r) for r in token_files.read_documents(spark, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    everything = [i for _, t in rows for i in plain(t)]
    seen = []
    for f in sorted(manifest, key=lambda r: r.part):
        reader, n = token_files.open_sequences(f"{local_path(out)}/{f.name}.arrow")
        assert n == f.n_sequences
        before = pa.total_allocated_bytes()
        for i in random.Random(0).sample(range(n), n):
            ids, mask = token_files.sequence(reader, i)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
        assert pa.total_allocated_bytes() - before < 4096  # views on the map, no copies
        for i in range(n):
            ids, mask = token_files.sequence(reader, i)
            seen += ids[np.array(mask)].tolist()
    assert seen == everything
    none = scratch_dir(spark, "tok")
    assert token_files.write_token_files(empty(spark), none, PATH).count() == 0
    assert token_files.read_documents(spark, none).count() == 0


def check_packing(rows, want, max_len):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length, r.tier))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    padded = total = 0
    for parts in windows.values():
        at = 0
        for offset, length, tier in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= tier <= max_len
        padded += 0 if at & (at - 1) == 0 else max_len - at
        total += at
    for key, docs in want.items():
        found = sorted(pieces.pop(key))
        assert sum(n for _, n, _ in found) == key[1] * len(docs)
        if len(docs) == 1:
            at = 0
            for start, n, c in found:
                assert start == at and c == crc(docs[0][start:start + n])
                at += n
    assert not pieces
    return padded / total


def test_packing_covers_every_id_once(spark, plain):
    want = defaultdict(list)
    for doc_id, text in texts():
        ids = plain(text)
        want[doc_id, len(ids)].append(ids)
    rows = packing.pack(messy(spark), PATH, max_len=256, min_tier=32).collect()
    assert check_packing(rows, want, 256) < 0.02
    assert packing.pack(empty(spark), PATH).count() == 0


def test_packing_in_many_blocks_and_tails(spark, plain, monkeypatch):
    want = defaultdict(list)
    for doc_id, text in texts():
        ids = plain(text)
        want[doc_id, len(ids)].append(ids)
    rows = packing.pack(messy(spark, partitions=12), PATH, max_len=512, min_tier=64).collect()
    check_packing(rows, want, 512)
    tails = {r.sequence_id for r in rows if r.step_group >= 1 << 60}
    assert len(tails) <= 3  # tails of twelve tasks share windows


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_full(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 100, 256, 257, 511, 512, 700, 1024, 3000, 4096, 9000])
               for _ in range(rng.randint(0, 300))]
    windows, tail = packing.plan_windows(lengths)
    for size, parts in windows:
        assert sum(n for _, _, n in parts) == size and size in packing.tiers()
    assert sum(n for _, _, n in tail) < packing.MIN_TIER
    covered = defaultdict(list)
    for doc, start, n in [p for _, parts in windows for p in parts] + tail:
        covered[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, k in sorted(covered[doc]):
            assert start == at
            at += k
        assert at == n
    steps = packing.deal_steps(windows, 50_000)
    loads = defaultdict(int)
    for (size, _), step in zip(windows, steps):
        loads[step] += size
    if loads:
        assert max(loads.values()) - min(loads.values()) <= 4096


def test_encoder_is_shared_by_a_worker():
    assert encoder(PATH) is encoder(PATH)
