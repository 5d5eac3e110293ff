"""Token ids of whole texts by a public tokenizer file, fast enough for whole corpora.

The tokenizers library spends most of its time on text it has seen before. Its pattern
never matches across a space or line feed, so the ids of a text are those of its chunks
between them, one after the other; :class:`Encoder` keeps the ids of chunks it has met.
"""

from __future__ import annotations

import functools
import os

import numpy as np

DEFAULT_TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# Chunks kept for each Python worker, about 200 bytes each.
CACHE_CHUNKS = 1_000_000


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Chunks(dict):
    """Ids (as bytes) by chunk, filled by the library on the first use of a chunk."""

    def __init__(self, tokenizer, dtype: np.dtype):
        super().__init__()
        self.tokenizer, self.model, self.dtype = tokenizer, tokenizer.model, dtype

    def __missing__(self, chunk: str) -> bytes:
        core = chunk.rstrip(".,")
        if len(core) < len(chunk) and core.isascii() and core.isalpha():
            # Letters and the marks after them are separate matches of the pattern.
            ids = self[core.lower()] + self[chunk[len(core):]]
        elif chunk.isascii() and chunk.isalpha():
            low = chunk.lower()
            if low != chunk:
                ids = self[low]
            else:  # one match of the pattern, equal to its normal form: merges only
                ids = np.array([t.id for t in self.model.tokenize(low)], self.dtype).tobytes()
        else:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids,
                           self.dtype).tobytes()
        self[chunk] = ids
        return ids


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Holds for tokenizer files of the family of ``word_bpe_49k.json`` (white space dropped,
    lower case, letter runs apart from other marks); others need a plain encode.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.vocab_size = tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocab_size <= 1 << 16 else "<u4")
        self.chunks = _Chunks(tokenizer, self.dtype)

    def encode(self, text: str) -> np.ndarray:
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        pieces = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, pieces)), self.dtype)

    def encode_document(self, text: str | None, end_id: int = END_ID) -> np.ndarray:
        """Ids of a text (null: empty), then the end id."""
        ids = self.encode(text) if text else np.empty(0, self.dtype)
        return np.append(ids, self.dtype.type(end_id))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept between its tasks."""
    return Encoder(path)
