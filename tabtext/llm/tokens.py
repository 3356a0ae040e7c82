"""Token ids of texts: a byte-level BPE vocabulary (rank file) applied in Arrow batches.

The vocabulary file's path is a parameter; the driver reads it once and ships its bytes (under
``MAX_VOCAB_BYTES``, checked) so that workers need no local copy. Null and empty texts have no tokens.
"""

from __future__ import annotations

import base64
import hashlib
import os

import numpy as np
from pyspark.sql import SparkSession

from tabtext.llm.common import ship_by_value, worker_cache

ship_by_value(__name__)

VOCAB = os.environ.get("TABTEXT_VOCAB", "/opt/tokenizers/byte_bpe_50k.tiktoken")
MAX_VOCAB_BYTES = 32 << 20
# fixed value: the pre-tokenisation pattern that belongs to the vocabulary file
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 1 << 20  # characters given to the tokenizer at once


class Vocabulary:
    """A rank file as shipped to the tasks; ``eod`` is the first id after its ranks."""

    def __init__(self, raw: bytes):
        if len(raw) > MAX_VOCAB_BYTES:
            raise ValueError(f"vocabulary of {len(raw)} bytes; at most {MAX_VOCAB_BYTES} are shipped")
        self.raw = raw
        self.key = hashlib.sha256(raw).hexdigest()
        self.eod = sum(1 for x in raw.splitlines() if x.strip())
        self.dtype = "<u2" if self.eod < 1 << 16 else "<u4"

    def encoder(self):
        cache = worker_cache()
        if self.key not in cache:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in self.raw.splitlines() if x.strip())}
            cache[self.key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return cache[self.key]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text. A very long text goes through in pieces cut in front of a space
        between two letters, where the pattern always starts a new word."""
        if not text:
            return np.zeros(0, self.dtype)
        enc = self.encoder()
        if len(text) <= PIECE:
            return np.array(enc.encode_ordinary(text), self.dtype)
        import regex

        out, at, cut = [], 0, regex.compile(r"(?<=\p{L})(?= \p{L})")
        while at < len(text):
            m = cut.search(text, at + PIECE)
            end = m.end() if m else len(text)
            out.append(np.array(enc.encode_ordinary(text[at:end]), self.dtype))
            at = end
        return np.concatenate(out)


def read(path: str | None = None) -> Vocabulary:
    """The vocabulary at ``path``, a file of the driver's machine."""
    with open(path or VOCAB, "rb") as f:
        return Vocabulary(f.read())


def load(spark: SparkSession, path: str | None = None):
    """Broadcast of the vocabulary's bytes."""
    return spark.sparkContext.broadcast(read(path).raw)
