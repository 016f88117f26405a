"""Vectorised text helpers for Arrow batches (they run inside tasks)."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, text_at: int, most: int = SLICE_BYTES):
    """Row slices of a batch with about ``most`` bytes of text each (a longer text alone)."""
    size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // most)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts.cast(pa.large_string()), "")


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, each occurrence's place among them, and the bounds of each text."""
    words = pc.ascii_split_whitespace(texts)
    coded = pc.dictionary_encode(words.flatten())
    vocabulary, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
    if "" in vocabulary:  # the split leaves one at the ends of some texts, and in empty ones
        real = codes != vocabulary.index("")
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    return vocabulary, codes, bounds.astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=None)
def lower_letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 32 (a space) for anything else."""
    out = np.full(sys.maxunicode + 1, 32, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out
