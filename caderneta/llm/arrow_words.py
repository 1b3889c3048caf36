"""Words of whole texts as numpy arrays, for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in pieces of about this many bytes; a longer text is one piece.
PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that working memory does not follow the batch's size."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // size
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    for begin, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(begin, end - begin)


class Words:
    """The words (``[^\\x20\\x09-\\x0D]+``) of a column of texts, nulls read as empty.

    ``names`` are the different words, ``codes`` the index of each word in turn, and text
    ``i`` has ``codes[starts[i]:starts[i + 1]]``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(split.flatten())
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.names = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        empty = pc.index(self.names, "").as_py()
        if empty >= 0:  # an empty text splits into one empty word
            real = self.codes != empty
            owner = np.repeat(np.arange(len(counts)), counts)
            counts = np.bincount(owner[real], minlength=len(counts))
            self.codes = self.codes[real]
        self.counts = counts
        self.starts = np.r_[0, np.cumsum(counts)]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each different word."""
        return hashed(self.names)


def hashed(names: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text: random numbers for its bytes at their places."""
    n = len(names)
    if not n:
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(names.buffers()[1], np.int32)
    offsets = offsets[names.offset : names.offset + n + 1].astype(np.int64)
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)
    drawn = _DRAWN[((place & 63) << 8) | data]
    if size.max(initial=0) > 64:  # later stretches of long words count differently
        far = np.flatnonzero(place > 63)
        drawn[far] *= mixed((place[far] >> 6).astype(np.uint64)) | np.uint64(1)
    sums = np.zeros(n, np.uint64)
    full = np.flatnonzero(size)
    sums[full] = np.add.reduceat(drawn, (offsets[:-1] - offsets[0])[full])
    return mixed(sums + size.astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finishing step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_DRAWN = mixed(np.arange(1, (64 << 8) + 1, dtype=np.uint64))
