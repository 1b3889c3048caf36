"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from caderneta.llm.arrow_words import Words, mixed

SHINGLE = 5
# Odd factors, one for each place in a shingle.
_FACTORS = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): text ``i`` has the sorted set ``values[starts[i]:starts[i + 1]]``.

    A-Z are lower-cased.  A text of fewer words than ``size`` has its whole sequence as its
    one shingle, a text without words the empty set.
    """
    words = Words(texts, lower=True)
    hashed = words.hashes()[words.codes] if len(words.names) else np.empty(0, np.uint64)
    n = len(hashed)
    rolled = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        rolled += hashed[k : k + len(rolled)] * _FACTORS[k]
    rolled = mixed(rolled)
    sets = []
    for begin, end in zip(words.starts[:-1], words.starts[1:]):
        count = end - begin
        if count >= size:
            values = np.sort(rolled[begin : end - size + 1])
            values = values[np.r_[True, values[1:] != values[:-1]]]
        elif count:
            part = hashed[begin:end] * _FACTORS[:count]
            values = mixed(part.sum(dtype=np.uint64, keepdims=True) + np.uint64(count))
        else:
            values = rolled[:0]
        sets.append(values)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else rolled[:0]
    return flat, np.r_[0, np.cumsum(lengths)]
