"""Operator 8, document fingerprints by locally consistent parsing.

A text is a row of symbols.  Runs of one symbol become one; then deterministic coin
tossing gives each symbol the lowest bit in which it differs from its left neighbour, and
that bit's value: neighbours stay different while labels shrink to six within
four rounds.  A phrase starts at each local maximum of these labels, and its name is a
hash of its symbols.  Names are the symbols of the next level.  A phrase is decided by a
few symbols around it, so equal substrings have equal phrases inside, wherever they are.
The fingerprint is the least hashed names of the higher levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.arrow_words import PIECE_BYTES, mixed
from caderneta.llm.tables import load

LEVELS = 5
FIRST_LEVEL = 2  # phrases below are a few characters long and say little
LEAST = 64
ROUNDS = 4
_PLACES = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)

# Rows of one range are streamed through one task in order.
RANGE_ROWS = 1024
MOST_RANGES = 10_000
NO_ID = np.iinfo(np.int64).max


def _toss(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round: twice the lowest differing bit plus its value; ``first`` has no neighbour."""
    before = np.empty_like(labels)
    before[1:] = labels[:-1]
    before[first] = ~labels[first]
    differing = labels ^ before
    bit = np.bitwise_count((differing & (~differing + labels.dtype.type(1))) - labels.dtype.type(1))
    return (2 * bit + ((labels >> bit.astype(labels.dtype)) & labels.dtype.type(1))).astype(np.uint8)


def _phrases(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of the phrases, and where each text starts among them.

    ``starts`` are the first symbols of the texts, none of which is empty.
    """
    change = np.empty(len(names), bool)
    change[0] = True
    np.not_equal(names[1:], names[:-1], out=change[1:])
    change[starts] = True
    at = np.flatnonzero(change)
    length = np.diff(np.r_[at, len(names)])
    symbols = names[at]
    first = np.searchsorted(at, starts)
    labels = symbols
    for _ in range(ROUNDS):
        labels = _toss(labels, first)
    cut = np.zeros(len(labels), bool)
    if len(labels) > 2:
        cut[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    ends = np.r_[first[1:], len(labels)] - 1
    cut[ends] = False  # a last symbol has no right neighbour
    cut[first] = True
    begin = np.flatnonzero(cut)
    place = np.arange(len(symbols)) - np.repeat(begin, np.diff(np.r_[begin, len(symbols)]))
    named = symbols.astype(np.uint64)
    long = length > 1
    named[long] = mixed(named[long] ^ (length[long].astype(np.uint64) << np.uint64(32)))
    sums = np.add.reduceat(named * _PLACES[place & 63], begin)
    return mixed(sums), np.searchsorted(begin, first)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """For each text the sorted ``LEAST`` smallest 32-bit hashes of its phrase names.

    A text with fewer names has them all, an empty one none.
    """
    out = [np.empty(0, np.uint32)] * len(texts)
    full = [i for i, text in enumerate(texts) if text]
    if not full:
        return out
    lengths = np.fromiter((len(texts[i]) for i in full), np.int64, len(full))
    names = np.frombuffer("".join([texts[i] for i in full]).encode("utf-32-le"), np.uint32)
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    keys = []
    for level in range(1, LEVELS + 1):
        names, starts = _phrases(names, starts)
        if level >= FIRST_LEVEL:
            owner = np.repeat(np.arange(len(full)), np.diff(np.r_[starts, len(names)]))
            keys.append((owner.astype(np.uint64) << np.uint64(32)) | (names >> np.uint64(32)))
    every = np.sort(np.concatenate(keys))
    every = every[np.r_[True, every[1:] != every[:-1]]]
    begin = np.searchsorted(every, np.arange(len(full), dtype=np.uint64) << np.uint64(32))
    for i, a, b in zip(full, begin, np.r_[begin[1:], len(every)]):
        out[i] = every[a : min(b, a + LEAST)].astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of common names: exact while both sets fit in a fingerprint."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]
    distinct = np.r_[True, ~twice]
    least = min(max(len(a), len(b)), LEAST)
    rank = np.cumsum(distinct)
    union = min(int(rank[-1]), least) if max(len(a), len(b)) == LEAST else int(rank[-1])
    shared = int(np.count_nonzero(twice & (rank[1:] <= union)))
    return shared / union


def shown(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            marks = [shown(f) for part in _parts(texts) for f in fingerprints(part)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(marks)],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string"
    )


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lists of about ``PIECE_BYTES`` characters."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > PIECE_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


class _Ranges:
    """Ranges of the order (doc_id, hash of the text), null ids last.

    Each starts at a row's id; an id that fills several ranges is divided by the hash.
    """

    def __init__(self, ids: list[int]):
        values, repeats = np.unique(np.array(ids, np.int64), return_counts=True)
        self.ids = np.repeat(values, repeats)
        turn = np.concatenate([np.arange(n) / n for n in repeats])
        self.hashes = (turn * 2.0**64 - 2.0**63).clip(-(2.0**63), 2.0**63 - 1025).astype(np.int64)

    def of(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.ids, ids, "left")
        high = np.searchsorted(self.ids, ids, "right")
        found = high - 1
        for i in np.flatnonzero(high - low > 1):
            found[i] = low[i] + np.searchsorted(self.hashes[low[i] : high[i]], hashes[i], "right") - 1
        return np.maximum(found, 0).astype(np.int32)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "hash"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, ahead, doc_id, id, hash, text) in order within ranges, ready to stream.

    Each range also has, marked ``ahead``, the first row of the one after it (the last: of
    the first), so every row finds its next one in its own task.
    """
    rows = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(int(NO_ID))).alias("id"),
        F.xxhash64("text").alias("hash"), F.coalesce("text", F.lit("")).alias("text"),
    )
    number = rows.count()
    wanted = min(MOST_RANGES, -(-number // RANGE_ROWS)) or 1
    parts = [k / wanted for k in range(wanted)]
    ids = rows.agg(F.percentile_approx("id", parts, 10 * MOST_RANGES).alias("ids")).first()["ids"]
    ranges = _Ranges(ids or [0])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = ranges.of(*_keys(batch))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), batch.column("id"), batch.column("hash")], names=["range", "id", "hash"]
            )

    first = (
        rows.select("id", "hash").mapInArrow(placed, "range int, id long, hash long")
        .groupBy("range").agg(F.min(F.struct("id", "hash")).alias("first")).orderBy("range").collect()
    )
    # At most one row per range.
    heads = {tuple(r["first"]): first[k - 1]["range"] for k, r in enumerate(first)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "ahead", "doc_id", "id", "hash", "text"]
        head_ids = np.array(sorted({key[0] for key in heads}), np.int64)
        for batch in batches:
            ids, hashes = _keys(batch)
            at = pa.array(ranges.of(ids, hashes))
            yield pa.RecordBatch.from_arrays(
                [at, pa.array(np.zeros(len(ids), np.int32)), *batch.columns], names=names
            )
            near = np.flatnonzero(np.isin(ids, head_ids))
            also = [i for i in near if (ids[i], hashes[i]) in heads]
            if also:
                to = [heads[(ids[i], hashes[i])] for i in also]
                copies = batch.take(pa.array(also))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array(np.ones(len(to), np.int32)), *copies.columns],
                    names=names,
                )

    schema = "range int, ahead int, doc_id long, id long, hash long, text string"
    spread = rows.mapInArrow(dealt, schema).repartition("range")
    return spread.sortWithinPartitions("range", "ahead", "id", "hash")


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """Fingerprints of (doc_id, text, next text) rows and of their edited texts."""
    own = fingerprints([text for _, text, _ in rows])
    following = fingerprints([after for _, _, after in rows])
    edited = []
    for _, text, after in rows:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    changed = fingerprints(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in rows], pa.int64()),
            pa.array([len(text) for _, text, _ in rows], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array([shown(f) for f in own]), pa.array([shown(f) for f in changed]),
            pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, following)], pa.float64()),
        ],
        names=[part.split()[0] for part in COMPARED.split(", ")],
    )


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has the last half of the characters replaced by the first as many of
    the next document in order of doc_id; rows of equal id follow by hash of the text.
    A document alone is its own next.  Two empty fingerprints are alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, waiting, size = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "ahead", "doc_id", "text"))
            for at, ahead, doc_id, text in zip(*columns):
                if before is not None and before[0] == at:
                    waiting.append((before[1], before[2], text))
                    size += len(before[2])
                    if size >= PIECE_BYTES // 2:
                        yield _compared(waiting)
                        waiting, size = [], 0
                before = None if ahead else (at, doc_id, text)
        if waiting:
            yield _compared(waiting)

    return with_next(docs).mapInArrow(run, COMPARED)


def op8_locally_consistent_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and that of their edited text."""
    return compare_with_edited(load(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op8_locally_consistent_parsing": op8_locally_consistent_parsing}
ORACLES: dict[str, str] = {}
