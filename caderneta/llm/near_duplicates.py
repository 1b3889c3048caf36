"""Operator 9, near-duplicates: MinHash signatures joined by a multi-index Hamming join.

A signature has 40 symbols of b bits in 8 chunks of 5.  Two signatures that differ in at
most 23 symbols have, by pigeonhole, a chunk with at most 2 differing symbols, so they
agree on 3 of its places: each signature is filed under all 10 choices of 3 places in
each chunk, and every pair within the distance meets in a file.  At a similarity of 0.75
a pair differs in 10 symbols on average; it exceeds 23 with odds of about 2 in a million.

Only links between different groups matter.  A file is first joined as a star around one
member; members already in one group need no further comparison.  Stars with other
centres follow until few pairs are left, and those are compared one by one, so no link
between groups is missed.  Every link is confirmed on full shingle sets.

Near misses are dropped before they become rows: a set's parity over 2,048 cells differs
from another's in at most as many cells as the sets have different shingles, which
bounds their similarity from above.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.arrow_words import mixed, pieces
from caderneta.llm.components import components
from caderneta.llm.shingles import shingle_sets
from caderneta.llm.tables import load, packed, row_key, stored

CHUNKS = 8
CHUNK = 5
ERRORS = 2
SYMBOLS = CHUNKS * CHUNK
DISTANCE = CHUNKS * (ERRORS + 1) - 1
BITS = 32
SIMILAR = 75
PARITY_WORDS = 32
# Stars go on while more pairs than this per filed signature are left, and halve them.
PAIRS_PER_ROW = 64.0

_PLACES = [
    tuple(chunk * CHUNK + p for p in kept)
    for chunk in range(CHUNKS) for kept in combinations(range(CHUNK), CHUNK - ERRORS)
]
_XORS = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(7919))
_ODDS = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(104729)) | np.uint64(1)

SIGNED = (
    "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, "
    "signature array<int>, parity array<long>"
)


def _signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """b-bit minima of the non-empty sets: one row of ``SYMBOLS`` numbers each."""
    out = np.empty((SYMBOLS, len(starts)), np.int32)
    shift = np.uint64(64 - BITS)
    for k in range(SYMBOLS):
        drawn = ((values ^ _XORS[k]) * _ODDS[k]) >> shift
        out[k] = np.minimum.reduceat(drawn, starts).astype(np.uint32).view(np.int32)
    return np.ascontiguousarray(out.T)


def _parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each non-empty sorted set, which cells hold an odd number of shingles."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(values)]))
    spot = owner * PARITY_WORDS + (values >> np.uint64(59)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, spot[1:] != spot[:-1]])
    bits = np.uint64(1) << ((values >> np.uint64(53)) & np.uint64(63))
    out = np.zeros(len(starts) * PARITY_WORDS, np.uint64)
    out[spot[first]] = np.bitwise_xor.reduceat(bits, first)
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            values, starts = shingle_sets(piece.column("text"))
            sizes = np.diff(starts)
            full = np.flatnonzero(sizes)
            sums = np.zeros((2, len(sizes)), np.uint64)
            symbols, parity = np.empty((0, SYMBOLS), np.int32), np.empty(0, np.int64)
            if len(full):
                at = starts[:-1][full]
                sums[0, full] = np.add.reduceat(values, at)
                sums[1, full] = np.add.reduceat(mixed(values ^ _XORS[0]), at)
                symbols, parity = _signatures(values, at), _parities(values, at)
            ends = np.r_[0, np.cumsum(sizes > 0)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), piece.column("text_hash"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends * SYMBOLS), pa.array(symbols.reshape(-1))),
                    pa.ListArray.from_arrays(pa.array(ends * PARITY_WORDS), pa.array(parity)),
                ],
                names=[part.split()[0] for part in SIGNED.split(", ")],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            values, starts = shingle_sets(piece.column("text"))
            sets = pa.ListArray.from_arrays(
                pa.array(starts.astype(np.int32)), pa.array(values.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([piece.column("cls"), sets], names=["cls", "shingles"])


def _filed(classes: DataFrame) -> DataFrame:
    """(file, place, cls): a row for each choice of places of each signature."""
    s = F.col("signature")
    keys = [
        F.xxhash64(F.lit(n), *[F.get(s, F.lit(p)) for p in places])
        for n, places in enumerate(_PLACES)
    ]
    return classes.select("cls", F.posexplode(F.array(*keys)).alias("place", "file"))


def _differing(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))


def _may_be_similar(a: str, b: str) -> Column:
    """Bounds on the similarity of two rows, from sizes and parities.

    ``a`` and ``b`` stand before the names of the columns n_shingles and parity.
    """
    na, nb = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
    pa_, pb = F.col(f"{a}parity"), F.col(f"{b}parity")
    words = [
        F.bit_count(F.get(pa_, F.lit(k)).bitwiseXOR(F.get(pb, F.lit(k))))
        for k in range(PARITY_WORDS)
    ]
    different = reduce(lambda x, y: x + y, words)
    return (100 * F.least(na, nb) >= SIMILAR * F.greatest(na, nb)) & (
        (100 + SIMILAR) * different <= (100 - SIMILAR) * (na + nb)
    )


def _first_meeting(a: Column, b: Column) -> Column:
    """The first file in which two signatures meet."""
    cases = None
    for n, places in reversed(list(enumerate(_PLACES))):
        meet = reduce(
            lambda x, y: x & y, (F.get(a, F.lit(p)) == F.get(b, F.lit(p)) for p in places)
        )
        cases = F.when(meet, F.lit(n)) if cases is None else F.when(meet, F.lit(n)).otherwise(cases)
    return cases


class _Links:
    """Candidate pairs in, confirmed links out."""

    def __init__(self, docs: DataFrame, members: DataFrame):
        self.members = members  # cls, doc_id, text_hash, n_shingles, signature, parity
        wanted = members.select(
            "cls", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
        )
        texts = docs.join(
            wanted, docs["doc_id"].eqNullSafe(wanted["_id"]) & (docs["text_hash"] == wanted["_hash"])
        ).select("cls", "text")
        self.sets = stored(
            texts.mapInArrow(_sets, "cls long, shingles array<long>").dropDuplicates(["cls"]), "sets"
        )

    def among(self, pairs: DataFrame) -> DataFrame:
        """The confirmed links among pairs (a, b) that may be repeated or far apart."""
        return stored(self.confirmed(stored(self.within_distance(pairs.distinct()), "pairs")), "links")

    def within_distance(self, pairs: DataFrame) -> DataFrame:
        names = ("n_shingles", "signature", "parity")
        a, b = (
            self.members.select(F.col("cls").alias(end), *[F.col(n).alias(end + n) for n in names])
            for end in "ab"
        )
        near = pairs.join(a, "a").join(b, "b").filter(
            _may_be_similar("a", "b")
            & (_differing(F.col("asignature"), F.col("bsignature")) <= DISTANCE)
        )
        return near.select("a", "b")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar."""
        a = self.sets.select(F.col("cls").alias("a"), F.col("shingles").alias("xa"))
        b = self.sets.select(F.col("cls").alias("b"), F.col("shingles").alias("xb"))
        both = pairs.join(a, "a").join(b, "b").withColumn(
            "shared", F.size(F.array_intersect("xa", "xb"))
        )
        union = F.size("xa") + F.size("xb") - F.col("shared")
        return both.filter(100 * F.col("shared") >= SIMILAR * union).select("a", "b")


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, label) of the classes that are linked with another; None if none is."""
    filed = _filed(classes)
    shared = filed.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("centre"))
    shared = shared.filter("n > 1").drop("n")
    rows = stored(filed.join(shared, "file"), "files")
    members = stored(
        classes.join(rows.select("cls").distinct(), "cls"), "members"
    )
    if not members.limit(1).count():
        return None
    links = _Links(docs, members)
    centres = rows.select(*_pair("cls", "centre")).filter("a <> b")
    labels = components(links.among(centres))
    turn, before = 0, None
    while True:
        turn += 1
        rows = stored(_unsettled(rows.select("file", "place", "cls"), labels, turn), "files")
        # A minor row is compared with all rows of its file.
        total = rows.agg(
            F.sum(F.when(F.col("minor"), F.col("n")).otherwise(0)).alias("pairs"),
            F.count(F.lit(1)).alias("rows"),
        ).first()
        if not total["rows"]:
            return labels
        few = total["pairs"] <= PAIRS_PER_ROW * total["rows"]
        if few or (before is not None and 2 * total["pairs"] > before):
            break
        before = total["pairs"]
        centres = rows.filter("label <> centre.label").select(*_pair("cls", "centre.cls"))
        labels = components(links.among(centres), labels)
    return components(links.confirmed(_left_over(rows, links)), labels)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _unsettled(rows: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """The files that still hold several groups, with a centre drawn anew for each.

    ``n`` is the file's number of rows; ``minor`` rows are not of its largest group.
    """
    own = labels.withColumnRenamed("node", "cls")
    labelled = rows.join(own, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    drawn = F.struct(F.xxhash64("cls", "file", F.lit(turn)).alias("h"), "cls", "label")
    groups = labelled.groupBy("file", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(drawn).alias("centre")
    )
    files = groups.groupBy("file").agg(
        F.count(F.lit(1)).alias("groups"), F.min("centre").alias("centre"), F.sum("n").alias("n"),
        F.max(F.struct("n", "label")).alias("largest"),
    ).filter("groups > 1")
    minor = F.col("label") != F.col("largest.label")
    return labelled.join(files, "file").select(
        "file", "place", "cls", "label", "centre", "n", minor.alias("minor")
    )


def _left_over(rows: DataFrame, links: _Links) -> DataFrame:
    """All pairs of different groups that share a file, each from the first it shares."""
    signed = links.members.select("cls", "n_shingles", "signature", "parity")
    rows = rows.select("file", "place", "cls", "label", "minor").join(signed, "cls")
    other = rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
    pairs = rows.filter("minor").join(
        other,
        (F.col("file") == F.col("_file")) & (F.col("label") != F.col("_label"))
        & (~F.col("_minor") | (F.col("cls") < F.col("_cls")))
        & _may_be_similar("", "_")
        & (_first_meeting(F.col("signature"), F.col("_signature")) == F.col("place"))
        & (_differing(F.col("signature"), F.col("_signature")) <= DISTANCE),
    )
    return stored(pairs.select(*_pair("cls", "_cls")).distinct(), "pairs")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of each row of ``docs``.

    Links texts whose sets of lower-cased five-word shingles have a similarity of 0.75 or
    more.  One row of a group is kept: that of the least doc_id (null ids last, then by
    hash of the text); rows equal in both are kept or not together.  Null texts and texts
    without words have no shingles, are linked with nothing and stay.
    """
    plain = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = stored(
        plain.select("doc_id", "text_hash", "text").mapInArrow(_sign, SIGNED), "signatures"
    )
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = stored(
        signed.filter("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min(place).alias("first"), F.any_value("signature").alias("signature"),
             F.any_value("parity").alias("parity"))
        .select(
            # Ids may be repeated with other texts; the set names its class.
            F.xxhash64("set_a", "set_b", "n_shingles").alias("cls"), "first.doc_id",
            "first.text_hash", "set_a", "set_b", "n_shingles", "signature", "parity",
        ),
        "classes",
    )
    labels = _links(plain, classes)
    owners = classes.select("set_a", "set_b", "cls", place.alias("first"))
    if labels is None:
        grouped = owners
    else:
        grouped = owners.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        grouped = grouped.withColumn("label", F.coalesce("label", "cls"))
        firsts = grouped.groupBy("label").agg(F.min("first").alias("first"))
        grouped = grouped.drop("first").join(firsts, "label")
    grouped = grouped.select("set_a", "set_b", "first")
    full = signed.filter("n_shingles > 0").join(stored(grouped, "groups"), ["set_a", "set_b"])
    alone = signed.filter("n_shingles = 0").withColumn("first", place)
    both = full.select("doc_id", "text_hash", "n_shingles", "first").unionByName(
        alone.select("doc_id", "text_hash", "n_shingles", "first")
    )
    return both.select(
        "doc_id", "text_hash", "n_shingles", F.col("first.doc_id").alias("component_id"),
        F.col("first").eqNullSafe(place).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group left; columns as they come.

    Of rows with equal doc_id and text one stays.
    """
    left = near_duplicates(docs).filter("kept").select(row_key("doc_id", "text_hash").alias("key"))
    rows = packed(docs, "doc_id", F.xxhash64("text")).dropDuplicates(["key"])
    return rows.join(left, "key", "left_semi").select("row.*")


def op9_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their group of near-duplicates."""
    return near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


QUERIES = {"op9_minhash_hamming": op9_minhash_hamming}
ORACLES: dict[str, str] = {}
