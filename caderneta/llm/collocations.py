"""Operator 13, phrase collocations: count streams in prefix and in suffix order.

Phrases are counted level by level.  Words of too few occurrences part the text, then pairs
and triples of words that are too rare do; what is left are windows of up to five words, and
the counts of all phrases are sums along the sorted windows.  Pairs and triples are counted
by a number drawn from their words, which at most makes a rare one look frequent.  The frequent phrases are then read as two
sorted streams.  In prefix order a phrase follows those it begins with, so one pass with a
stack of at most five counts tells the counts of all its beginnings and the most frequent
phrase that extends it to the right; in suffix order the same pass tells its endings and the
extension to the left.  The two streams meet in a merge join.  Frequent words, pairs and triples are
looked up, when texts are cut, in bit tables of fixed size; what passes by chance is counted
like the rest, by its words, and found too rare, so results are exact at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caderneta.llm.arrow_words import hashed, mixed, pieces
from caderneta.llm.ranges import dealt, draw_bounds, range_of
from caderneta.llm.tables import load, release, stored

LONGEST = 5
LEAST_TIMES = 100
BEST = 2000
COVERED = 100  # percent of a phrase's occurrences that lie in a longer one
PIECE_BYTES = 4 << 20
FILTER_BITS = 1 << 25
BUCKET_WORDS = 2_000_000  # words of the corpus for each bucket of phrase numbers
HELD_KEYS = 2_000_000  # phrase numbers a task gathers before it sends them
HELD_WINDOWS = 500_000  # windows likewise
BUCKETS = 64
# Between the words of a phrase: no word has it, and it sorts below all that words have.  The
# character 0 itself, in a word, is written as a blank, which no word has either.
JOIN = "\x00"

_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: blank, 2: parts the text
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0] = 0x20


class Tokens:
    """The words of a column of texts; nulls read as empty.

    ``names`` are the different words, ``codes`` the index of each word in turn, ``text`` the
    text it is of, and ``piece`` a number that changes wherever a phrase must end.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets.astype(np.int64) - offsets[0]
        kind = _KIND[data]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        self.text = np.searchsorted(offsets, starts, "right") - 1
        self.piece = np.cumsum(kind == 2, dtype=np.int64)[starts] + self.text
        kept = _LOWER[data[inside]]
        ends = np.r_[(np.cumsum(inside, dtype=np.int64)[starts] - 1), len(kept)].astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(kept))
        coded = words.dictionary_encode()
        self.names = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _languages(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """(different languages, the index of each text's)."""
    coded = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _word_keys(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return mixed(words ^ (langs * np.uint64(0x9E3779B97F4A7C15)))


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _bucket_keys(low: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """What stands for a phrase in its bit table: the lower half of its number, and its bucket."""
    return mixed(low * np.uint64(0x9E3779B97F4A7C15) + bucket)


def _spots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return keys % np.uint64(FILTER_BITS), (keys >> np.uint64(32)) % np.uint64(FILTER_BITS)


@dataclass(frozen=True)
class Level:
    """The frequent phrases of one length as a bit table; words are not counted in buckets."""

    bits: np.ndarray
    buckets: int = 0

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if self.buckets:
            buckets = np.uint64(self.buckets)
            keys = _bucket_keys(keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) % buckets)
        found = np.ones(len(keys), bool)
        for spot in _spots(keys):
            words = self.bits[(spot >> np.uint64(6)).astype(np.int64)]
            found &= (words >> (spot & np.uint64(63)) & np.uint64(1)) == 1
        return found


def _set(bits: np.ndarray, keys: np.ndarray) -> None:
    for spot in _spots(keys):
        np.bitwise_or.at(bits, (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))


def _bit_rows(bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = np.flatnonzero(bits)
    for begin in range(0, len(used), 1 << 16):
        at = used[begin : begin + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(bits[at].view(np.int64))], names=["at", "bits"]
        )


def _gathered(rows: DataFrame) -> np.ndarray:
    """The union of tasks' bit tables (at, bits): 4 MB, whatever they stand for."""
    table = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return bits.view(np.uint64)


def word_level(frequent: DataFrame) -> Level:
    """The bit table of words (lang, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            _set(bits, _word_keys(hashed(batch.column("word")), hashed(batch.column("lang"))))
        yield from _bit_rows(bits)

    return Level(_gathered(frequent.select("lang", "word").mapInArrow(run, "at int, bits long")))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, ascending, sum of their counts)."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _unique(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, number) of each different row of the columns of small numbers."""
    key = columns[0]
    for column in columns[1:]:
        _, key = np.unique(key, return_inverse=True)
        key = key * (int(column.max(initial=0)) + 1) + column
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return first, count


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, size=PIECE_BYTES):
                names, langs = _languages(piece)
                tokens = Tokens(piece.column("text"))
                of = langs[tokens.text]
                first, count = _unique(tokens.codes, of)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(of[first])), tokens.names.take(pa.array(tokens.codes[first])),
                     pa.array(count.astype(np.int64))],
                    names=["lang", "word", "n"],
                )

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Chains:
    """The words of a piece of a table, and which phrases that begin at each are frequent.

    ``levels`` hold the frequent phrases of one, two, .. words.  ``starts[m]`` are the places of the
    phrases of m + 1 words whose parts are frequent and which, where there is a table for
    them, are themselves; ``keys[m]`` are their numbers.
    """

    def __init__(self, piece: pa.RecordBatch, levels: list[Level], words: int):
        self.names, langs = _languages(piece)
        self.tokens = tokens = Tokens(piece.column("text"))
        self.of = langs[tokens.text]
        single = _word_keys(hashed(tokens.names)[tokens.codes], hashed(self.names)[self.of])
        goes_on = np.r_[tokens.piece[1:] == tokens.piece[:-1], np.zeros(min(len(single), 1), bool)]
        self.starts, self.keys = [np.arange(len(single))], [single]
        for m in range(words):
            if m:
                last = np.zeros(len(single) + 1, bool)
                last[self.starts[-1]] = True
                at = self.starts[-1]
                kept = last[at + 1] & goes_on[at]
                at = at[kept]
                self.starts.append(at)
                self.keys.append(_pair_keys(self.keys[-1][kept], single[at + m]))
            if m < len(levels):
                kept = levels[m].holds(self.keys[-1])
                self.starts[-1], self.keys[-1] = self.starts[-1][kept], self.keys[-1][kept]

    def place(self, rows: np.ndarray) -> pa.Array:
        return self.names.take(pa.array(self.of[rows]))


def phrase_level(docs: DataFrame, levels: list[Level], total: int, least: int) -> Level:
    """The bit table of phrases one word longer than the last level's, from ``least`` occurrences on.

    ``total`` is the number of words of the corpus.  Phrases go by 32 bits of their number
    in buckets by its other bits, so a task sends four bytes for each and one for how often;
    counts stop at ``least``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    number = total // BUCKET_WORDS + 1
    buckets = np.uint64(number)
    kind = np.uint8 if least < 256 else np.uint32

    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = (np.concatenate(x) for x in zip(*held))
        # A key's upper half names its bucket.
        keys = ((keys >> np.uint64(32)) % buckets << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        keys, counts = _summed(keys, counts)
        bucket = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])[: len(bucket)]
        ends = [*cuts[1:], len(bucket)]
        low = keys.astype(np.uint32)
        often = np.minimum(counts, least).astype(kind)
        spans = list(zip(cuts, ends))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts]), pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([often[a:b].tobytes() for a, b in spans], pa.binary())],
            names=["bucket", "keys", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch, size=PIECE_BYTES):
                keys = Chains(piece, shared.value, len(shared.value) + 1).keys[-1]
                held.append(_summed(keys, np.ones(len(keys), np.int64)))
                size += len(held[-1][0])
                if size >= HELD_KEYS:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        at, held = None, []

        def close() -> None:
            if held:
                keys, counts = _summed(*(np.concatenate(x) for x in zip(*held)))
                keys = keys[counts >= least].astype(np.uint64)
                _set(bits, _bucket_keys(keys, np.full(len(keys), at, np.uint64)))
                held.clear()

        for batch in batches:
            for row in range(batch.num_rows):
                if (bucket := batch.column("bucket")[row].as_py()) != at:
                    close()
                    at = bucket
                keys, counts = (batch.column(c)[row].as_py() for c in ("keys", "counts"))
                held.append((np.frombuffer(keys, np.uint32), np.frombuffer(counts, kind).astype(np.int64)))
        close()
        yield from _bit_rows(bits)

    rows = docs.select("lang", "text").mapInArrow(count, "bucket long, keys binary, counts binary")
    dealt_out = rows.repartition("bucket").sortWithinPartitions("bucket")
    return Level(_gathered(dealt_out.mapInArrow(gather, "at int, bits long")), number)


def windows(docs: DataFrame, levels: list[Level]) -> DataFrame:
    """(lang, phrase, n): the windows of two to five words that begin at each word.

    A window goes on while its next three words are a frequent phrase.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def together(held: list[pa.Table]) -> pa.Table:
        summed = pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        return summed.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch, size=PIECE_BYTES):
                chains = Chains(piece, shared.value, 3)
                names, at = chains.tokens.names, chains.starts[1]
                codes = np.r_[chains.tokens.codes, np.zeros(LONGEST, np.int64)] + 1
                threes = np.zeros(len(codes), bool)
                threes[chains.starts[2]] = True
                columns, still = [codes[at], codes[at + 1]], np.ones(len(at), bool)
                for k in range(2, LONGEST):
                    still = still & threes[at + k - 2]
                    columns.append(np.where(still, codes[at + k], 0))
                first, count = _unique(*columns, chains.of[at])
                parts = [names.take(pa.array(c[first] - 1, mask=c[first] == 0)) for c in columns]
                held.append(pa.table(
                    [chains.place(at[first]), pc.binary_join_element_wise(*parts, JOIN, null_handling="skip"),
                     pa.array(count.astype(np.int64))],
                    names=["lang", "phrase", "n"],
                ))
                size += len(first)
                if size >= HELD_WINDOWS:
                    held = [together(held)]
                    size = len(held[0])
                    if size >= HELD_WINDOWS // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from together(held).to_batches()

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(counted: DataFrame, least: int = LEAST_TIMES) -> DataFrame:
    """(lang, phrase, n) of the phrases of two words or more that occur ``least`` times.

    ``counted`` are windows; a phrase occurs where a window begins with it.  Sorted windows
    that share a beginning stand together, so a stack holds all open sums.  Only beginnings
    of a range's first and last window may go on in another range: their parts are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, str, int]] = []
        path: list[str] = []  # the language, then the words of the last window
        sums: list[int] = []  # occurrences of the language, and of each beginning
        edge = 0  # how much of the path the first window shares

        def close(depth: int, last: bool = False) -> None:
            while len(path) > depth:
                total = sums.pop()
                if len(path) > 2 and (last or len(path) <= edge or total >= least):
                    found.append((path[0], JOIN.join(path[1:]), total))
                path.pop()

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "phrase", "n"))
            for lang, phrase, n in zip(*columns):
                now = [lang, *phrase.split(JOIN)]
                same = 0
                while same < len(path) and same < len(now) and path[same] == now[same]:
                    same += 1
                opened = not path
                close(same)
                edge = min(edge, same)
                path += now[same:]
                sums += [0] * (len(now) - same)
                edge = len(now) if opened else edge
                for k in range(len(sums)):
                    sums[k] += n
            yield _phrase_batch(found)
            found.clear()
        close(0, last=True)
        yield _phrase_batch(found)

    ordered = counted.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    parts = ordered.select("lang", "phrase", "n").mapInArrow(run, "lang string, phrase string, n long")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _phrase_batch(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    lang, phrase, n = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(n, pa.int64())],
        names=["lang", "phrase", "n"],
    )


STREAM = "lang string, phrase string, n long, counts array<long>, extended long"


def _in_order(phrases: DataFrame, backwards: bool) -> DataFrame:
    """(lang, phrase, n, counts, extended) from one sorted stream of the frequent phrases.

    ``counts`` are those of the phrase's first one, two, .. words, or of its last ones if
    ``backwards``; ``extended`` is that of its most frequent extension at the other end, 0
    without one.  A phrase may have further rows without counts, from ranges that its
    extensions reach into.
    """
    turn = F.array_join(F.reverse(F.split("phrase", JOIN)), JOIN) if backwards else F.col("phrase")
    keyed = phrases.select(F.concat_ws(JOIN, F.replace("lang", F.lit(JOIN), F.lit(" ")), turn).alias("key"), "lang", "phrase", "n")
    bounds = draw_bounds(keyed, "key")
    above: dict[str, list[int]] = {}
    for number, bound in enumerate(bounds, 1):
        words = bound.split(JOIN)
        for k in range(2, len(words)):
            above.setdefault(JOIN.join(words[:k]), []).append(number)
    shared = phrases.sparkSession.sparkContext.broadcast((bounds, above))
    key_schema = "key string, lang string, phrase string, n long, range int, own boolean"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, above = shared.value
        for batch in batches:
            at, ranges, own = [], [], []
            for row, key in enumerate(batch.column("key").to_pylist()):
                number = range_of(key, bounds)
                for other in (number, *(r for r in above.get(key, ()) if r > number)):
                    at.append(row)
                    ranges.append(other)
                    own.append(other == number)
            copied = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*copied.columns, pa.array(ranges, pa.int32()), pa.array(own, pa.bool_())],
                names=["key", "lang", "phrase", "n", "range", "own"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path, stack, done = None, [], [], []

        def close(depth: int) -> None:
            while len(stack) > depth:
                lang, phrase, n, own, extended = stack.pop()
                path.pop()
                counts = [row[2] for row in stack] if own else None
                done.append((lang, phrase, n, counts, extended))

        def batch_of() -> pa.RecordBatch:
            columns = zip(*done) if done else [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["lang", "phrase", "n", "counts", "extended"],
            )
            done.clear()
            return out

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "key", "lang", "phrase", "n", "own"))
            for number, key, lang, phrase, n, own in zip(*columns):
                language, *words = key.split(JOIN)
                here = [(number, language, words[0]), *words[1:]]
                same = 0
                while same < len(path) and same < len(here) and path[same] == here[same]:
                    same += 1
                close(same)
                # All parts of a frequent phrase are frequent, so its beginnings are on the stack.
                if stack:
                    stack[-1][4] = max(stack[-1][4], n)
                path.append(here[-1])
                stack.append([lang, phrase, n, own, 0])
            yield batch_of()
        close(0)
        yield batch_of()

    placed = keyed.mapInArrow(place, key_schema)
    return dealt(placed, bounds, "key").mapInArrow(run, STREAM)


def _stream(phrases: DataFrame, backwards: bool, names: tuple[str, str]) -> DataFrame:
    found = _in_order(phrases, backwards).groupBy("lang", "phrase").agg(
        F.max("n").alias("a"), F.max("counts").alias(names[0]), F.max("extended").alias(names[1])
    )
    return found.filter(F.size(names[0]) > 0)


def collocations(docs: DataFrame, least: int = LEAST_TIMES, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A null language reads ``und``; null and empty texts have no words.  ``score`` is that of
    the cut that parts the phrase best, from whole numbers alone.  Phrases that occur only
    within a longer one are left out.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = stored(counts.filter(F.col("n") >= least), "frequent")
    total = totals.agg(F.sum("n")).first()[0] or 0
    levels = [word_level(frequent)]
    while len(levels) < 3:
        levels.append(phrase_level(docs, levels, total, least))
        release(spark)
    counted = stored(windows(docs, levels), "windows")
    release(spark)
    phrases = phrase_counts(counted, least)
    phrases = stored(
        phrases.unionByName(frequent.select("lang", F.col("word").alias("phrase"), "n")), "phrases"
    )
    left = _stream(phrases, False, ("first", "right_of"))
    right = _stream(phrases, True, ("last", "left_of")).drop("a")
    both = left.hint("merge").join(right, ["lang", "phrase"])
    covered = 100 * F.greatest("right_of", "left_of") >= COVERED * F.col("a")
    candidates = both.filter(~covered).join(totals, "lang")

    def big(value):
        return value.cast("decimal(19,0)")

    cuts = F.transform("first", lambda l, k: F.struct(
        F.expr("0L").alias("score"), (k + 1).alias("k"), l.alias("l"),
        F.get("last", F.size("first") - 1 - k).alias("r"),
    ))
    each = candidates.select("lang", "phrase", "a", "n", F.explode(cuts).alias("cut"))
    each = each.select("lang", "phrase", "a", "n", "cut.k", "cut.l", "cut.r")
    each = each.withColumns({
        "over": big(F.lit(1000) * F.col("a")) * big(F.col("n")), "under": big(F.col("l")) * big(F.col("r")),
    })
    each = each.withColumn("score", F.expr("over div under"))
    scored = each.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("a").alias("a"), F.max("n").alias("n")
    ).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    shown = F.transform(F.split("phrase", JOIN), lambda word: F.replace(word, F.lit(" "), F.lit(JOIN)))
    scored = scored.withColumn("phrase", F.array_join(shown, " "))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may have any share of the phrases: the best of each bucket, then of those.
    scored = scored.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    for part in (["lang", "bucket"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        scored = scored.withColumn("rank", place.cast("long")).filter(F.col("rank") <= best)
    return scored.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of the corpus."""
    return collocations(load(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {
    "op13_collocations": rf"""
WITH cut AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM parts GROUP BY lang),
places AS (SELECT lang, w, unnest(range(len(w))) AS i FROM parts),
grams AS (SELECT lang, w, i, unnest(range(1, least({LONGEST}, len(w) - i) + 1)) AS m FROM places),
counts AS (
    SELECT lang, w[i + 1 : i + m] AS p, count(*)::BIGINT AS f
    FROM grams GROUP BY ALL HAVING count(*) >= {LEAST_TIMES}),
candidates AS (SELECT lang, p, f FROM counts WHERE len(p) > 1),
inner_parts AS (
    SELECT lang, f, p, b, unnest(range(b + 1, len(p) + 1)) AS e
    FROM (SELECT lang, f, p, unnest(range(len(p))) AS b FROM candidates)),
inside AS (
    SELECT lang, p[b + 1 : e] AS p, max(f) AS f FROM inner_parts WHERE e - b < len(p) GROUP BY ALL),
left_over AS (
    SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p
    WHERE i.f IS NULL OR {COVERED} * c.f > 100 * i.f),
cuts AS (SELECT *, unnest(range(1, len(p))) AS k FROM left_over),
scored AS (
    SELECT c.lang, c.p, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
           ((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN counts x ON x.lang = c.lang AND x.p = c.p[1 : k]
    JOIN counts y ON y.lang = c.lang AND y.p = c.p[k + 1 :]),
lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS z FROM scored),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM lowest WHERE z = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM ranked
QUALIFY rank <= {BEST}
"""
}
