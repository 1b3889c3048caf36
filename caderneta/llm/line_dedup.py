"""Operator 7, line dedup: an exact set-similarity join over the lines of all documents.

A line is the set of its words.  Words are ordered by rarity, known from a count of all
words hashed into a fixed number of cells; any fixed order gives exact results, a good
one gives short candidate lists.  Two lines of enough similarity share a word among the
first few of each (prefix filter), have similar lengths, leave enough words after that
place (positional filter), and differ in few bits of a 256-bit parity of their words.
Pairs that pass are verified on whole sets.  A line goes if an earlier one matches it.

Equal sets are folded first.  A star round then compares each line with the earliest
lines of some of its words only.  A line that this removes looks for no earlier one any more,
so a large family of variants does not meet in all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from caderneta.llm.arrow_words import Words, mixed, pieces
from caderneta.llm.tables import discard, load, packed, release, row_key, settled, stored

SIMILAR = 80
# Every line with a word takes part; one without has an empty set, which is like no other.
LEAST_WORDS = 1
# Up to so many words, a set is similar to none but its equals, which are folded before any join.
ONLY_EQUAL = (SIMILAR - 1) // (100 - SIMILAR)
CELLS = 1 << 24
# The rarest words of a changed copy may be its changes, the last of its prefix are those of its family.
STAR_FIRST, STAR_LAST = 2, 4
STAR_CENTRES = 4
# A word of fewer occurrences is that of a few lines, which may as well meet in all pairs.
STAR_LEAST = 16
# Words from so many occurrences on are many lines' words for certain, and their lists are split.
COMMON = 1 << 12
SALTS = 16
# Candidates are searched by a part of the words at a time, and verified by a part of the
# lines, whose sets go with each pair: so less disk is in use at once.
ROUNDS = 4
VERIFY_ROUNDS = 4
# The parity of a set's words, in so many columns of 64 bits each.  In 64 bits alone, those of
# any two lines of a hundred words are as close as the filter allows.
PARITY = ("bits0", "bits1", "bits2", "bits3")
LEAST_FILTER, MOST_FILTER = 1 << 20, 1 << 28


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lines, the text each is of, its number there from 0)."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return split.flatten(), owner, number


class LineSets:
    """The different words of each line of a piece, lines without words left out.

    ``values[starts[i]:starts[i + 1]]`` are the hashes of line ``i`` by ``rarity``, then
    by hash; ``owner`` and ``number`` tell where the line is.  ``only`` says of these two
    which lines are wanted.
    """

    def __init__(
        self, texts: pa.Array, rarity: np.ndarray | None = None,
        only: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    ):
        lines, owner, number = _lines(texts)
        if only is not None:
            asked = only(owner, number)
            lines, owner, number = lines.filter(pa.array(asked)), owner[asked], number[asked]
        words = Words(lines)
        hashes = words.hashes()
        rank = np.zeros(len(hashes), np.uint8) if rarity is None else rarity[cells(hashes)]
        order = np.lexsort((hashes, rank))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        line = np.repeat(np.arange(len(words.counts)), words.counts)
        keys = np.sort(line * max(len(order), 1) + place[words.codes])
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
        line, at = np.divmod(keys, max(len(order), 1))
        sizes = np.bincount(line, minlength=len(words.counts))
        large = sizes >= LEAST_WORDS
        kept = large[line]
        self.values = hashes[order[at[kept]]]
        self.ranks = rank[order[at[kept]]]
        self.sizes = sizes[large]
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.owner, self.number = owner[large], number[large]

    def set_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each set."""
        if not len(self.sizes):
            none = np.empty(0, np.int64)
            return none, none
        at = self.starts[:-1]
        a = np.add.reduceat(mixed(self.values), at)
        b = np.add.reduceat(mixed(self.values ^ np.uint64(0x5BD1E995)), at)
        return a.view(np.int64), b.view(np.int64)

    def parities(self) -> list[np.ndarray]:
        """The parity of each set's words, 64 bits at a time."""
        if not len(self.sizes):
            return [np.empty(0, np.int64) for _ in PARITY]
        one = np.uint64(1) << ((self.values >> np.uint64(56)) & np.uint64(63))
        column = self.values >> np.uint64(62)
        return [
            np.bitwise_xor.reduceat(np.where(column == k, one, np.uint64(0)), self.starts[:-1]).view(np.int64)
            for k in range(len(PARITY))
        ]


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(CELLS)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int32)
    for batch in batches:
        for piece in pieces(batch):
            words = Words(piece.column("text"))
            counts = np.bincount(words.codes, minlength=len(words.names))
            np.add.at(total, cells(words.hashes()), counts.astype(np.int32))
    used = np.flatnonzero(total)
    for begin in range(0, len(used), 1 << 16):
        part = used[begin : begin + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"]
        )


def rank_of(n: int) -> int:
    return min(1 + math.floor(8 * math.log2(n)), 255)


def word_rarity(docs: DataFrame) -> np.ndarray:
    """One byte per cell: eight steps for each doubling of its count; 1 is a single word.

    Counts cover all words of all documents; at most ``CELLS`` rows reach the driver.
    """
    counted = docs.select("text").mapInArrow(_cell_counts, "cell int, n int").groupBy("cell")
    rank = F.least(1 + F.floor(8 * F.log2("n")), F.lit(255)).cast("short")
    table = counted.agg(F.sum("n").alias("n")).select("cell", rank.alias("rank")).toArrow()
    rarity = np.zeros(CELLS, np.uint8)
    rarity[table.column("cell").to_numpy()] = table.column("rank").to_numpy().astype(np.uint8)
    return rarity


LINE = (
    "doc_id long, text_hash long, line int, set_a long, set_b long, n int, "
    + "".join(f"{name} long, " for name in PARITY) + "skipped int, few int, common int, prefix array<int>"
)


def _line_rows(docs: DataFrame, rarity: np.ndarray) -> DataFrame:
    """A row per line with its prefix: the hashes of its first words that occur again."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = LineSets(piece.column("text"), shared.value)
                a, b = sets.set_hashes()
                reach = sets.sizes - -(-SIMILAR * sets.sizes // 100) + 1
                within = np.arange(len(sets.values)) - np.repeat(sets.starts[:-1], sets.sizes)
                joined = np.repeat(sets.sizes > ONLY_EQUAL, sets.sizes)
                first = joined & (within < np.repeat(reach, sets.sizes))
                # A cell counted once holds a word no other line has; those come first.
                again = first & (sets.ranks > 1)
                line = np.repeat(np.arange(len(sets.sizes)), sets.sizes)
                taken = np.bincount(line[again], minlength=len(sets.sizes))
                few = np.bincount(line[again & (sets.ranks < rank_of(STAR_LEAST))], minlength=len(sets.sizes))
                common = np.bincount(line[again & (sets.ranks >= rank_of(COMMON))], minlength=len(sets.sizes))
                ends = np.r_[0, np.cumsum(taken)].astype(np.int32)
                words = (sets.values[again] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                owner = pa.array(sets.owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(owner), piece.column("text_hash").take(owner),
                        pa.array(sets.number.astype(np.int32)), pa.array(a), pa.array(b),
                        pa.array(sets.sizes.astype(np.int32)), *map(pa.array, sets.parities()),
                        pa.array((reach - taken).astype(np.int32)), pa.array(few.astype(np.int32)),
                        pa.array(common.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(words)),
                    ],
                    names=["doc_id", "text_hash", "line", "set_a", "set_b", "n", *PARITY,
                           "skipped", "few", "common", "prefix"],
                )

    return docs.mapInArrow(run, LINE)


def _may_match(x: str, y: str) -> Column:
    """Length, positional and parity filters on two rows that share a prefix word."""
    def of(name: str) -> tuple[Column, Column]:
        return F.col(f"{x}.{name}").cast("long"), F.col(f"{y}.{name}").cast("long")

    (n, m), (i, j) = of("n"), of("at")
    most = F.least(i, j) + F.least(n - i, m - j)
    lengths = 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)
    differing = sum(
        (F.bit_count(F.col(f"{x}.{bits}").bitwiseXOR(F.col(f"{y}.{bits}"))) for bits in PARITY), F.lit(0)
    )
    return (
        lengths & ((100 + SIMILAR) * most >= SIMILAR * (n + m))
        & ((100 + SIMILAR) * differing <= (100 - SIMILAR) * (n + m))
    )


def _posted(rows: DataFrame, prefix: Column, *more: str) -> DataFrame:
    """(word, id, n, at, parity) for each word of ``prefix``, ``at`` its place in the line's order."""
    each = rows.select("id", "n", *PARITY, "skipped", *more, F.posexplode(prefix).alias("i", "word"))
    return each.select("word", "id", "n", (F.col("skipped") + F.col("i")).alias("at"), *PARITY, *more, "i")


def _candidates(prefixes: DataFrame, turn: int) -> DataFrame:
    """Pairs of classes, the later not ``done``, that pass the filters on a shared prefix word of this turn.

    The larger line looks with its whole prefix; the smaller is filed under the shorter
    one that suffices for a partner of at least its size.  A common word may be that of any
    share of the classes: its lookers are dealt over several tasks that all get the filed.
    """
    share = 2 * SIMILAR  # of 100 + SIMILAR: the least common part of two lines of one size
    filed = F.col("n") - F.ceil(share * F.col("n") / (100 + SIMILAR)) + 1
    first_common = F.size("prefix") - F.col("common")
    rows = prefixes.withColumn("first_common", first_common)
    posted = _posted(rows, F.col("prefix"), "done", "first_common").withColumn(
        "many", F.col("i") >= F.col("first_common")
    ).drop("i", "first_common").filter(F.pmod("word", F.lit(ROUNDS)) == turn)
    salts = F.when(F.col("many"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    own = F.when(F.col("many"), F.pmod("id", F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    x = posted.withColumn("salt", own).drop("many").alias("x")
    y = posted.filter(F.col("at") < filed).withColumn("salt", F.explode(salts)).drop("many").alias("y")
    met = x.join(
        y,
        (F.col("x.word") == F.col("y.word")) & (F.col("x.salt") == F.col("y.salt"))
        & ((F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id"))))
        & (F.when(F.col("x.id") > F.col("y.id"), F.col("x.done")).otherwise(F.col("y.done")) == 0)
        & _may_match("x", "y"),
    )
    return met.select(*_pair("x.id", "y.id")).distinct()


def _star_pairs(prefixes: DataFrame) -> DataFrame:
    """Each class with a few of the earliest of some of its prefix words, if they may match.

    Words of few occurrences, the first of a prefix, have no star.  Numbers are dealt into
    remainders, and the least of each is a centre of the word.
    """
    rows = prefixes.filter(F.size("prefix") > F.col("few")).withColumn("last", F.size("prefix") - STAR_LAST)
    posted = _posted(rows, F.col("prefix"), "few", "last").filter(F.col("i") >= F.col("few"))
    stars = posted.filter((F.col("i") < STAR_FIRST) | (F.col("i") >= F.col("last"))).drop("i", "few", "last")
    # The least row is found in map tasks first, so a common word gathers nowhere.
    told = [F.min_by(c, "id").alias(c) for c in ("n", "at", *PARITY)]
    centres = stars.groupBy("word", F.pmod("id", F.lit(STAR_CENTRES)).alias("rest")).agg(
        F.min("id").alias("id"), *told
    )
    x, y = stars.alias("x"), centres.drop("rest").alias("y")
    met = x.join(y, "word").filter((F.col("y.id") < F.col("x.id")) & _may_match("x", "y"))
    return met.select(*_pair("x.id", "y.id")).distinct()


def _line_filter(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter over ``key``: 64-bit words, two bytes for each key up to 32 MB in all."""
    size = LEAST_FILTER
    number = wanted.count()
    while size < min(16 * number, MOST_FILTER):
        size *= 2
    bit = F.pmod("key", F.lit(size))
    rows = wanted.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(key, {size}) % 64 AS INT))")).alias("bits")
    ).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits.view(np.uint64)


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, words): the whole sets of the wanted classes, from another look at their first lines."""
    key = F.col("first.text_hash").bitwiseXOR(F.col("first.line").cast("long"))
    shared = docs.sparkSession.sparkContext.broadcast(_line_filter(wanted.select(key.alias("key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for piece in pieces(batch):
                texts = piece.column("text_hash").to_numpy()

                def hit(owner: np.ndarray, number: np.ndarray) -> np.ndarray:
                    bit = (texts[owner] ^ number).view(np.uint64) % np.uint64(64 * len(bits))
                    found = bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))
                    return (found & np.uint64(1)).astype(bool)

                sets = LineSets(piece.column("text"), only=hit)
                a, _ = sets.set_hashes()
                _, lines = np.unique(a, return_index=True)
                parts = [sets.values[sets.starts[i] : sets.starts[i + 1]] for i in lines]
                ends = np.r_[0, np.cumsum(sets.sizes[lines])].astype(np.int32)
                flat = np.concatenate(parts) if parts else sets.values[:0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[lines]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
                    names=["cls", "words"],
                )

    found = docs.select("text", "text_hash").mapInArrow(run, "cls long, words array<long>")
    return found.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def _gone(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The later class (b) of each pair (a, b) whose whole sets are similar, stored as ids."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    firsts = stored(classes.select("id", "cls", "first").join(wanted, "id"), "firsts")
    told = firsts.select("id", "cls")
    sets = stored(_whole_sets(docs, firsts.select("cls", "first")).join(told, "cls"), "sets")
    a = sets.select(F.col("id").alias("a"), F.col("words").alias("xa"))
    b = sets.select(F.col("id").alias("b"), F.col("words").alias("xb"))
    # Above a generator the sets are intersected once a pair; in the filter it would be twice.
    both_sizes = (F.size("xa") + F.size("xb")).alias("both")
    shared = F.size(F.array_intersect("xa", "xb")).alias("shared")
    found = []
    for turn in range(VERIFY_ROUNDS):
        some = pairs.filter(F.pmod(F.xxhash64("a"), F.lit(VERIFY_ROUNDS)) == turn)
        compared = settled(some.join(a, "a").join(b, "b"), "b", values=[both_sizes, shared])
        similar = compared.filter((100 + SIMILAR) * F.col("shared") >= SIMILAR * F.col("both"))
        found.append(stored(similar.select(F.col("b").alias("id")).distinct(), "gone"))
        release(docs.sparkSession)
    gone = stored(reduce(DataFrame.unionByName, found).distinct(), "gone")
    discard(firsts, sets, *found)
    return gone


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _in_turns(search: Callable[[int], DataFrame], spark: SparkSession) -> DataFrame:
    """The different pairs that the search finds by a part of the words at a time, stored."""
    found = []
    for turn in range(ROUNDS):
        release(spark)
        found.append(stored(search(turn), "pairs"))
    release(spark)
    pairs = stored(reduce(DataFrame.unionByName, found).distinct(), "pairs")
    discard(*found)
    return pairs


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line) of every line that an earlier line matches.

    Earlier means: in a document of lesser doc_id (null last, then by hash of the text),
    or before it in the same one.  Rows of equal id and text lose the same lines.  Lines
    without words are never removed.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rarity = word_rarity(keyed)
    lines = stored(_line_rows(keyed, rarity), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")
    told = ("n", *PARITY, "skipped", "few", "common", "prefix")
    folded = lines.groupBy("set_a", "set_b").agg(
        F.min(place).alias("first"), *[F.any_value(c).alias(c) for c in told]
    )
    # An earlier class has the lesser id.
    numbered = folded.orderBy("first").withColumn("id", F.monotonically_increasing_id())
    numbered = stored(numbered, "classes")
    release(docs.sparkSession)
    classes = numbered.select("id", F.col("set_a").alias("cls"), "set_b", "first")
    prefixes = numbered.select("id", *told).filter(F.size("prefix") > 0)
    star_pairs = stored(_star_pairs(prefixes), "pairs")
    release(docs.sparkSession)
    done = _gone(keyed, classes, star_pairs)
    flagged = prefixes.join(done.withColumn("done", F.lit(1)), "id", "left").fillna(0, ["done"])
    flagged = stored(flagged, "flagged")
    found = _in_turns(lambda turn: _candidates(flagged, turn), docs.sparkSession)
    discard(flagged)
    # What the star round has compared, similar or not, is not compared again.
    pairs = stored(found.join(star_pairs, ["a", "b"], "left_anti"), "pairs")
    discard(star_pairs, found)
    matched = done.unionByName(_gone(keyed, classes, pairs)).distinct().withColumn("matched", F.lit(True))
    discard(pairs)

    known = classes.withColumnRenamed("cls", "set_a").join(matched, "id", "left").drop("id")
    judged = lines.select("doc_id", "text_hash", "line", "set_a", "set_b").join(known, ["set_a", "set_b"])
    return judged.filter(F.col("matched") | (F.col("first") != place)).select(
        "doc_id", "text_hash", "line"
    ).distinct()


def _listed(removed: DataFrame) -> DataFrame:
    """(key, removed): the numbers of a document's removed lines."""
    return removed.groupBy(row_key("doc_id", "text_hash").alias("key")).agg(
        F.array_sort(F.collect_list("line")).alias("removed")
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents without their removed lines; columns as they come.

    A null text stays null; a text all of whose lines go is empty.
    """
    rows = packed(docs, "doc_id", F.xxhash64("text"))
    rows = rows.join(_listed(removed_lines(docs.select("doc_id", "text"))), "key", "left")
    left = F.filter(
        F.split("row.text", "\n"), lambda line, i: ~F.array_contains("removed", i)
    )
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the numbers (from 0) of the lines that earlier lines match."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select(
        "doc_id", row_key("doc_id", F.xxhash64("text")).alias("key"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"),
    )
    marked = counted.join(_listed(removed_lines(docs)), "key", "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return marked.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"),
    )


QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLES: dict[str, str] = {}
