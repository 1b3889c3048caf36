"""Operator 11, spelling variants: a dictionary of pairs of trie nodes.

The words are put into a trie, their reversals into another, and the nodes of both are
numbered.  A prefix node and a suffix node together say what stands before and after a
place of a word.  The pair around one skipped letter is equal for two words that differ in
that letter, and equal to the pair at a place between letters of a word that lacks it; so
one grouping by pairs of integers finds exactly the words one edit apart.  Texts of words
are never compared, and no pair of words is tried that is not near.

Both tries are built by ranges of sorted words: a word's nodes are those it shares with
the word before, and new numbers for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caderneta.llm.ranges import common, dealt, draw_bounds, range_of
from caderneta.llm.tables import load, settled, stored

LEAST_LENGTH = 6
LEAST_TIMES = 5
MOST_FREQUENT = 5  # a form has so many times its word's occurrences
NOISE = 199
RUN = rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
RANGE_BITS = 40  # numbers within a range; the range stands above them

# What a row of the pair dictionary says of its word: a place between letters, a skipped
# letter that follows an equal one, any other skipped letter.
BETWEEN, REPEATED, SKIPPED = 0, 1, 2


def ascii_lower(text: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the runs of letters in whole texts, as the query's contract spells them.

    Shorter runs cannot become words, as an edit only takes a letter away.  A null text
    has no runs; a null id reads ``null``.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    found = found.withColumn("run", ascii_lower(F.col("run")))
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("run"))
    found = found.withColumn("h", F.crc32(named.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % NOISE == 0, shorter).otherwise(F.col("run"))
    counts = found.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH).groupBy("word")
    return counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_TIMES)


def bound_paths(bounds: list[str]) -> list[list[int]]:
    """The numbers of the prefixes of each bound, by length; equal prefixes have one number."""
    paths, path, last, fresh = [], [0], "", 0
    for bound in bounds:
        path = path[: common(last, bound) + 1]
        new = len(bound) + 1 - len(path)
        path += range(fresh + 1, fresh + new + 1)
        fresh, last = fresh + new, bound
        paths.append(path)
    return paths


def node_paths(
    keys: Iterator[tuple[int, str]], bounds: list[str], paths: list[list[int]]
) -> Iterator[list[int]]:
    """The trie nodes along each key, by length from 0 on.

    ``keys`` are sorted (range, key); the root is 0.  Prefixes of a bound have its numbers,
    in whatever range they occur, all others a number of their own range.
    """
    at, path, last = None, [0], ""
    edges: list[tuple[str, list[int]]] = []
    for number, key in keys:
        if number != at:
            at, path, last, fresh = number, [0], "", (number + 1) << RANGE_BITS
            edges = [(bounds[k], paths[k]) for k in (number - 1, number) if 0 <= k < len(bounds)]
        path = path[: common(last, key) + 1]
        for bound, known in edges:
            shared = common(bound, key) + 1
            if shared > len(path):
                path += known[len(path) : shared]
        new = len(key) + 1 - len(path)
        path += range(fresh + 1, fresh + new + 1)
        fresh, last = fresh + new, key
        yield path


def _with_range(words: DataFrame, key: str, bounds: list[str]) -> DataFrame:
    """Adds the range of each key."""
    shared = words.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [range_of(k, shared.value) for k in batch.column(key).to_pylist()]
            yield batch.append_column("range", pa.array(numbers, pa.int32()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.mapInArrow(run, f"{schema}, range int")


def forward_numbered(words: DataFrame) -> DataFrame:
    """(id, word, n, nodes): words numbered in code-point order, with their prefix nodes."""
    bounds = draw_bounds(words, "word")
    shared = words.sparkSession.sparkContext.broadcast((bounds, bound_paths(bounds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, count = None, 0
        waiting: list[tuple[int, str]] = []

        def keys() -> Iterator[tuple[int, str]]:
            while True:
                yield waiting.pop()

        numbered = node_paths(keys(), *shared.value)
        for batch in batches:
            ids, nodes = [], []
            for number, word in zip(batch.column("range").to_pylist(), batch.column("word").to_pylist()):
                if number != at:
                    at, count = number, 0
                waiting.append((number, word))
                nodes.append(next(numbered))
                ids.append((number << RANGE_BITS) + count)
                count += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column("word"), batch.column("n"),
                 pa.array(nodes, pa.list_(pa.int64()))],
                names=["id", "word", "n", "nodes"],
            )

    rows = dealt(_with_range(words, "word", bounds), bounds, "word")
    return rows.mapInArrow(run, "id long, word string, n long, nodes array<long>")


def node_pairs(words: DataFrame) -> DataFrame:
    """The dictionary: (before, after, id, n, kind), a row for each place and each skipped letter."""
    turned = words.select("id", "n", "nodes", F.reverse("word").alias("turned"))
    bounds = draw_bounds(turned, "turned")
    shared = words.sparkSession.sparkContext.broadcast((bounds, bound_paths(bounds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, str]] = []

        def keys() -> Iterator[tuple[int, str]]:
            while True:
                yield waiting.pop()

        numbered = node_paths(keys(), *shared.value)
        for batch in batches:
            before, after, rows, kinds = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("range", "turned", "nodes"))
            for row, (number, word, forward) in enumerate(zip(*columns)):
                waiting.append((number, word))
                backward = next(numbered)[::-1]  # by the place from which the suffix runs
                size = len(word)
                before += forward + forward[:-1]
                after += backward + backward[1:]
                kinds += [BETWEEN] * (size + 1)
                # The letter at a place stands next to the one before it, read from the back.
                kinds += [SKIPPED] + [
                    REPEATED if word[k] == word[k + 1] else SKIPPED for k in range(size - 2, -1, -1)
                ]
                rows += [row] * (2 * size + 1)
            taken = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(before, pa.int64()), pa.array(after, pa.int64()),
                 batch.column("id").take(taken), batch.column("n").take(taken),
                 pa.array(np.array(kinds, np.int8))],
                names=["before", "after", "id", "n", "kind"],
            )

    rows = dealt(_with_range(turned, "turned", bounds), bounds, "turned")
    return rows.mapInArrow(run, "before long, after long, id long, n long, kind tinyint")


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are near, and the one of largest n, least id on ties.

    A pair of nodes is held by one word at most with a place there, and by as many with a
    skipped letter as there are letters: groups are as small as the alphabet.  A letter
    within a run of equal ones counts at the run's first place only, so that words met by
    an inserted letter meet once.
    """
    together = Window.partitionBy("before", "after")
    shared = pairs.withColumn("size", F.count(F.lit(1)).over(together)).filter("size > 1")
    groups = shared.groupBy("before", "after").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "id", "kind"))).alias("all")
    )
    each = groups.select("all", F.explode("all").alias("x"))

    def meets(y: Column) -> Column:
        x = F.col("x")
        replaced = (x["kind"] != BETWEEN) & (y["kind"] != BETWEEN) & (x["id"] != y["id"])
        return replaced | (x["kind"] + y["kind"] == SKIPPED) & (x["kind"] != y["kind"])

    met = settled(each, "x", values=[F.filter("all", meets).alias("near")]).filter(F.size("near") > 0)
    found = met.select(
        F.col("x.id").alias("id"), F.size("near").alias("k"),
        F.get("near", F.lit(0))["less"].alias("less"), F.get("near", F.lit(0))["id"].alias("other"),
    )
    return found.groupBy("id").agg(
        F.sum("k").alias("n_near"), F.min(F.struct("less", F.col("other").alias("id"))).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of each word that has a form, from (id, form).

    Every round doubles the steps taken; a form is several times as frequent as its word,
    so a few rounds reach the last of every chain.
    """
    up = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        above = up.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = stored(up.join(above, "root", "left").select("id", "root", "next"), "roots")
        up = moved.select("id", F.coalesce("next", "root").alias("root"))
        if moved.filter("next IS NOT NULL").isEmpty():
            return up


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct ``words`` (word, n).

    Near words differ by one inserted, deleted or replaced code point.  The form of a word
    is its most frequent near word, if that has ``MOST_FREQUENT`` times its occurrences,
    else null; the root is where its forms lead.  Words that are null are left out.
    """
    known = stored(forward_numbered(stored(words.filter("word IS NOT NULL").select("word", "n"), "words")), "nodes")
    near = near_words(node_pairs(known))
    plain = known.select("id", "word", "n")
    often = -F.col("best.less") >= MOST_FREQUENT * F.col("n")
    judged = stored(
        plain.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.id")).alias("form_id"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "near",
    )
    led = judged.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form"))
    form = plain.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = plain.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    found = roots(led).select("id", F.col("root").alias("root_id")).join(root, "root_id").drop("root_id")
    return judged.join(form, "form_id", "left").join(found, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the corpus with their near words, forms and roots."""
    return spelling_variants(corpus_words(load(spark, sf_dir, "documents").select("doc_id", "text")))


# CRC-32 over the bytes of `named`, eight steps of its polynomial for each.
_CRC = """
xor(list_reduce(
    list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode(named)), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda crc, byte: list_reduce(
        [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295)::BIGINT
"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES = {
    "op11_spelling_variants": f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, 'null') AS d,
           unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents),
lowered AS (
    SELECT d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM runs GROUP BY ALL),
named AS (SELECT run, k, d || ':' || run AS named FROM lowered WHERE length(run) >= {LEAST_LENGTH}),
hashed AS (SELECT run, k, {_CRC} AS h FROM named),
edited AS (
    SELECT CASE WHEN h % {NOISE} = 0
                THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                ELSE run END AS word, k
    FROM hashed),
words AS (
    SELECT word, sum(k)::BIGINT AS n FROM edited WHERE length(word) >= {LEAST_LENGTH}
    GROUP BY word HAVING sum(k) >= {LEAST_TIMES}),
skips AS (
    SELECT word, n, i, substr(word, 1, i) AS l, substr(word, i + 2) AS r
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM skips a JOIN skips b ON a.l = b.l AND a.r = b.r AND a.word <> b.word
    UNION
    SELECT a.word, a.n, b.word, b.n FROM skips a JOIN words b ON a.l || a.r = b.word
    UNION
    SELECT b.word, b.n, a.word, a.n FROM skips a JOIN words b ON a.l || a.r = b.word),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place,
           count(*) OVER (PARTITION BY word) AS n_near
    FROM near),
judged AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
           CASE WHEN r.other_n >= {MOST_FREQUENT} * w.n THEN r.other END AS form,
           CASE WHEN r.other_n >= {MOST_FREQUENT} * w.n THEN r.other_n END::BIGINT AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
chain AS (
    SELECT word, word AS root, form AS next FROM judged
    UNION ALL
    SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON c.next = j.word)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON j.word = c.word AND c.next IS NULL
"""
}
