"""Operator 3, quality rules: a learned decision list of threshold conjunctions.

Sequential covering: a rule for low quality is grown one threshold at a time by FOIL's
gain on one part of the labelled rows and pruned on the other; rows it covers go, and the
next rule is grown.  Each step is one aggregate over all labelled rows into counts per
feature and bin, a table whose size does not depend on the data.  The list comes out as
one ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.tables import WORD, load, settled, stored, words

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_lines", "n_upper", "n_marks")
FEATURES = (
    "n_words", "word_length", "symbols_per_word", "duplicate_lines", "repeated_words",
    "upper_case", "marks_per_word",
)
BINS = 16
MOST_RULES = 8
MOST_CONDITIONS = 3
# A rule must be this precise on the pruning part, and cover this many low-quality rows.
PRECISION = 0.9
LEAST_COVER = 3


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, limit = F.col(self.feature), F.lit(self.threshold)
        return value > limit if self.above else value <= limit


Rule = tuple[Condition, ...]


def _repeated_words(shared: Column, hashes: Column) -> Column:
    """Words inside windows whose hash occurs again, from the windows' hashes.

    Sorted with their places, equal hashes stand side by side; each repeated window adds
    the words before the next one starts.
    """
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        def place(row: Column, i: Column) -> Column:
            again = (F.get(rows, i - 1)["h"] == row["h"]) | (F.get(rows, i + 1)["h"] == row["h"])
            return F.when(again, row["i"])

        return F.array_sort(F.array_compact(F.transform(rows, place)))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    # One-element arrays name a value inside an expression, so it is computed once.
    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    heavy = let(ordered, lambda rows: let(places(rows), covered))
    return F.when(shared, heavy).otherwise(F.lit(0))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of ``COUNTS`` over whole texts; null and empty texts count 0.

    Windows are compared by 64-bit hash within one text, where a chance collision among
    a million windows has odds of 3e-8.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    number = F.size("_words")
    step1 = docs.withColumn("_words", words(F.col(text))).withColumn("_lines", lines)
    step2 = step1.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.when(
        number >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), number - WINDOW),
            lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    step3 = step2.withColumn("_windows", windows)
    shared = F.size(F.array_distinct("_windows")) < F.size("_windows")

    def count(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)).cast("long")

    counted = step3.withColumns({
        "n_words": number.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": count(r"[#*$%&|<>]"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _repeated_words(shared, F.col("_windows")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_upper": count(r"\p{Lu}"),
        "n_marks": count(r"[!?]"),
    })
    return counted.drop("_words", "_lines", "_hash", "_windows")


def with_features(counted: DataFrame) -> DataFrame:
    """Adds the features the rules may test, all doubles and never null."""
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return counted.withColumns({
        "word_length": F.col("word_chars") / per_word,
        "symbols_per_word": F.col("n_symbols") / per_word,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / per_word,
        "upper_case": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "marks_per_word": F.col("n_marks") / per_word,
    })


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _thresholds(labelled: DataFrame) -> dict[str, list[float]]:
    """Candidate limits per feature: half way between quantiles of the good rows and the bad."""
    parts = [k / (BINS // 2) for k in range(BINS // 2 + 1)] + [0.99, 0.999]
    asked = [
        F.percentile_approx(F.when(F.col("bad") == bad, F.col(f).cast("double")), parts, 10000)
        .alias(f"{f}_{bad}")
        for f in FEATURES for bad in (0, 1)
    ]
    row = labelled.agg(*asked).first()
    limits = {}
    for f in FEATURES:
        seen = sorted({v for bad in (0, 1) for v in (row[f"{f}_{bad}"] or [])})
        limits[f] = [(a + b) / 2 for a, b in zip(seen, seen[1:])]
    return limits


def _histogram(rows: DataFrame, limits: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Good and bad rows per feature and bin; at most features x (limits + 1) rows return."""
    bins = [
        F.struct(
            F.lit(f).alias("feature"),
            reduce(
                lambda a, b: a + b,
                [F.when(F.col(f) > limit, 1).otherwise(0) for limit in values], F.lit(0),
            ).alias("bin"),
        )
        for f, values in limits.items()
    ]
    counted = (
        rows.select("bad", F.explode(F.array(*bins)).alias("at"))
        .groupBy("at.feature", "at.bin")
        .agg(F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad"))
    )
    table = {f: [[0, 0] for _ in range(len(values) + 1)] for f, values in limits.items()}
    for row in counted.collect():
        table[row["feature"]][row["bin"]] = [row["good"], row["bad"]]
    return table


def _gain(good: int, bad: int, good_before: int, bad_before: int) -> float:
    """FOIL's gain of narrowing a rule to ``bad`` rows and ``good`` mistakes."""
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(bad_before / (bad_before + good_before)))


def _best(table: dict[str, list[list[int]]], limits: dict[str, list[float]]):
    """(gain, condition, mistakes left) of the best next threshold; ties go by feature."""
    best = (0.0, None, 0)
    for f, values in limits.items():
        good_all = sum(g for g, _ in table[f])
        bad_all = sum(b for _, b in table[f])
        good = bad = 0
        for k, limit in enumerate(values):
            good, bad = good + table[f][k][0], bad + table[f][k][1]
            for above, g, b in ((False, good, bad), (True, good_all - good, bad_all - bad)):
                gain = _gain(g, b, good_all, bad_all)
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(f, above, limit), g)
    return best


def _met(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule))


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule that is best on the pruning part, and what it covers."""
    sums = []
    for n in range(1, len(rule) + 1):
        met = _met(rule[:n]).cast("long")
        sums += [F.sum(met * (1 - F.col("bad"))), F.sum(met * F.col("bad"))]
    row = [v or 0 for v in rows.agg(*sums).first()]
    scored = []
    for n in range(1, len(rule) + 1):
        good, bad = row[2 * n - 2], row[2 * n - 1]
        scored.append(((bad - good) / (bad + good) if bad + good else -1.0, -n, good, bad))
    value, n, good, bad = max(scored)
    return rule[:-n], good, bad


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """The decision list for ``bad`` = 1; all labelled rows are used.

    ``labelled`` has the features, ``bad`` (0 or 1) and ``part`` (0 to 2; part 2 prunes).
    Without rows of both classes there are no rules.
    """
    counts = {r["bad"]: r["n"] for r in labelled.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    rules: list[Rule] = []
    if not counts.get(0) or not counts.get(1):
        return rules
    limits = _thresholds(labelled)
    left = labelled
    while len(rules) < MOST_RULES:
        rule: Rule = ()
        grow = left.filter(F.col("part") < 2)
        while len(rule) < MOST_CONDITIONS:
            rows = grow.filter(_met(rule)) if rule else grow
            gain, condition, mistakes = _best(_histogram(rows, limits), limits)
            if condition is None:
                break
            rule = (*rule, condition)
            if mistakes == 0:
                break
        if not rule:
            break
        rule, good, bad = _pruned(left.filter(F.col("part") == 2), rule)
        if bad < LEAST_COVER or bad < PRECISION * (good + bad):
            break
        rules.append(rule)
        left = left.filter(~_met(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The first rule (from 1) that a row meets, null if none: one CASE expression."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        found = F.when(_met(rule), F.lit(number)).otherwise(found)
    return found


def _rules_for(counted: DataFrame, labels: DataFrame) -> list[Rule]:
    told = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1)).distinct()
    labelled = (
        counted.filter(~base_failed()).join(told, "doc_id")
        .select(*FEATURES, (1 - F.col("quality")).cast("long").alias("bad"),
                F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"))
    )
    return learn_rules(stored(labelled, "labelled"))


def _counted(docs: DataFrame) -> DataFrame:
    """Id and features of each document, stored: texts are not written again."""
    counted = with_features(text_counts(docs.select("doc_id", "text"))).drop("text")
    return stored(counted, "quality")


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, rule, kept) of each document.

    Rules are learned from ``labels`` (doc_id, quality 0 or 1), joined by id; labels that
    are null, or whose document is not there, say nothing.  A document is kept when it
    passes the fixed rules and no learned one.  Null texts count 0 and fail; documents
    with null or repeated ids are judged like others.
    """
    counted = _counted(docs)
    rule = verdict(_rules_for(counted, labels))
    return counted.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), rule.alias("rule"),
        (~base_failed() & rule.isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``judge_quality`` keeps, columns as they come.

    Texts are counted twice, for learning and for judging, rather than stored or shuffled;
    the second time only into what the rules test.
    """
    rules = _rules_for(_counted(docs), labels)
    tested = {"n_words", "n_repeat_words", *(c.feature for rule in rules for c in rule)}
    rows = docs.select(F.struct("*").alias("row"))
    counted = settled(with_features(text_counts(rows, "row.text")), "row", values=sorted(tested))
    return counted.filter(~base_failed() & verdict(rules).isNull()).select("row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts and the verdict of rules learned from ``labels``."""
    judged = judge_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return judged.select("doc_id", *BASE, "base_failed", "kept", "rule")


QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLES: dict[str, str] = {}
