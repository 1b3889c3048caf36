"""Operator 2, mixing sources to target weights along a time-varying curriculum.

A source's rate over training time 0 to 1 is a piecewise linear schedule.  Its integral,
scaled to the source's target, is the words demanded so far.  Documents lie in hashed
order along their source's words; the time at which demand reaches the middle of a
document is its position.  Passes over a source repeat until its target is met.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caderneta.llm.tables import (
    key_hash,
    load,
    packed,
    row_key,
    running_starts,
    stored,
    word_count,
)

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
KNOTS = (0.0, 0.5, 1.0)
# The rate at each knot, for sources in turn: early, late, even.
RATES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (1.0, 1.0, 1.0))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    passes: int = MOST_PASSES,
) -> DataFrame:
    """(source, index, source_size, target): one row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn.  A target stops
    at ``passes`` times its source; the excess is shared out again by weight.  In order
    of cap / weight the capped sources come first, so running sums find them at once.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("index", F.row_number().over(by_name) - 1).withColumns({
        "w": F.get(turn, F.col("index") % len(weights)),
        "cap": F.col("source_size") * F.lit(float(passes)),
        "demand": F.sum("source_size").over(everything) * F.lit(share),
    })
    filling = Window.orderBy(F.col("cap") / F.col("w"), "index")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("demand") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn(
        "capped", F.col("cap") * F.sum("w").over(onwards) <= F.col("w") * left
    )
    capped = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)
    rows = rows.withColumns({"_used": capped, "_weight": weight})
    target = F.when(F.col("capped"), F.col("cap")).otherwise(
        (F.col("demand") - F.col("_used")) * F.col("w") / F.col("_weight")
    )
    return rows.select("source", "index", "source_size", target.alias("target"))


def position_at(part: Column, rates: Sequence[float], knots: Sequence[float] = KNOTS) -> Column:
    """The time by which the schedule has given ``part`` (0 to 1) of its integral."""
    areas = [0.0]
    for k in range(len(knots) - 1):
        areas.append(areas[-1] + (rates[k] + rates[k + 1]) / 2 * (knots[k + 1] - knots[k]))
    reached = part * F.lit(areas[-1])
    found = None
    for k in reversed(range(len(knots) - 1)):
        span = knots[k + 1] - knots[k]
        slope = (rates[k + 1] - rates[k]) / span
        rest = reached - F.lit(areas[k])
        root = F.sqrt(F.lit(rates[k] * rates[k]) + F.lit(2 * slope) * rest)
        time = F.lit(knots[k]) + F.lit(2.0) * rest / (F.lit(rates[k]) + root)
        found = time if found is None else F.when(reached < areas[k + 1], time).otherwise(found)
    return found


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    knots: Sequence[float] = KNOTS, rates: Sequence[Sequence[float]] = RATES,
) -> DataFrame:
    """Per document: size, its source's size and target, and a position for each copy.

    ``docs`` has doc_id, source and text.  A document is taken in a pass when its middle
    lies within the target, so a source misses its target by half a document at most.
    A null text has no words; null sources are one source; documents without words are
    taken along and count nothing; a source without words takes nothing.
    """
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"),
        key_hash(F.col("doc_id"), "mix").alias("_h"),
    )
    sized = stored(sized, "mix")
    targets = source_targets(sized, weights, share)
    laid = running_starts(sized, "source", "_h", F.col("size"))
    targets = targets.withColumnRenamed("source", "_source")
    rows = laid.join(targets, laid["source"].eqNullSafe(targets["_source"]))

    def position(turn: int) -> Column:
        middle = F.col("start") + F.col("size") / F.lit(2.0) + F.col("source_size") * turn
        part = middle / F.col("target")
        schedule = F.col("index") % len(rates)
        time = position_at(part, rates[-1], knots)
        for k in range(len(rates) - 1):
            time = F.when(schedule == k, position_at(part, rates[k], knots)).otherwise(time)
        return F.when((F.col("target") > 0) & (middle <= F.col("target")), time)

    positions = F.array_compact(F.array(*[position(turn) for turn in range(MOST_PASSES)]))
    return rows.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        positions.alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, range-sorted by position."""
    copies = mixed.select("*", F.posexplode("positions").alias("pass", "position"))
    return copies.drop("positions").orderBy("position", "doc_id", "pass")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as training reads them: a row per copy, range-sorted by position.

    Columns stay as they come.  Of rows with equal doc_id, source and text the first met
    stands for all.
    """
    mixed = mix(docs.select("doc_id", "source", "text"))
    copies = mixed.select(
        row_key("doc_id", "source", "text_hash").alias("key"), F.explode("positions").alias("position")
    )
    rows = packed(docs, "doc_id", "source", F.xxhash64("text")).dropDuplicates(["key"])
    return rows.join(copies, "key").orderBy("position", "key").select("row.*")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of each, by first position."""
    mixed = mix(load(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    first, again = F.get("positions", F.lit(0)), F.get("positions", F.lit(1))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("positions")).cast("long").alias("taken"),
        first.alias("position"), again.alias("second_position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def _sql_position(turn: int) -> str:
    """DuckDB text of ``position``, from the same parameters."""
    middle = f"(start + size / 2.0::DOUBLE + source_size * {turn})"
    branches = []
    for s, rates in enumerate(RATES):
        areas = [0.0]
        for k in range(len(KNOTS) - 1):
            areas.append(areas[-1] + (rates[k] + rates[k + 1]) / 2 * (KNOTS[k + 1] - KNOTS[k]))
        reached = f"({middle} / target * {areas[-1]}::DOUBLE)"
        cases = ""
        for k in range(len(KNOTS) - 1):
            slope = (rates[k + 1] - rates[k]) / (KNOTS[k + 1] - KNOTS[k])
            rest = f"({reached} - {areas[k]}::DOUBLE)"
            root = f"sqrt({rates[k] * rates[k]}::DOUBLE + {2 * slope}::DOUBLE * {rest})"
            time = f"{KNOTS[k]}::DOUBLE + 2.0::DOUBLE * {rest} / ({rates[k]}::DOUBLE + {root})"
            last = k == len(KNOTS) - 2
            cases += f" ELSE {time}" if last else f" WHEN {reached} < {areas[k + 1]} THEN {time}"
        branches.append(f"WHEN index % {len(RATES)} = {s} THEN CASE{cases} END")
    return (
        f"CASE WHEN target > 0 AND {middle} <= target THEN CASE {' '.join(branches)} END END"
    )


ORACLES = {
    "op2_curriculum_mix": f"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), 1, 15))::BIGINT AS h
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS index
    FROM sized GROUP BY source),
caps AS (
    SELECT *, [3, 1, 2][index % 3 + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap,
           sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS demand
    FROM sources),
filled AS (
    SELECT *, cap * sum(w) OVER (ORDER BY cap / w, index
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= w * (demand - coalesce(sum(cap) OVER (ORDER BY cap / w, index
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
    FROM caps),
targets AS (
    SELECT source, index, source_size, CASE WHEN capped THEN cap ELSE
        (demand - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) * w
        / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target
    FROM filled),
laid AS (
    SELECT s.doc_id, s.size, t.* EXCLUDE (source),
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (
    SELECT *, {_sql_position(0)} AS position, {_sql_position(1)} AS second_position FROM laid)
SELECT doc_id, size, source_size, target,
       size * ((position IS NOT NULL)::INTEGER + (second_position IS NOT NULL)::INTEGER) AS taken,
       position, second_position
FROM placed
"""
}
QUERIES = {"op2_curriculum_mix": op2_curriculum_mix}
