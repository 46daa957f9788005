"""Operator 10: mixing sources to target weights by a time-varying curriculum. Native DataFrame operations only.

Each source has a weight schedule that is linear in training time t in [0, 1]: target * (1 + k * (2 t - 1)).
Its integral from 0 to 1 is the source's target; its inverse turns a document's place in the cumulative token
demand of its source into a training position, and documents are range-sorted by position.

A source is read in a seeded order, again from its start once it is used up. A document is taken in a pass when
the middle of its token run lies below the source's target, so each source's sum misses the target by half a
document at most.

Defined cases: a null text has no words; a null source is the last source; documents without words are taken in
the passes their place falls in and add nothing; repeated rows are rows of their own; very long texts are counted whole
and are taken whole or not at all; an empty table gives an empty result; the sources themselves are ranked in one task, so they may be many thousands, not as many as hosts; columns not named here are carried by `mix` and ignored by `mix_plan`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import seeded, word_count
from llm.ranks import running

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
BUDGET, REPEATS = 1.5, 2


def source_targets(sizes: DataFrame, weights: Sequence[float], slopes: Sequence[float], budget: float, repeats: int) -> DataFrame:
    """Targets of (source, source_size) rows: weight * level, up to repeats * size, summing to budget * all sizes.

    With sources in order of cap / weight, the level is the greatest of (budget - caps so far) / (weights left).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (F.col("_place") % len(xs) + 1).cast("int"))
    named = sizes.withColumn("_place", F.row_number().over(by_name) - 1)
    named = named.withColumns({"_w": cycle(weights), "slope": cycle(slopes), "_cap": F.col("source_size") * F.lit(float(repeats))})
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_place")
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    return named.withColumn("_level", level).withColumn("target", F.least(F.col("_cap"), F.max("_level").over(everything) * F.col("_w"))).select("source", "target", "slope")


def position(demand: Column, target: Column, slope: Column) -> Column:
    """The time at which the integrated schedule reaches demand: t + slope * (t**2 - t) = demand / target."""
    u = demand / target
    return 2 * u / ((1 - slope) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * u))


def mix_plan(docs: DataFrame, keep: Sequence[str] = (), weights=WEIGHTS, slopes=SLOPES, budget: float = BUDGET, repeats: int = REPEATS, seed: int = 10) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, positions (one for each copy), and keep."""
    rows = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), seeded(seed, F.col("doc_id")).alias("_key"), *keep)

    def with_targets(totals: DataFrame) -> DataFrame:
        sizes = totals.select(F.when(~F.col("_null"), F.col("_g")).alias("source"), F.col("group_value").alias("source_size")).distinct()
        targets = source_targets(sizes, weights, slopes, budget, repeats)
        return totals.join(targets.select(F.coalesce("source", F.lit("")).alias("_g"), F.col("source").isNull().alias("_null"), "target", "slope"), ["_null", "_g"])

    made = running(rows, "source", ["_key", "doc_id", "size"], F.col("size"), with_targets)
    middle = [e * F.col("group_value") + F.col("before") + F.col("size") / 2.0 for e in range(repeats)]
    taken = [m < F.col("target") for m in middle]
    places = F.array_compact(F.array(*[F.when(t, position(m, F.col("target"), F.col("slope"))) for t, m in zip(taken, middle, strict=True)]))
    return made.select("doc_id", "source", "size", F.col("group_value").alias("source_size"), "target", F.size(places).alias("copies"), places.alias("positions"), *keep)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the documents' own columns, one row for each copy taken, range-sorted by training position.

    Positions are found without the texts and joined back by a hash of the row; rows that are alike in all columns are
    numbered, so each has positions of its own. Columns may have any names: those used here are in a struct beside the documents' own.
    """
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select(F.struct(*quoted).alias("row"), F.xxhash64(*quoted).alias("h1"), F.xxhash64(F.lit(7), *quoted).alias("h2"))
    needed = own.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.col("row.text").alias("text"), "h1", "h2")
    alike = Window.partitionBy("h1", "h2")
    plan = mix_plan(needed, keep=["h1", "h2"], **options).select("h1", "h2", "positions")
    plan = plan.withColumn("n", F.row_number().over(alike.orderBy("positions")))
    taken = own.withColumn("n", F.row_number().over(alike.orderBy("h1"))).join(plan, ["h1", "h2", "n"])
    return taken.select("row", F.explode("positions").alias("at")).orderBy("at", "row.doc_id").select("row.*")
