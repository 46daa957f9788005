"""Merges as pure functions of (current rows, new rows): upserts, soft deletes and versioned history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(current: DataFrame, new: DataFrame, keys: Sequence[str], update_if: Column | None = None) -> DataFrame:
    """Full outer join on the keys (null keys match each other); a matched row is replaced when update_if holds.

    `new` has one row per key. update_if refers to cur.* and new.*; without it every match is replaced.
    """
    c, n = current.withColumn("_c", F.lit(True)).alias("cur"), new.withColumn("_n", F.lit(True)).alias("new")
    on = [F.col(f"cur.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    take = F.col("new._n").isNotNull() & (F.col("cur._c").isNull() | (F.lit(True) if update_if is None else F.coalesce(update_if, F.lit(False))))
    cols = [F.when(take, F.col(f"new.{x}") if x in new.columns else F.lit(None)).otherwise(F.col(f"cur.{x}")).alias(x) for x in current.columns]
    return c.join(n, on, "full").select(*cols)


def soft_delete(catalog: DataFrame, feed: DataFrame, key: str = "sku", flag: str = "is_active") -> DataFrame:
    """Rows whose key the feed lacks become inactive; null keys in the feed change nothing."""
    there = feed.select(F.col(key).alias("_k")).where("_k is not null").distinct().withColumn("_in", F.lit(True))
    return catalog.join(there, F.col(key) == F.col("_k"), "left").withColumn(flag, F.col(flag) & F.col("_in").isNotNull()).drop("_k", "_in")


def scd2(history: DataFrame, changes: DataFrame, key: str = "order_id", order: str = "cdc_lsn", at: str = "changed_at", op: str = "cdc_op", keep_all: bool = False) -> DataFrame:
    """History with the changes applied: one current version per key, closed versions before it.

    history has the columns of changes but op, and effective_from, effective_to, is_current, record_version, prev_status. Changes at or
    before the current row's order are stale and ignored. A delete adds a closing version with status `deleted`. The last
    change of a key counts, or with keep_all each of them. All versions of touched keys are laid out anew in one pass.
    """
    last = Window.partitionBy(key).orderBy(F.desc(order))
    if not keep_all:
        changes = changes.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")
    changes = changes.withColumn("status", F.when(F.col(op) == "d", "deleted").otherwise(F.col("status")))
    seen = history.groupBy(key).agg(F.max(order).alias("_seen"), F.max("record_version").alias("_version"))
    fresh = changes.join(seen, key, "left").where(F.col("_seen").isNull() | (F.col(order) > F.col("_seen")))
    step = Window.partitionBy(key).orderBy(order)
    body = [c for c in history.columns if c not in ("effective_from", "effective_to", "is_current", "record_version", "prev_status")]
    added = fresh.select(*body, F.col(at).alias("effective_from"), (F.coalesce("_version", F.lit(0)) + F.row_number().over(step)).cast("int").alias("record_version"))
    old = history.select(*body, "effective_from", F.col("effective_to").alias("_to"), "record_version", F.col("prev_status").alias("_prev"))
    every = old.unionByName(added.withColumns({"_to": F.lit(None).cast(history.schema["effective_to"].dataType), "_prev": F.lit(None).cast("string")}))
    line = Window.partitionBy(key).orderBy("record_version")
    made = every.withColumns({
        "effective_to": F.coalesce("_to", F.lead("effective_from").over(line)), "is_current": F.lead("record_version").over(line).isNull(),
        "prev_status": F.coalesce("_prev", F.lag("status").over(line)),
    })
    return made.select(*history.columns)


def scd2_apply(current: DataFrame, new: DataFrame, key: str, tracked: Sequence[str], as_of: Column) -> DataFrame:
    """Check-strategy snapshot: a version is closed and a new one opened where any tracked column differs."""
    now = current.where("is_current").alias("cur")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"cur.{c}").eqNullSafe(F.col(f"new.{c}"))
    met = now.join(new.alias("new"), F.col(f"cur.{key}") == F.col(f"new.{key}"), "right").where(F.col(f"cur.{key}").isNull() | differs)
    opened = met.select(F.col(f"new.{key}").alias(key), *[F.col(f"new.{c}").alias(c) for c in tracked], as_of.alias("effective_from"), F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"))
    changed = met.where(F.col(f"cur.{key}").isNotNull()).select(F.col(f"cur.{key}").alias("_k"), F.lit(True).alias("_hit")).distinct()
    kept = current.join(changed, F.col(key) == F.col("_k"), "left")
    hit = F.col("_hit").isNotNull() & F.col("is_current")
    closed = kept.withColumns({"effective_to": F.when(hit, as_of).otherwise(F.col("effective_to")), "is_current": F.col("is_current") & ~hit}).select(*opened.columns)
    return closed.unionByName(opened)
