"""Operator 9: shards by proportional stratified interleaving.

Rows are put in a seeded order within their source; a row's fractional rank is (rank + 1/2) / rows of the
source. The global order by fractional rank is cut into equal runs, so every shard holds each source in the
proportion of the whole.

Defined cases: a null source is a source of its own; a null text has no bytes; repeated rows are rows of their
own; an empty table gives an empty result; of a text, however long, only its size and checksum are carried; columns
not named here are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import seeded
from llm.ranks import running

SHARDS = 24


def stratified_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 9) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot: row counts of shards differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        seeded(seed, F.col("doc_id")).alias("key"),
    )
    tie = ["key", "doc_id", "size", "text_crc32"]
    within = running(rows, "source", tie)
    within = within.select(*rows.columns, ((2 * F.col("rank") + 1) / (2 * F.col("group_rows"))).alias("fraction"), F.col("source").isNull().alias("last"), F.md5(F.coalesce("source", F.lit(""))).alias("turn"))
    whole = running(within, None, ["fraction", "last", "turn", *tie])
    n, at = F.col("group_rows"), F.col("rank")
    shard = F.floor(at * shards / n).cast("int")  # exact: both factors stay far below 2**53
    first = F.floor((F.col("shard") * n + shards - 1) / shards)
    return whole.withColumn("shard", shard).withColumn("slot", (at - first).cast("long")).select("doc_id", "source", "size", "text_crc32", "shard", "slot")
