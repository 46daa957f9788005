"""Small Spark helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a local master, where one machine is the whole cluster, may go without the setting.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lakeloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write the rows as a Parquet table in the shared folder and read them back."""
    return df.sparkSession.read.schema(df.schema).parquet(_written(df, name))


def _written(df: DataFrame, name: str) -> str:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


class Scratch:
    """Tables for the length of a `with` block: materialised inside it and deleted when it ends without an error.

    What leaves the block has to be materialised by then, so that a lost executor's work is redone from tables that exist.
    """

    def __enter__(self) -> Scratch:
        self.made: list[tuple[SparkSession, str]] = []
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = _written(df, name)
        self.made.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def __exit__(self, kind: type | None, *_: object) -> None:
        for spark, path in self.made if kind is None else []:
            found = spark._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def small_batches(spark: SparkSession) -> None:
    """Texts are long: Arrow batches of 1000 rows instead of Spark's 10,000, unless the session has a number of its own.

    This sets the session's configuration, since a batch's size is read when a lazy result is run; it stays set.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def seeded(seed: int, *cols: Column) -> Column:
    """A seeded shuffle key that any SQL engine can repeat: md5 over `seed:id`."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def small_side(ids: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """ids marked for broadcast when they have up to `limit` rows (counted here), else unmarked, for a shuffle join."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def join_shared(rows: DataFrame, keys: DataFrame, on: list[str], limit: int = 1_000_000, hottest: int = 10_000, salts: int = 64) -> DataFrame:
    """rows joined to keys (distinct `on`, and n: how many rows have the key) without one task for a key that many rows share.

    Up to `limit` keys are broadcast (counted here). Beyond it the `hottest` keys by n, a broadcast of that size, are dealt
    to `salts` tasks each, so that no task has more than its share of them; the others meet in a shuffle.
    """
    if keys.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(keys), on)
    hot = F.broadcast(keys.orderBy(F.desc("n"), *on).limit(hottest).select(*on, F.lit(True).alias("_hot")))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = keys.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    own = F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    return rows.join(hot, on, "left").withColumn("_salt", own).drop("_hot").join(spread, [*on, "_salt"]).drop("_salt")


#: Rows of either side of a bucket that one task compares with each other.
PAIR_BLOCK = 1000


def in_blocks(outside: DataFrame, inside: DataFrame, name: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Both sides of a bucket's comparison dealt to a grid: rows meet where their _i and _j are equal, each two of them once.

    Both have `rows_out` and `rows_in`, the sizes of their bucket's sides. A bucket of any size is compared in blocks of
    about PAIR_BLOCK by PAIR_BLOCK rows, so no task has more than one block of it; small buckets are one block.
    """
    cut = lambda c: F.ceil(F.col(c) / PAIR_BLOCK).cast("int")
    place = lambda c: F.pmod(F.xxhash64(F.col(name)), cut(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), cut(c) - 1))
    return outside.withColumn("_i", place("rows_out")).withColumn("_j", every("rows_in")), inside.withColumn("_j", place("rows_in")).withColumn("_i", every("rows_out"))


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs joined to a table of distinct doc_id: by broadcast if it is small, else by a shuffle."""
    return docs.join(small_side(ids), "doc_id")
