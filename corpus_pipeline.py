"""The corpus pipeline: quality rules, near-duplicate join, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. The stages' statistics (hashed n-grams, cells, windows, sizes) are of the rows they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import jaccard, mixing, packing, quality, repeats
from llm.common import materialize, partitions, table
from llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the log-likelihood ratio go."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.quality(docs, trusted).where("kept").select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that repeat elsewhere (repeats.PASSAGE bytes and more) leave the texts; whole characters only.

    n_chars follows the text.
    """
    cut = repeats.without_repeats(docs, repeats.PASSAGE, whole_chars=True)
    text = F.when(F.size("spans") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy taken, in the order of training positions."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 4096 tokens, with their ids; sequence_id and offset follow the order of training positions.

    The mix is stored in files whose numbers follow that order, but a reader deals them out by size: so rows go to
    ranges of (file, row) and are sorted there. Longer file names have higher numbers.
    """
    place = [F.length("_metadata.file_name").alias("_digits"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    keys = ["_digits", "_file", "_row"]
    ordered = docs.select("doc_id", "text", *place).repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    return packing.pack(ordered, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Shingle hashing, 400-byte windows over a corpus and a tokenizer are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
