"""Operator 2: quality rules. Native DataFrame operations only.

Base rules count words, symbols, repeated lines and repeated 5-word windows of the whole text. The method's verdict
is a hashed n-gram log-likelihood ratio: unigrams and bigrams fall into buckets, two multinomials are fitted over all
documents (one over the trusted ones, one over the raw corpus), and a document is kept when the mean log ratio of its
n-grams reaches a fixed threshold.

The number of buckets follows the corpus, a power of two with about BYTES_PER_BUCKET bytes of text each, so that a bucket
holds as many n-grams in a large corpus as in a small one and ratios don't fade as it grows. The ratios stay a table: up to
BROADCAST_BUCKETS of them are broadcast to where n-grams are, beyond it n-grams are counted by document and bucket and
both are shuffled. The results are the same.

A verdict is one of the text, so it is made once for equal texts and joined back by two numbers of the text (a 64-bit
hash and its length). Copies are summed where they are read; no group of copies meets in one task.

Defined cases: null or blank text has no words, fails the base rules and has ratio 0; without a trusted document every
ratio is 0; repeated rows are judged alike, each on its own row; a document whose id is trusted in any label row is
trusted; an empty table gives an empty result; very long texts are split whole, one row at a time; other columns pass
through, whatever their names, but for those named like the new ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import materialize, small_side

BYTES_PER_BUCKET, LEAST_BUCKETS = 1 << 14, 1 << 14
BROADCAST_BUCKETS = 1 << 22
THRESHOLD = -0.1
SMOOTH = 0.5
MIN_WORDS, MAX_REPEAT = 10, 20
_SPACES = "\t\n\x0b\x0c\r"
_WORD, _SYMBOLS = r"[^\x20\x09-\x0D]", r"[#*$%&|<>]"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def split_words(df: DataFrame) -> DataFrame:
    """Add _text, _words, _h (the words' 64-bit hashes) and _b (the bigrams')."""
    flat = F.col("_text")
    for c in _SPACES:
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    df = df.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_words", F.array_remove(F.split(flat, " "), ""))
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    return df.withColumn("_b", _pairs(F.col("_h"), F.col("_h"), 1, F.size("_h") - 1))


def _pairs(a: Column, b: Column, ahead: int, n: Column) -> Column:
    """Hashes of (a[i], b[i + ahead]) for i < n."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, ahead + 1, n), lambda x, y: F.xxhash64(x, y))


def buckets_for(docs: DataFrame) -> int:
    """A power of two that grows with the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, 1 << max(0, -(-size // BYTES_PER_BUCKET) - 1).bit_length())


def _bucket(x: Column, buckets: int) -> Column:
    return F.pmod(x, F.lit(buckets).cast("long"))


def fit_ratio(docs: DataFrame, trusted_ids: DataFrame, buckets: int, smooth: float = SMOOTH) -> DataFrame:
    """(bucket, ratio): log(p_trusted / p_raw) of every bucket that an n-gram of docs falls into."""
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("_trusted", F.lit(1))
    marked = docs.select("doc_id", "text").join(small_side(ids), "doc_id", "left")
    grams = split_words(marked).select(F.explode(F.concat("_h", "_b")).alias("g"), "_trusted").select(_bucket(F.col("g"), buckets).alias("bucket"), "_trusted")
    counts = materialize(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted")), "buckets")
    n = counts.agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).first()
    if not n.trusted:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    part = lambda c, total: F.log((F.col(c) + smooth) / (total + smooth * buckets))
    return counts.select("bucket", (part("trusted", n.trusted) - part("raw", n.raw)).alias("ratio"))


def base_counts(df: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, from _text, _words, _h and _b."""
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(_WORD))
    n = F.size("_h")
    four = _pairs(F.col("_b"), F.col("_b"), 2, n - 3)
    windows = _pairs(four, F.col("_h"), 4, n - 4)
    df = df.withColumns({"_lines": lines, "_win": windows})
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    placed = F.when(repeats, F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_placed", placed)
    at = lambda k: F.get(F.col("_placed"), k)["h"]
    again = F.filter("_placed", lambda x, k: F.coalesce(at(k - 1) == x["h"], F.lit(False)) | F.coalesce(at(k + 1) == x["h"], F.lit(False)))
    df = df.withColumn("_again", F.when(F.col("_placed").isNotNull(), F.array_sort(F.transform(again, lambda x: x["i"]))))
    # a window covers five words, or as many as come before the next repeated window
    cover = F.aggregate(
        F.zip_with("_again", F.slice(F.col("_again"), 2, F.size("_again")), lambda a, b: F.coalesce(F.least(b - a, F.lit(5)), F.lit(5))),
        F.lit(0), lambda s, x: s + x,
    )
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(_SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.size("_again") > 0, cover), F.lit(0)).cast("long"),
    })


def _key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("_k"), F.octet_length(text).alias("_n")]


def verdicts(docs: DataFrame, ratio: DataFrame, buckets: int, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each different text: its key, the base counts, llr (mean log ratio), base_failed and kept."""
    worded = split_words(docs.select("text", *_key()))
    grams = F.explode_outer(F.concat("_h", "_b"))
    key = ["_k", "_n"]
    highest = [F.max(c).alias(c) for c in _COUNTS]  # equal for equal texts
    mean = F.round(F.coalesce(F.avg("ratio"), F.lit(0.0)), 10).alias("llr")
    if buckets <= BROADCAST_BUCKETS:
        placed = base_counts(worded).select(*key, *_COUNTS, grams.alias("g")).withColumn("bucket", _bucket(F.col("g"), buckets))
        made = placed.join(F.broadcast(ratio), "bucket", "left").groupBy(*key).agg(*highest, mean)
    else:
        counted = worded.select(*key, grams.alias("g")).groupBy(*key, _bucket(F.col("g"), buckets).alias("bucket")).agg(F.count("g").alias("times"))
        weighed = (F.sum(F.col("times") * F.col("ratio")) / F.sum("times")).alias("ratio")
        llr = counted.join(ratio, "bucket", "left").groupBy(*key).agg(weighed).select(*key, F.round(F.coalesce("ratio", F.lit(0.0)), 10).alias("llr"))
        made = base_counts(worded).groupBy(*key).agg(*highest).join(llr, key)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return made.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= threshold))


def quality(docs: DataFrame, trusted_ids: DataFrame, buckets: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with the base counts, llr, base_failed and kept, in place of columns so named."""
    buckets = buckets or buckets_for(docs)
    made = materialize(verdicts(docs, fit_ratio(docs, trusted_ids, buckets), buckets, threshold), "verdicts")
    new = [*_COUNTS, "llr", "base_failed", "kept"]
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    names = ["_k", "_n"]
    while set(names) & set(docs.columns):
        names = [f"_{n}" for n in names]
    made = made.withColumnsRenamed(dict(zip(["_k", "_n"], names, strict=True)))
    keyed = docs.select(*carried, *[c.alias(n) for c, n in zip(_key(), names, strict=True)])
    return keyed.join(small_side(made), names).select(*carried, *new)
