"""The churn model: a seeded split by user, boosted trees that stop early on a validation part, scores, metrics and the gate.

Training is pyspark.ml's: rows stay on executors, and the driver sees histograms of candidate splits and trees only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.operators import quality, silver
from lakeloom.session import stored

SPLITS = ("train", "validation", "test")
#: Of 256 values of a digest's first byte: those below the first mark train, those below the second validate, the rest test.
MARKS = ("b3", "da")


@dataclass(frozen=True)
class Params:
    """Rounds at most; trees; weight of a churned user's row; the loss must fall by `tolerance` on the validation part for a further round."""

    rounds: int = 200
    depth: int = 6
    step: float = 0.3
    least_rows: int = 6
    subsample: float = 0.8
    columns: float = 0.8
    positive_weight: float = 3.0
    tolerance: float = 0.01
    seed: int = 42


@dataclass(frozen=True)
class Gate:
    """A model may be used if its held-out AUC is at least `auc`; `precision` is reported and doesn't decide."""

    auc: float = 0.80
    precision: float = 0.65


def split_of(user: Column, seed: int = 42) -> Column:
    """The part that a user belongs to, whatever else is in the table."""
    byte = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(user, F.lit("")))), 1, 2)
    return F.when(byte < MARKS[0], SPLITS[0]).when(byte < MARKS[1], SPLITS[1]).otherwise(SPLITS[2])


def model_rows(features: DataFrame, user: str = "user_id_hashed", label: str = "churned_30d", columns: Sequence[str] = C.MODEL_FEATURES, seed: int = 42, partitions: int = 8) -> DataFrame:
    """user, split, label, x (the feature columns in their order, preprocessed), written to the shared folder; rows without a label are left out.

    Rows are dealt by user and sorted, so that sampled trees and sums of floats are the same again in every run with as many partitions.
    """
    clean = silver.preprocess(features.where(F.col(label).isNotNull()).select(user, F.col(label).cast("int").alias("label"), *columns))
    x = VectorAssembler(inputCols=list(columns), outputCol="x").transform(clean)
    made = x.select(user, split_of(F.col(user), seed).alias("split"), F.col("label").cast("double").alias("label"), "x")
    return stored(made.repartition(partitions, user).sortWithinPartitions(user), "model-rows")


def train(rows: DataFrame, params: Params = Params()) -> GBTClassificationModel:  # noqa: B008
    """Trees fitted on the train part; a round that doesn't help the validation part is the last. Neither sees the test part."""
    weighed = rows.where("split <> 'test'").withColumns({"held": F.col("split") == "validation", "weight": F.when(F.col("label") == 1, params.positive_weight).otherwise(1.0)})
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", weightCol="weight", validationIndicatorCol="held", validationTol=params.tolerance, maxIter=params.rounds, maxDepth=params.depth,
        stepSize=params.step, minInstancesPerNode=params.least_rows, subsamplingRate=params.subsample, featureSubsetStrategy=str(params.columns), seed=params.seed,
    )
    return trees.fit(weighed)


def score(rows: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """rows with s, the probability of churn."""
    return model.transform(rows).withColumn("s", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def report(scored: DataFrame, model: GBTClassificationModel, gate: Gate = Gate()) -> DataFrame:  # noqa: B008
    """One row for each part: users, churned, rounds, metrics (as `quality.classifier_metrics`), and whether the model passes the gate there.

    The verdict that counts is the test part's. A part with one class only has no AUC and doesn't pass.
    """
    kept = stored(scored.select("split", "s", F.col("label").cast("int").alias("y")), "model-scores")
    parts = []
    for name in SPLITS:
        own = kept.where(F.col("split") == name)
        counts = own.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.sum("y"), F.lit(0)).alias("churned"))
        parts.append(counts.select(F.lit(name).alias("split"), "*", F.lit(model.getNumTrees).alias("rounds")).join(quality.classifier_metrics(own)))  # one row each
    passed = F.coalesce(F.col("auc") >= gate.auc, F.lit(False))
    return reduce(DataFrame.unionByName, parts).withColumns({"passed": passed, "precise": F.coalesce(F.col("precision_at_half") >= gate.precision, F.lit(False))})


def save(model: GBTClassificationModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(spark: SparkSession, path: str) -> GBTClassificationModel:
    return GBTClassificationModel.read().session(spark).load(path)
