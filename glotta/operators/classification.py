"""Document classification with MLlib on document vectors."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta import SEED
from glotta.operators.boosting import BoostedClassifier, class_probabilities, train_boosted
from glotta.operators.ranking import first_by_hash
from glotta.operators.vectors import to_features

# The training settings.
TREE_DEPTH = 2
TREE_STEP = 1.0
TREE_ROUNDS = 20
TEST_SHARE = 0.1

SOFTMAX_ITERATIONS = 50
SOFTMAX_PENALTY = 1e-4


def class_indexer(df: DataFrame, label: str = "context", out: str = "context_categorical"):
    """A fitted label encoder: codes follow the sorted labels."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(df)


def encode_classes(df: DataFrame, label: str = "context", out: str = "context_categorical") -> DataFrame:
    """Append the integer class code; rows without a label are dropped."""
    labelled = df.filter(F.col(label).isNotNull())
    return class_indexer(labelled, label, out).transform(labelled).withColumn(out, F.col(out).cast("int"))


def decode_classes(df: DataFrame, labels: list[str], code: str = "prediction", out: str = "class_") -> DataFrame:
    return IndexToString(inputCol=code, outputCol=out, labels=labels).transform(df)


def holdout_split(df: DataFrame, keys: list[str], test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Append ``is_test``: true for exactly ``ceil(test_share * n)`` rows, chosen by key hash."""
    flagged = first_by_hash(df, keys, seed, F.ceil(F.col("n") * F.lit(test_share)))
    return flagged.withColumnRenamed("selected", "is_test")


def content_split(df: DataFrame, column: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Append ``is_test`` for about ``test_share`` of the values of ``column``: equal values are never on both sides."""
    part = F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1_000_000))
    return df.withColumn("is_test", part < F.lit(round(test_share * 1_000_000)))


@dataclass(frozen=True)
class TrainedClassifier:
    """The fitted pipeline (classifier, label decoder) and its labels in code order."""

    pipeline: PipelineModel
    labels: list[str]


def train_classifier(train: DataFrame, label: str = "context", vectors: str = "document_embeddings",
                     method: str = "softmax", seed: int = SEED, rounds: int | None = None,
                     test: DataFrame | None = None) -> TrainedClassifier | BoostedClassifier:
    """Fit a multi-class model on ``vectors``.

    ``softmax``: multinomial logistic regression, one joint softmax over the
    classes. ``boosted``: trees of depth 2, step 1, 20 rounds under one joint
    softmax; the losses of ``test`` are kept too. ``trees``: the same settings
    one-vs-rest. For the MLlib models the training data is cached for the fit.
    """
    labelled = train.filter(F.col(label).isNotNull())
    indexer = class_indexer(labelled, label, "_code")
    if method == "boosted":
        return train_boosted(labelled, list(indexer.labels), label, vectors, test, rounds or TREE_ROUNDS, TREE_DEPTH,
                             TREE_STEP)
    prepared = to_features(indexer.transform(labelled), vectors).select("features", F.col("_code").alias("label"))
    prepared = prepared.persist()
    try:
        if method == "softmax":
            estimator = LogisticRegression(family="multinomial", maxIter=rounds or SOFTMAX_ITERATIONS,
                                           regParam=SOFTMAX_PENALTY)
        elif method == "trees":
            estimator = OneVsRest(classifier=GBTClassifier(
                maxDepth=TREE_DEPTH, maxIter=rounds or TREE_ROUNDS, stepSize=TREE_STEP, seed=seed))
        else:
            raise ValueError(f"unknown method {method!r}")
        model = estimator.fit(prepared)
    finally:
        prepared.unpersist()
    labels = list(indexer.labels)
    decoder = IndexToString(inputCol="prediction", outputCol="class_", labels=labels)
    return TrainedClassifier(PipelineModel([model, decoder]), labels)


def _class_probability(scored: DataFrame) -> Column:
    """The probability of the predicted class.

    One-vs-rest models have no joint probability; theirs is a softmax over the
    raw scores, which orders the classes the same way but is not calibrated.
    """
    if "probability" in scored.columns:
        return F.array_max(vector_to_array("probability"))
    raw = vector_to_array("rawPrediction")
    top = F.array_max(raw)
    return F.lit(1.0) / F.aggregate(raw, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))


def predict_class(df: DataFrame, model: TrainedClassifier | PipelineModel | BoostedClassifier, keep: list[str],
                  vectors: str = "document_embeddings") -> DataFrame:
    """``keep`` plus ``class_`` and ``probability`` of the most probable class, of equal ones the first."""
    if isinstance(model, BoostedClassifier):
        scored = df.select(*keep, class_probabilities(model, F.col(vectors)).alias("_p"))
        top = F.array_max("_p")
        return scored.select(*keep, F.get(F.lit(model.labels), F.array_position("_p", top).cast("int") - 1).alias("class_"),
                             top.alias("probability"))
    pipeline = model.pipeline if isinstance(model, TrainedClassifier) else model
    scored = pipeline.transform(to_features(df, vectors))
    return scored.select(*keep, "class_", _class_probability(scored).alias("probability"))


def training_curve(model: TrainedClassifier | BoostedClassifier, train: DataFrame, test: DataFrame,
                   label: str = "context", vectors: str = "document_embeddings") -> DataFrame:
    """``(class_, round, dataset, loss)`` after each boosting round of a tree model.

    For a joint model: its log-loss over all classes (NULL class) as noted while
    it was trained. For a softmax model: the training objective per iteration,
    with a NULL class (the test objective is not kept by the optimizer).
    """
    spark = train.sparkSession
    schema = "class_ string, round int, dataset string, loss double"
    if isinstance(model, BoostedClassifier):
        return spark.createDataFrame([(None, r, name, loss) for r, name, loss in model.losses], schema)
    fitted = model.pipeline.stages[0]
    if not isinstance(fitted, OneVsRestModel):
        history = fitted.summary.objectiveHistory if fitted.hasSummary else []
        return spark.createDataFrame([(None, i, "train", float(v)) for i, v in enumerate(history)], schema)
    rows = []
    for name, data in (("train", train), ("test", test)):
        features = to_features(data.filter(F.col(label).isNotNull()), vectors).select("features", label).persist()
        try:
            for code, one in enumerate(fitted.models):
                binary = features.withColumn(one.getLabelCol(), (F.col(label) == model.labels[code]).cast("double"))
                for i, loss in enumerate(one.evaluateEachIteration(binary)):
                    rows.append((model.labels[code], i + 1, name, None if math.isnan(loss) else float(loss)))
        finally:
            features.unpersist()
    return spark.createDataFrame(rows, schema)
