"""Calibrated probabilities: isotonic regression over binned scores of held-out rows.

Scores fall into SCORE_BINS bins of equal width; the counts of each bin are all
that leaves Spark, ``classes * SCORE_BINS`` rows whatever the number of
documents. Pooling adjacent violators gives the non-decreasing rates that fit
best; between the mean scores of the pooled bins a rate is interpolated, so a
higher score never gets a lower probability.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.operators.boosting import BoostedClassifier, class_probabilities
from glotta.operators.classification import TrainedClassifier, predict_class
from glotta.operators.vectors import to_features

SCORE_BINS = 256
FIXED = 1 << 30  # scores are summed as whole multiples of 1 / FIXED

Model = TrainedClassifier | PipelineModel | BoostedClassifier


@dataclass(frozen=True)
class CalibratedClassifier:
    """A model and, for each of its labels, the points ``(score, probability)`` of a non-decreasing line."""

    model: Model
    labels: list[str]
    curves: list[list[tuple[float, float]]]


def pooled(counts: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """``(sum of scores, n, positives)`` in ascending order, adjacent blocks pooled until their rates do not fall."""
    out: list[tuple[float, int, int]] = []
    for block in counts:
        out.append(block)
        while len(out) > 1 and out[-2][2] * out[-1][1] >= out[-1][2] * out[-2][1]:
            last = out.pop()
            out[-1] = tuple(a + b for a, b in zip(out[-1], last))
    return out


def score_counts(scored: DataFrame, keys: list[str], score: str, positive: Column, bins: int = SCORE_BINS) -> DataFrame:
    """``keys, bin, total, n, positives``: how many rows of each score bin are positive; ``total`` is FIXED times their scores."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.filter(F.col(score).isNotNull()).groupBy(*keys, place.alias("bin")).agg(
        F.sum(F.round(F.col(score) * FIXED).cast("long")).alias("total"), F.count(F.lit(1)).alias("n"),
        F.sum(F.when(positive, 1).otherwise(0)).alias("positives"))


def isotonic(counts: DataFrame) -> DataFrame:
    """``counts`` (bin, total, n, positives) with the fitted ``rate`` of each bin.

    A bin's rate is the greatest, over the bins up to it, of the least mean that
    begins there and reaches it: the same as pooling, as one join of at most
    SCORE_BINS rows with itself.
    """
    ends = counts.select(F.col("bin").alias("end"))
    starts = counts.select(F.col("bin").alias("start"))
    inside = counts.select("bin", "n", "positives")
    means = (F.broadcast(starts).join(ends, F.col("start") <= F.col("end"))
             .join(F.broadcast(inside), F.col("bin").between(F.col("start"), F.col("end")))
             .groupBy("start", "end").agg((F.sum("positives") / F.sum("n")).alias("mean")))
    least = (counts.select("bin").join(F.broadcast(means), F.col("bin").between(F.col("start"), F.col("end")))
             .groupBy("bin", "start").agg(F.min("mean").alias("least")))
    return counts.join(least.groupBy("bin").agg(F.max("least").alias("rate")), "bin")


def model_labels(model: Model) -> list[str]:
    if isinstance(model, PipelineModel):
        return list(model.stages[-1].getLabels())
    return list(model.labels)


def all_probabilities(df: DataFrame, model: Model, keep: list[str], vectors: str = "document_embeddings") -> DataFrame:
    """``keep`` plus ``probabilities`` of all classes in the order of the labels; null without a vector.

    Raw scores of one-vs-rest models go through a softmax.
    """
    known = df.filter(F.col(vectors).isNotNull())
    if isinstance(model, BoostedClassifier):
        return known.select(*keep, class_probabilities(model, F.col(vectors)).alias("probabilities"))
    pipeline = model.pipeline if isinstance(model, TrainedClassifier) else model
    scored = pipeline.transform(to_features(known, vectors))
    if "probability" in scored.columns:
        return scored.select(*keep, vector_to_array("probability").alias("probabilities"))
    raw = vector_to_array("rawPrediction")
    grown = scored.select(*keep, F.transform(raw, lambda x: F.exp(x - F.array_max(raw))).alias("_e"))
    total = F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x)
    return grown.select(*keep, F.transform("_e", lambda x: x / total).alias("probabilities"))


def calibrate(model: Model, heldout: DataFrame, label: str = "context",
              vectors: str = "document_embeddings") -> CalibratedClassifier:
    """Fit one line per class on rows that the model was not trained on; rows without a label do not count.

    A class without a held-out row keeps its scores.
    """
    labels = model_labels(model)
    rows = all_probabilities(heldout.filter(F.col(label).isNotNull()), model, [label], vectors)
    each = rows.select(F.col(label).cast("string").alias("_label"), F.posexplode("probabilities").alias("code", "score"))
    counts = score_counts(each, ["code"], "score", F.col("_label") == F.get(F.lit(labels), F.col("code")))
    found: dict[int, list] = {}
    for r in sorted(counts.collect(), key=lambda r: (r["code"], r["bin"])):
        found.setdefault(r["code"], []).append((r["total"] / FIXED, r["n"], r["positives"]))
    curves = []
    for code in range(len(labels)):
        blocks = pooled(found.get(code, []))
        seen = sum(b[2] for b in blocks)
        curves.append([(total / n, positives / n) for total, n, positives in blocks] if seen else [(0.0, 0.0), (1.0, 1.0)])
    return CalibratedClassifier(model, labels, curves)


def calibrated(model: CalibratedClassifier, class_: Column, score: Column) -> Column:
    """The probability that the line of ``class_`` gives ``score``; constant beyond its first and last point."""
    lines = F.array(*[F.struct(F.lit([float(x) for x, _ in c]).alias("x"), F.lit([float(y) for _, y in c]).alias("y"))
                      for c in model.curves])
    line = F.get(lines, F.array_position(F.lit(model.labels), class_).cast("int") - 1)
    below = F.size(F.filter(line["x"], lambda x: x <= score))
    x0, x1 = F.get(line["x"], below - 1), F.get(line["x"], below)
    y0, y1 = F.get(line["y"], below - 1), F.get(line["y"], below)
    between = F.when(x0.isNull(), y1).when(x1.isNull(), y0).otherwise(
        y0 + (y1 - y0) * F.try_divide(score - x0, x1 - x0))
    return F.when(score.isNotNull(), between)


def predict_calibrated(df: DataFrame, model: CalibratedClassifier, keep: list[str],
                       vectors: str = "document_embeddings") -> DataFrame:
    """``keep`` plus the class that the model predicts, its ``score`` there and its calibrated ``probability``."""
    scored = predict_class(df, model.model, keep, vectors).withColumnRenamed("probability", "score")
    return scored.withColumn("probability", calibrated(model, F.col("class_"), F.col("score")))


def reliability(df: DataFrame, model: CalibratedClassifier, label: str = "context", vectors: str = "document_embeddings",
                bins: int = 10) -> DataFrame:
    """``(class_, bin, n, mean_score, mean_probability, rate)``: how often rows of each probability are of the class."""
    rows = all_probabilities(df.filter(F.col(label).isNotNull()), model.model, [label], vectors)
    each = rows.select(F.col(label).cast("string").alias("_label"), F.posexplode("probabilities").alias("code", "score"))
    each = each.select("_label", "score", F.get(F.lit(model.labels), F.col("code")).alias("class_"))
    each = each.withColumn("p", calibrated(model, F.col("class_"), F.col("score")))
    place = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int")
    return each.groupBy("class_", place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"),
        F.round(F.avg("p"), 6).alias("mean_probability"),
        F.round(F.avg((F.col("_label") == F.col("class_")).cast("double")), 6).alias("rate"))
