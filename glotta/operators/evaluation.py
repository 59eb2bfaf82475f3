"""Classification report from true and predicted labels, as plain aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classification_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class, then three summary rows.

    The rows are counted once per (label, predicted) pair; everything after works
    on at most classes^2 rows. A ratio with a zero denominator is 0. A row without
    a prediction counts as a miss of its class.
    """
    pairs = (df.filter(F.col(label).isNotNull())
             .groupBy(F.col(label).cast("string").alias("y"), F.col(predicted).cast("string").alias("p"))
             .agg(F.count(F.lit(1)).alias("n")))
    hit = F.when(F.col("y").eqNullSafe(F.col("p")), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), zero.alias("guessed"),
                 hit.cast("bigint").alias("hits")),
        F.struct(F.col("p").alias("label"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("hits")),
    )
    counts = (pairs.select(F.explode(sides).alias("s")).select("s.*").filter(F.col("label").isNotNull())
              .groupBy("label").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
                                    F.sum("hits").alias("hits")))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    classes = (counts.withColumn("precision", ratio(F.col("hits"), F.col("guessed")))
               .withColumn("recall", ratio(F.col("hits"), F.col("support")))
               .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    metrics = ["precision", "recall", "f1"]
    total = F.sum("support").alias("support")
    accuracy = ratio(F.sum("hits"), F.sum("support"))
    rows = classes.select("label", *metrics, "support")
    summary = classes.agg(
        total,
        accuracy.alias("acc"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in metrics],
    )

    def line(name, prefix):
        values = [F.col("acc").alias(m) for m in metrics] if prefix is None else [
            F.col(f"{prefix}_{m}").alias(m) for m in metrics]
        return F.struct(F.lit(name).alias("label"), *values, F.col("support"))

    lines = F.array(line("accuracy", None), line("macro avg", "macro"), line("weighted avg", "weighted"))
    return rows.unionByName(summary.select(F.explode(lines).alias("l")).select("l.*"))
