"""How far topics lie from each other, and a map of them.

The divergence of all pairs of topics comes from one pass over the words: a word
is a row with its probability in each topic, every task adds up its words into
one k x k matrix, and only these matrices are shuffled. The map is drawn from
the k x k result, whose size is bounded by ``MAX_TOPICS`` and not by the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.operators.word_topics import MAX_TOPICS

#: Cells of the words x topics blocks that a task compares at a time.
CELLS = 1 << 20


def _names(weights: DataFrame, kind: str) -> list:
    """The topics in order; more than the bound are an error, never a cut."""
    found = [r[0] for r in weights.select("topic").distinct().limit(MAX_TOPICS + 1).collect()]
    if len(found) > MAX_TOPICS:
        raise ValueError(f"more than {MAX_TOPICS} topics in a column of {kind}")
    return sorted(found)


def pair_divergences(p: np.ndarray) -> np.ndarray:
    """The share of the words ``p`` (a row each) in the divergence of each pair of topics, in nats."""
    k = p.shape[1]
    out = np.zeros((k, k))
    rows = max(1, CELLS // max(1, k))
    with np.errstate(divide="ignore", invalid="ignore"):
        for first in range(0, len(p), rows):
            part = p[first:first + rows]
            for i in range(k - 1):
                a, b = part[:, i:i + 1], part[:, i + 1:]
                both = a + b
                left = np.where(a > 0, a * np.log(2 * a / both), 0.0)
                right = np.where(b > 0, b * np.log(2 * b / both), 0.0)
                out[i, i + 1:] += (left + right).sum(axis=0) / 2
    return out


def topic_distances(weights: DataFrame) -> DataFrame:
    """``(topic, other, divergence)``: the Jensen-Shannon divergence (nats) of each pair ``topic < other``.

    Input ``(topic, word, weight)``, normalised per topic here; repeated rows are
    added up, rows with a null or without a positive weight are left out, and a
    topic without any is not listed. 0 for equal topics, ln 2 for topics without
    a common word. At most ``MAX_TOPICS`` topics.
    """
    spark, kind = weights.sparkSession, weights.schema["topic"].dataType
    used = weights.filter((F.col("weight") > 0) & F.col("topic").isNotNull() & F.col("word").isNotNull())
    names = _names(used, kind.simpleString())
    k = len(names)
    pairs = spark.createDataFrame([(i * k + j, names[i], names[j]) for i in range(k) for j in range(i + 1, k)],
                                  f"_cell int, topic {kind.simpleString()}, other {kind.simpleString()}")
    if k < 2:
        return pairs.select("topic", "other", F.lit(0.0).alias("divergence"))
    totals = {r["topic"]: r["t"] for r in used.groupBy("topic").agg(F.sum("weight").cast("double").alias("t")).collect()}
    place = F.array_position(F.lit(names).cast(f"array<{kind.simpleString()}>"), F.col("topic")) - 1
    share = F.col("weight").cast("double") / F.get(F.lit([totals[n] for n in names]), place.cast("int"))
    # A word holds one cell per topic at most, so the list is bounded by the topics.
    cells = used.groupBy("word", "topic").agg(F.sum("weight").alias("weight")).select(
        "word", F.struct(place.cast("int").alias("at"), share.alias("p")).alias("cell"))
    words = cells.groupBy("word").agg(F.collect_list("cell").alias("cells")).select("cells")

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten()
            p = np.zeros((batch.num_rows, k))
            rows = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
            p[rows, flat.field(0).to_numpy(zero_copy_only=False)] = flat.field(1).to_numpy(zero_copy_only=False)
            total += pair_divergences(p)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], names=["_cell", "part"])

    summed = words.mapInArrow(run, "_cell int, part double").groupBy("_cell").agg(F.sum("part").alias("_sum"))
    divergence = F.least(F.coalesce("_sum", F.lit(0.0)), F.lit(math.log(2)))
    return pairs.join(summed, "_cell", "left").select("topic", "other", divergence.alias("divergence"))


def principal_coordinates(squares: np.ndarray, dimensions: int) -> np.ndarray:
    """Points whose squared distances are nearest to the given ones, best axis first.

    An axis points so that its largest entry is positive; axes that the
    distances do not need are 0.
    """
    k = len(squares)
    centre = np.eye(k) - 1 / max(1, k)
    values, vectors = np.linalg.eigh(-centre @ squares @ centre / 2)
    order = np.argsort(-values, kind="stable")[:dimensions]
    points = np.zeros((k, dimensions))
    for axis, i in enumerate(order):
        own = vectors[:, i] * math.sqrt(max(0.0, float(values[i])))
        # Rounded for the choice, so that equal entries of opposite signs do not depend on the last bit.
        points[:, axis] = own * (-1 if own[np.argmax(np.abs(own).round(9))] < 0 else 1)
    return points


def topic_layout(weights: DataFrame, dimensions: int = 2) -> DataFrame:
    """``(topic, share, coordinates)``: each topic's share of all weight and its place on the map.

    The square root of the divergence is a metric and needs no more than k - 1
    axes, so with that many the places reproduce every divergence as a squared
    distance; with fewer they are the best by principal coordinates.
    """
    spark, kind = weights.sparkSession, weights.schema["topic"].dataType.simpleString()
    used = weights.filter((F.col("weight") > 0) & F.col("topic").isNotNull() & F.col("word").isNotNull())
    totals = {r["topic"]: r["t"] for r in used.groupBy("topic").agg(F.sum("weight").cast("double").alias("t")).collect()}
    if len(totals) > MAX_TOPICS:
        raise ValueError(f"more than {MAX_TOPICS} topics")
    names = sorted(totals)
    place = {name: i for i, name in enumerate(names)}
    squares = np.zeros((len(names), len(names)))
    for topic, other, divergence in topic_distances(weights).collect():  # k * (k - 1) / 2 rows
        squares[place[topic], place[other]] = squares[place[other], place[topic]] = divergence
    points = principal_coordinates(squares, dimensions) if names else []
    whole = sum(totals.values())
    return spark.createDataFrame([(n, totals[n] / whole, [float(x) for x in points[i]]) for i, n in enumerate(names)],
                                 f"topic {kind}, share double, coordinates array<double>")
