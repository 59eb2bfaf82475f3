import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glotta.operators import boosting as bo
from glotta.operators import classification as cl
from glotta.plans import registry


def brute(x, y, classes, edges, rounds, depth=2, step=1.0, test=None):
    """Plain joint boosting: one node at a time, one feature at a time. Returns margins and losses of both sets."""
    sets = [(x, y)] + ([test] if test else [])
    margins = [np.zeros((len(a), classes)) for a, _ in sets]
    curve = []

    def split(g, h, rows):
        best = (bo.LEAST_GAIN, None, None)
        total = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for j in range(x.shape[1]):
            for t in edges[j]:
                left = rows[x[rows, j] < t]
                right = rows[~(x[rows, j] < t)]
                hl, hr = h[left].sum(), h[right].sum()
                if hl >= 1 and hr >= 1:
                    gain = g[left].sum() ** 2 / (hl + 1) + g[right].sum() ** 2 / (hr + 1) - total
                    if gain > best[0] + 1e-7:
                        best = (gain, j, t)
        return best[1:]

    def grow(g, h, rows, level):
        j, t = split(g, h, rows) if level < depth else (None, None)
        if j is None:
            return -g[rows].sum() / (h[rows].sum() + 1) * step
        return j, t, grow(g, h, rows[x[rows, j] < t], level + 1), grow(g, h, rows[~(x[rows, j] < t)], level + 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
        return tree

    for r in range(rounds):
        p = bo.softmax(margins[0])
        trees = []
        for k in range(classes):
            g, h = p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k])
            trees.append(grow(g, h, np.arange(len(x)), 0))
        for (a, b), m, name in zip(sets, margins, ("train", "test")):
            for k, tree in enumerate(trees):
                m[:, k] += [value(tree, row) for row in a]
            curve.append((r + 1, name, float(-np.log(np.maximum(bo.softmax(m)[np.arange(len(b)), b], 1e-16)).mean())))
    return margins, curve


@pytest.fixture(scope="module")
def cloud(spark):
    rng = random.Random(5)
    centers = {"a": (0, 2, 0), "b": (2, 0, 0), "c": (-1, -1, 1), "d": (0, 0, 0)}
    rows = [(name, [c + rng.gauss(0, 1.2) for c in center], i % 4 == 0) for name, center in centers.items() for i in range(60)]
    df = spark.createDataFrame(rows, "context string, document_embeddings array<double>, is_test boolean")
    return df.repartition(3).cache()


def arrays(df, labels):
    rows = df.collect()
    return (np.array([r["document_embeddings"] for r in rows]), np.array([labels.index(r["context"]) for r in rows]))


def test_equal_to_a_plain_version(cloud):
    train, test = cloud.filter("not is_test"), cloud.filter("is_test")
    model = cl.train_classifier(train, method="boosted", rounds=7, test=test)
    x, y = arrays(train, model.labels)
    other = arrays(test, model.labels)
    edges = bo.bin_edges(train.select("document_embeddings"), 3)
    margins, curve = brute(x, y, 4, edges, 7, test=other)
    assert np.allclose(model.trees.margins(x), margins[0], atol=1e-5)
    assert np.allclose(model.trees.margins(other[0]), margins[1], atol=1e-5)
    assert [c[:2] for c in model.losses] == [c[:2] for c in curve]
    assert np.allclose([c[2] for c in model.losses], [c[2] for c in curve], atol=1e-6)


def test_curve_equals_scoring_by_prefixes(cloud):
    train, test = cloud.filter("not is_test"), cloud.filter("is_test")
    model = cl.train_classifier(train, method="boosted", test=test)
    curve = cl.training_curve(model, train, test).collect()
    assert len(curve) == 2 * 20 and {r["class_"] for r in curve} == {None}
    for name, data in (("train", train), ("test", test)):
        x, y = arrays(data, model.labels)
        for row in curve:
            if row["dataset"] == name:
                p = bo.softmax(model.trees.part(0, row["round"]).margins(x))
                assert row["loss"] == pytest.approx(-np.log(p[np.arange(len(y)), y]).mean(), abs=1e-6)
    losses = [r["loss"] for r in curve if r["dataset"] == "train"]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.5 * losses[0]


def test_model_does_not_depend_on_partitions(cloud):
    a = cl.train_classifier(cloud, method="boosted", rounds=6)
    b = cl.train_classifier(cloud.repartition(7, "document_embeddings"), method="boosted", rounds=6)
    assert all(np.array_equal(getattr(a.trees, n), getattr(b.trees, n)) for n in ("feature", "cut", "threshold", "value"))
    assert a.losses == b.losses


def test_probabilities_sum_to_one(cloud):
    model = cl.train_classifier(cloud, method="boosted", rounds=5)
    rows = cloud.withColumn("p", bo.class_probabilities(model, "document_embeddings")).collect()
    assert all(math.isclose(sum(r["p"]), 1) and len(r["p"]) == 4 for r in rows)
    predicted = cl.predict_class(cloud, model, ["context"]).collect()
    assert sum(r["context"] == r["class_"] for r in predicted) > 0.7 * len(predicted)
    assert all(r["probability"] >= 1 / 4 for r in predicted)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", [1.0, nan])] * 5 + [("b", [2.0, inf])] * 5 + [("c", [2.0, -inf])] * 5
    rows += [(None, [1.0, 1.0]), ("a", None), ("b", [2.0, None])]
    df = spark.createDataFrame(rows, "context string, document_embeddings array<double>")
    model = cl.train_classifier(df, method="boosted", rounds=3)
    got = {(r["context"], None if r["document_embeddings"] is None else str(r["document_embeddings"])): (r["class_"], r["probability"])
           for r in cl.predict_class(df, model, ["context", "document_embeddings"]).collect()}
    assert got["a", None] == (None, None)
    assert got["a", "[1.0, nan]"][0] == "a"
    with pytest.raises(ValueError):
        cl.train_classifier(df.filter("document_embeddings is null"), method="boosted")
    one = cl.train_classifier(df.filter("context = 'a'"), method="boosted", rounds=2)
    assert cl.predict_class(df, one, ["context"]).filter("class_ is not null").select("probability").distinct().collect() == [(1.0,)]
    uneven = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], df.schema)
    with pytest.raises(Exception, match="numbers each"):
        cl.train_classifier(uneven, method="boosted")


def test_bins_hold_about_equal_parts(spark):
    rng = random.Random(1)
    rows = [([rng.gauss(0, 1), float(i % 3), 7.0, rng.expovariate(1)],) for i in range(4000)]
    df = spark.createDataFrame(rows, "v array<double>")
    edges = bo.bin_edges(df, 4)
    assert len(edges[2]) == 0 and len(edges[1]) == 2 and 40 <= len(edges[0]) < bo.BINS
    bins = bo.to_bins(np.array([r[0] for r in rows]), edges)
    counts = np.bincount(bins[:, 0])
    assert counts.max() < 3 * 4000 / bo.BINS
    assert [len(set(bins[:, j])) for j in (1, 2)] == [3, 1]


def test_given_vectors(spark, sf_dir):
    """The labelled vectors of the given table: equal to the plain version, and better than the largest class."""
    vectors = registry.table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("string").alias("context"), F.col("embedding").cast("array<double>").alias("document_embeddings"))
    few = vectors.filter("context < '3'")
    model = cl.train_classifier(few, method="boosted", rounds=2)
    x, y = arrays(few, model.labels)
    margins, _ = brute(x, y, 3, bo.bin_edges(few.select("document_embeddings"), 64), 2)
    assert np.allclose(model.trees.margins(x), margins[0], atol=1e-5)
