import math
import random

import pytest
from pyspark.sql import functions as F

from glotta.operators import classification as cl
from glotta.operators.evaluation import classification_report
from glotta.plans import pipelines
from glotta.sources.models import load_model


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(7)
    centers = {"apr": (0.0, 4.0), "pan": (4.0, 0.0), "wiki": (-4.0, -4.0)}
    rows = [(f"{name}{i}", name, [x + rng.gauss(0, 0.7), y + rng.gauss(0, 0.7)])
            for name, (x, y) in centers.items() for i in range(60)]
    df = spark.createDataFrame(rows, "docname string, context string, document_embeddings array<double>").persist()
    df.count()
    return df


def test_codes_follow_sorted_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "context string")
    got = cl.encode_classes(df)
    assert dict(got.select("context", "context_categorical").distinct().collect()) == {"a": 0, "b": 1, "c": 2}
    assert got.count() == 4
    decoded = cl.decode_classes(got.withColumn("prediction", F.col("context_categorical").cast("double")), ["a", "b", "c"])
    assert decoded.filter("class_ <> context").count() == 0


def test_split_is_disjoint_complete_and_exact(vectors):
    split = cl.holdout_split(vectors, ["docname"])
    assert split.count() == 180 and split.filter("is_test").count() == 18
    assert split.select("docname").distinct().count() == 180


def test_split_does_not_depend_on_partitioning(vectors):
    a = {r["docname"] for r in cl.holdout_split(vectors, ["docname"]).filter("is_test").collect()}
    b = {r["docname"] for r in cl.holdout_split(vectors.repartition(3), ["docname"]).filter("is_test").collect()}
    assert a == b


@pytest.mark.parametrize("method", ["softmax", "trees", "boosted"])
def test_train_evaluate_save_load(spark, vectors, tmp_path, method):
    run = pipelines.train_document_classifier(vectors, ["docname"], method=method, path=str(tmp_path))
    report = {r["label"]: r for r in run.report.collect()}
    # The split goes by content, so its size is near a tenth, not exactly that.
    assert report["accuracy"]["f1"] >= 0.9 and 10 <= report["accuracy"]["support"] == run.test.count() <= 26
    predicted = cl.predict_class(run.test, run.model, ["docname"]).collect()
    assert all(1 / 3 <= r["probability"] <= 1 and r["class_"] in run.model.labels for r in predicted)
    again = cl.predict_class(run.test, load_model(str(tmp_path)), ["docname"]).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, predicted))
    saved = {r["label"]: r for r in pipelines.evaluate_saved(spark, str(tmp_path)).collect()}
    assert saved == report
    curve = cl.training_curve(run.model, run.train, run.test).collect()
    losses = [r["loss"] for r in sorted(curve, key=lambda r: (r["class_"] or "", r["round"])) if r["dataset"] == "train"]
    assert all(math.isfinite(x) for x in losses)
    if method == "boosted":
        assert len(curve) == 20 * 2 and losses[-1] < losses[0]
    elif method == "trees":
        assert len(curve) == 3 * 20 * 2 and {r["round"] for r in curve} == set(range(1, 21))
    else:
        assert losses[-1] < losses[0]


def test_unknown_method(vectors):
    with pytest.raises(ValueError):
        cl.train_classifier(vectors, method="other")


def test_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", None)] + [("c", "a")] * 2 + [(None, "a")]
    df = spark.createDataFrame(pairs, "label string, predicted string")
    got = {r["label"]: tuple(r)[1:] for r in classification_report(df).collect()}
    assert got["a"] == (3 / 5, 3 / 4, pytest.approx(2 / 3), 4)
    assert got["b"] == (2 / 3, 2 / 3, pytest.approx(2 / 3), 3)
    assert got["c"] == (0.0, 0.0, 0.0, 2)  # never predicted: no division error
    assert got["accuracy"] == (5 / 9, 5 / 9, 5 / 9, 9)
    assert got["macro avg"] == (pytest.approx((3 / 5 + 2 / 3) / 3), pytest.approx((3 / 4 + 2 / 3) / 3),
                                pytest.approx(4 / 9), 9)
    assert got["weighted avg"][1] == pytest.approx((4 * 3 / 4 + 3 * 2 / 3) / 9)
    assert len(got) == 6
