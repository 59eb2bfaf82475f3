import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glotta.operators import calibration as cal
from glotta.operators import classification as cl
from glotta.operators import topics
from glotta.sources import models


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(11)
    rows = [(f"{n}{i}", n, [rng.gauss(c, 1.0), rng.gauss(-c, 1.0)], i % 3 == 0) for n, c in (("a", 0), ("b", 1.5), ("c", -1.5))
            for i in range(120)]
    df = spark.createDataFrame(rows, "docname string, context string, document_embeddings array<double>, is_test boolean")
    return df.repartition(3).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("method", ["softmax", "trees", "boosted"])
def test_classifiers_come_back_equal(spark, vectors, tmp_path, method):
    train, test = vectors.filter("not is_test"), vectors.filter("is_test")
    model = cl.train_classifier(train, method=method, rounds=4)
    path = str(tmp_path / "model")
    models.save_model(model, path, test)
    again = models.load_model(path)
    assert type(again) is type(model) and again.labels == model.labels
    assert rows_of(cl.predict_class(test, again, ["docname"])) == rows_of(cl.predict_class(test, model, ["docname"]))
    assert rows_of(models.load_holdout(spark, path).select("docname")) == rows_of(test.select("docname"))
    kept = models.read_manifest(spark, path)
    assert kept["class"] == type(model).__name__ and kept["labels"] == ["a", "b", "c"] and kept["parameters"]
    calibrated = cal.calibrate(model, test)
    models.save_model(calibrated, path)
    back = models.load_model(path)
    assert back.curves == calibrated.curves
    assert rows_of(cal.predict_calibrated(test, back, ["docname"])) == rows_of(cal.predict_calibrated(test, calibrated, ["docname"]))
    with pytest.raises(FileNotFoundError):
        models.load_holdout(spark, path)


def test_topic_models_come_back_equal(spark, vectors, tmp_path):
    kmeans = topics.train_kmeans(vectors, 3)
    models.save_model(kmeans, str(tmp_path / "k"))
    again = models.load_model(str(tmp_path / "k"))
    assert rows_of(topics.assign_topics(vectors, again, ["docname"])) == rows_of(topics.assign_topics(vectors, kmeans, ["docname"]))
    texts = spark.createDataFrame([(["casa", "perro"],), (["casa", "gato", "gato"],), (["sol"],)], "lemmatized_text array<string>")
    lda = topics.train_lda(texts, 2, passes=2)
    models.save_model(lda, str(tmp_path / "l"))
    back = models.load_model(str(tmp_path / "l"))
    assert back.vectorizer.vocabulary == lda.vectorizer.vocabulary
    assert rows_of(topics.describe_topics(back)) == rows_of(topics.describe_topics(lda))


def test_a_broken_save_leaves_the_model_before(spark, vectors, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        models.load_model(path)
    first = models.save_model(cl.train_classifier(vectors, method="boosted", rounds=1), path)
    bad = vectors.withColumn("document_embeddings", F.raise_error(F.lit("lost")).cast("array<double>"))
    with pytest.raises(Exception, match="lost"):
        models.save_model(cl.train_classifier(vectors, method="boosted", rounds=2), path, bad)
    assert models.read_manifest(spark, path)["version"] == first and models.load_model(path).trees.rounds == 1
    second = models.save_model(cl.train_classifier(vectors, method="boosted", rounds=3), path)
    assert second != first and models.load_model(path).trees.rounds == 3
    with pytest.raises(TypeError):
        models.save_model({"no": "model"}, path)


# --- calibration --------------------------------------------------------------------------------------

def test_pooling_equals_the_best_monotone_fit(spark):
    rng = random.Random(2)
    for _ in range(20):
        counts = [(0.0, n, rng.randint(0, n)) for n in (rng.randint(1, 9) for _ in range(rng.randint(1, 12)))]
        fitted = [p / n for _, n, p in cal.pooled(counts) for _ in range(1)]
        assert fitted == sorted(fitted)
        sizes = [n for _, n, _ in cal.pooled(counts)]
        assert sum(sizes) == sum(n for _, n, _ in counts)
        # The max-min formula names the same rate for each bin.
        want = [max(min(sum(c[2] for c in counts[a:b + 1]) / sum(c[1] for c in counts[a:b + 1]) for b in range(i, len(counts)))
                    for a in range(i + 1)) for i in range(len(counts))]
        got, at = [], 0
        blocks = cal.pooled(counts)
        left = blocks[0][1]
        for _, n, _ in counts:
            while left <= 0:
                at += 1
                left = blocks[at][1]
            got.append(blocks[at][2] / blocks[at][1])
            left -= n
        assert np.allclose(got, want)


def test_isotonic_join_equals_pooling(spark):
    rng = random.Random(3)
    rows = [(i, 0, n, rng.randint(0, n)) for i in range(40) if (n := rng.randint(0, 6))]
    got = {r["bin"]: r["rate"] for r in cal.isotonic(spark.createDataFrame(rows, "bin int, total long, n long, positives long")).collect()}
    for block in [got[r[0]] for r in rows]:
        assert 0 <= block <= 1
    ordered = [got[r[0]] for r in rows]
    assert ordered == sorted(ordered) and len(got) == len(rows)
    blocks = cal.pooled([(0.0, n, p) for _, _, n, p in rows])
    assert sorted(set(np.round(ordered, 9))) == sorted({round(p / n, 9) for _, n, p in blocks})


@pytest.mark.parametrize("method", ["softmax", "trees", "boosted"])
def test_probabilities_are_monotone_and_reliable(spark, vectors, method):
    train, held = vectors.filter("not is_test"), vectors.filter("is_test")
    model = cal.calibrate(cl.train_classifier(train, method=method, rounds=6), held)
    rows = cal.predict_calibrated(held, model, ["docname", "context"]).collect()
    for label in model.labels:
        own = sorted((r["score"], r["probability"]) for r in rows if r["class_"] == label)
        assert [p for _, p in own] == sorted(p for _, p in own)
    raw = {r["docname"]: (r["class_"], r["probability"]) for r in cl.predict_class(held, model.model, ["docname"]).collect()}
    assert all(raw[r["docname"]] == (r["class_"], r["score"]) for r in rows)
    table = cal.reliability(held, model, bins=4).collect()
    assert sum(r["n"] for r in table) == 3 * held.count()
    # On the rows that it was fitted to, a calibrated probability is the rate, up to the width of a block.
    error = sum(abs(r["mean_probability"] - r["rate"]) * r["n"] for r in table) / sum(r["n"] for r in table)
    assert error < 0.06


def test_rows_without_vector_or_label(spark, vectors):
    model = cal.calibrate(cl.train_classifier(vectors, method="boosted", rounds=2),
                          vectors.filter("context <> 'c'").withColumn("context", F.when(F.col("docname") < "a5", None).otherwise(F.col("context"))))
    assert model.curves[2] == [(0.0, 0.0), (1.0, 1.0)]
    nothing = vectors.limit(1).withColumn("document_embeddings", F.lit(None).cast("array<double>"))
    assert rows_of(cal.predict_calibrated(nothing, model, []).select("class_", "score", "probability")) == [(None, None, None)]
