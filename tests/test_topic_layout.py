import math
import random

import numpy as np
import pytest

from glotta.operators import topic_layout as tl

SCHEMA = "topic string, word string, weight double"


def divergence(a, b):
    """Of two word -> weight tables, over every word of either."""
    ta, tb, out = sum(a.values()), sum(b.values()), 0.0
    for word in {*a, *b}:
        p, q = a.get(word, 0) / ta, b.get(word, 0) / tb
        for x in (p, q):
            if x:
                out += x * math.log(2 * x / (p + q)) / 2
    return out


@pytest.fixture(scope="module")
def topics():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    made = {f"t{i}": {w: rng.uniform(0.1, 9) for w in rng.sample(words, rng.randint(1, 200))} for i in range(7)}
    made["twin"] = {w: 2 * x for w, x in made["t0"].items()}
    made["apart"] = {"alone": 1.0, "single": 3.0}
    return made


@pytest.fixture(scope="module")
def weights(spark, topics):
    rows = [(t, w, x) for t, own in topics.items() for w, x in own.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_divergences(weights, topics, monkeypatch):
    monkeypatch.setattr(tl, "CELLS", 64)
    got = {(r["topic"], r["other"]): r["divergence"] for r in tl.topic_distances(weights).collect()}
    assert set(got) == {(a, b) for a in topics for b in topics if a < b}
    for (a, b), found in got.items():
        assert found == pytest.approx(divergence(topics[a], topics[b]), abs=1e-12)
    assert got["t0", "twin"] == pytest.approx(0, abs=1e-12) and got["apart", "t1"] == pytest.approx(math.log(2))


def test_coordinates_reproduce_the_divergences(weights, topics):
    rows = tl.topic_layout(weights, dimensions=len(topics) - 1).collect()
    points = {r["topic"]: np.array(r["coordinates"]) for r in rows}
    for a in topics:
        for b in topics:
            assert ((points[a] - points[b]) ** 2).sum() == pytest.approx(divergence(topics[a], topics[b]), abs=1e-9)
    whole = sum(sum(own.values()) for own in topics.values())
    assert {r["topic"]: r["share"] for r in rows} == pytest.approx({t: sum(own.values()) / whole for t, own in topics.items()})


def test_first_axes_are_the_best(weights):
    flat = tl.topic_layout(weights).collect()
    full = {r["topic"]: r["coordinates"] for r in tl.topic_layout(weights, dimensions=6).collect()}
    assert all(len(r["coordinates"]) == 2 and r["coordinates"] == pytest.approx(full[r["topic"]][:2]) for r in flat)
    spread = np.array(list(full.values())).var(axis=0)
    assert list(spread) == sorted(spread, reverse=True)


def test_odd_rows(spark, topics):
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 4.0), (None, "x", 1.0), ("b", None, 1.0),
            ("b", "y", None), ("b", "z", 0.0), ("c", "x", 0.0), ("b", "y", -1.0)]
    got = tl.topic_distances(spark.createDataFrame(rows, SCHEMA)).collect()
    want = divergence({"x": 2, "y": 2}, {"x": 4})
    assert [(r["topic"], r["other"]) for r in got] == [("a", "b")] and got[0]["divergence"] == pytest.approx(want)
    for few in ([], rows[:3]):
        df = spark.createDataFrame(few, SCHEMA)
        assert tl.topic_distances(df).count() == 0
        assert [(r["topic"], r["share"], r["coordinates"]) for r in tl.topic_layout(df).collect()] == (
            [("a", 1.0, [0.0, 0.0])] if few else [])


def test_too_many_topics(weights, monkeypatch):
    monkeypatch.setattr(tl, "MAX_TOPICS", 3)
    with pytest.raises(ValueError):
        tl.topic_distances(weights)
    with pytest.raises(ValueError):
        tl.topic_layout(weights)
