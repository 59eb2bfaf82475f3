import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from glotta.operators import blocks, topics
from glotta.operators import word_topics as wt
from glotta.sources import models

THEMES = {"sea": "agua barco mar ola playa pez sal".split(), "food": "pan queso vino sopa carne sal plato".split(),
          "city": "calle coche ruido plaza tren puente luz".split()}


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.sample(sorted(THEMES), 2)
        share = rng.choice([0.95, 0.8])  # always more than half, so that the theme is clear
        rows.append((i, a, [rng.choice(THEMES[a if rng.random() < share else b]) for _ in range(rng.randint(8, 30))]))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(1, 150), "doc long, theme string, lemmatized_text array<string>").repartition(4).cache()


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame(corpus(2, 60), "doc long, theme string, lemmatized_text array<string>").cache()


@pytest.fixture(scope="module")
def fitted(docs):
    return wt.train_word_topics(docs, 3)


def test_digamma():
    # Published values of the function.
    want = {0.1: -10.4237549404110767, 1.0: -0.5772156649015329, 2.5: 0.7031566406452432, 30.0: 3.3844381326855486}
    assert np.allclose(wt.digamma(np.array(list(want))), list(want.values()), atol=1e-9)


def plain(docs, k, passes, start):
    """The same updates over one matrix in memory."""
    words = sorted({w for d in docs for w in d})
    lam = np.array([start[w] for w in words])
    for _ in range(passes):
        beta = np.exp(wt.digamma(lam) - wt.digamma(lam.sum(axis=0)))
        new = np.full(lam.shape, 1 / k)
        for d in docs:
            n = np.array([d.count(w) for w in words], dtype=float)
            own = n > 0
            theta = np.exp(wt.digamma(wt.document_topics(n[own], beta[own], 1 / k)))
            new[own] += beta[own] * theta * (n[own] / (beta[own] @ theta))[:, None]
        lam = new
    return dict(zip(words, lam))


def test_equal_to_one_matrix(docs):
    rows = [r["lemmatized_text"] for r in docs.collect()]
    start = {r["word"]: r["weights"] for r in wt.train_word_topics(docs, 3, passes=0).words.collect()}
    want = plain(rows, 3, 4, start)
    got = {r["word"]: r["weights"] for r in wt.train_word_topics(docs, 3, passes=4).words.collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[w], want[w], atol=1e-2) for w in want)


def test_partitions_and_joins_change_nothing(docs):
    a = wt.train_word_topics(docs, 3, passes=3, small=True)
    b = wt.train_word_topics(docs.repartition(7), 3, passes=3, small=False)
    rows = lambda m: {r["word"]: r["weights"] for r in m.words.collect()}
    one, two = rows(a), rows(b)
    assert one.keys() == two.keys() and all(np.allclose(one[w], two[w], atol=1e-4) for w in one)
    shares = [{r["doc"]: r["shares"] for r in wt.topic_shares(docs, a, ["doc"], small=s).collect()} for s in (True, False)]
    assert all(np.allclose(shares[0][d], shares[1][d]) for d in shares[0])


def test_finds_the_themes(docs, held, fitted):
    rows = wt.topic_shares(held, fitted, ["doc", "theme"]).collect()
    assert all(math.isclose(sum(r["shares"]), 1) for r in rows)
    best = {}
    for r in rows:
        best.setdefault(r["theme"], []).append(int(np.argmax(r["shares"])))
    named = {t: max(set(v), key=v.count) for t, v in best.items()}
    assert len(set(named.values())) == 3
    assert sum(v.count(named[t]) for t, v in best.items()) >= 0.9 * len(rows)
    weights = wt.topic_weights(fitted)
    assert all(math.isclose(r["s"], 1, abs_tol=1e-6) for r in weights.groupBy("topic").agg(F.sum("weight").alias("s")).collect())


def test_held_out_likelihood_is_no_worse_than_the_library(docs, held, fitted):
    other = topics.train_lda(docs, 3)
    bags = other.vectorizer.transform(held.select(F.col("lemmatized_text")))
    scored = other.model.transform(bags).select("features", vector_to_array("topicDistribution").alias("t")).collect()
    matrix = other.model.topicsMatrix().toArray()
    matrix = matrix / matrix.sum(axis=0)
    total = sum(float(n) * math.log(float(matrix[i] @ np.array(r["t"]))) for r in scored for i, n in zip(r["features"].indices, r["features"].values))
    theirs = total / sum(float(sum(r["features"].values)) for r in scored)
    ours = wt.log_likelihood(held, fitted).first()
    assert ours["n_words"] == sum(len(r["lemmatized_text"]) for r in held.collect())
    assert ours["per_word"] >= theirs - 0.02


def test_odd_documents(spark, fitted):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["never seen"]), (None, ["pan", "vino"] * 3), (5, ["mar"] * 20_000)],
                               "doc long, lemmatized_text array<string>")
    got = {r["doc"]: r["shares"] for r in wt.topic_shares(df, fitted, ["doc"]).collect()}
    assert len(got) == 5 and all(np.allclose(got[i], 1 / 3) for i in (1, 2, 3))
    assert max(got[None]) > 0.7 and max(got[5]) > 0.99
    empty = wt.train_word_topics(df.filter("doc < 3"), 2, passes=2)
    assert empty.words.collect() == [] and wt.topic_shares(df, empty, ["doc"]).count() == 5
    with pytest.raises(ValueError):
        wt.train_word_topics(df, 0)


def test_saved_and_loaded(spark, held, fitted, tmp_path):
    models.save_model(fitted, str(tmp_path / "w"))
    again = models.load_model(str(tmp_path / "w"))
    a, b = ({r["doc"]: r["shares"] for r in wt.topic_shares(held, m, ["doc"]).collect()} for m in (fitted, again))
    assert a == b and again.totals == fitted.totals


def test_documents_end_to_end_equal_each_by_itself():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 40, 3, 500, 1, 7])
    n, beta = rng.integers(1, 9, sizes.sum()).astype(float), rng.random((sizes.sum(), 4))
    got = wt.topics_of_documents(n, beta, sizes, 0.25)
    ends = np.cumsum(sizes)
    want = [wt.document_topics(n[e - s:e], beta[e - s:e], 0.25) for s, e in zip(sizes, ends)]
    assert np.allclose(got, want, rtol=1e-9)


def test_small_blocks_change_nothing(docs, fitted, monkeypatch):
    whole = wt.train_word_topics(docs, 3, passes=3)
    monkeypatch.setattr(blocks, "ENTRIES", 200)
    monkeypatch.setattr(blocks, "PIECE", 100)
    cut = wt.train_word_topics(docs, 3, passes=3)
    rows = lambda m: {r["word"]: r["weights"] for r in m.words.collect()}
    one, two = rows(whole), rows(cut)
    assert one.keys() == two.keys() and all(np.allclose(one[w], two[w], atol=1e-5) for w in one)
    shares = {r["doc"]: r["shares"] for r in wt.topic_shares(docs, fitted, ["doc"]).collect()}
    monkeypatch.undo()
    assert all(np.allclose(r["shares"], shares[r["doc"]], atol=1e-9) for r in wt.topic_shares(docs, fitted, ["doc"]).collect())


def test_a_block_names_each_of_its_words_once(docs, tmp_path):
    # A pass moves numbers for the words of a block, not for the words of each document.
    made = blocks.blocks_of(docs.select(F.col("lemmatized_text").alias("_tokens")), 1000, 1, str(tmp_path / "b"))
    words = [blocks.read(r["data"])[0].to_pylist() for r in made.filter(F.col("kind") == blocks.WORDS).collect()]
    assert 4 <= len(words) <= 8 and all(w == sorted(set(w)) for w in words)
    assert {x for w in words for x in w} == {x for r in docs.collect() for x in r["lemmatized_text"]}


def test_rows_of_one_key_are_one_document(spark, fitted):
    df = spark.createDataFrame([(1, ["pan"] * 9 + [None]), (1, ["mar"] * 3), (1, None), (None, ["mar"]), (None, ["sal"]), (2, ["pan"])],
                               "doc long, lemmatized_text array<string>")
    got = [(r["doc"], r["shares"]) for r in wt.topic_shares(df, fitted, ["doc"]).collect()]
    assert sorted(str(d) for d, _ in got) == ["1", "1", "1", "2", "None", "None"]
    merged = spark.createDataFrame([(1, ["pan"] * 9 + ["mar"] * 3), (None, ["mar", "sal"]), (2, ["pan"])], df.schema)
    want = {r["doc"]: r["shares"] for r in wt.topic_shares(merged, fitted, ["doc"]).collect()}
    assert all(np.allclose(s, want[d], atol=1e-9) for d, s in got)
