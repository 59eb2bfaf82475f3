import math
import random

import pytest

from glotta.operators import topics as tp
from glotta.plans import pipelines


@pytest.fixture(scope="module")
def lemmas(spark):
    rng = random.Random(3)
    themes = [["mar", "barco", "pez", "ola"], ["rey", "corona", "reina", "trono"], ["tren", "vía", "vagón", "andén"]]
    rows = [(str(i), rng.choices(themes[i % 3], k=12)) for i in range(60)]
    df = spark.createDataFrame(rows, "docname string, lemmatized_text array<string>").persist()
    df.count()
    return df


def test_nearest_words(spark):
    rng = random.Random(1)
    words = {f"w{i}": [rng.uniform(-1, 1) for _ in range(5)] for i in range(200)}
    words["zero"] = [0.0] * 5
    centers = {0: [1.0, 0, 0, 0, 0], 1: [0.2, -0.4, 0.1, 0.9, 0.3], 2: [0.0, 0.0, 0.0, 0.0, -2.0]}
    df = spark.createDataFrame(list(words.items()), "word string, embedding array<double>")
    got = tp.nearest_words(df, centers, 7).collect()
    assert len(got) == 21

    def cosine(a, b):
        norm = math.hypot(*a) * math.hypot(*b)
        return round(sum(x * y for x, y in zip(a, b)) / norm, 6) if norm else None

    for topic, center in centers.items():
        scored = [(w, cosine(v, center)) for w, v in words.items() if any(v)]
        want = [w for w, _ in sorted(scored, key=lambda p: (-p[1], p[0]))[:7]]
        rows = sorted((r for r in got if r["topic"] == topic), key=lambda r: r["rank"])
        assert [r["word"] for r in rows] == want and [r["rank"] for r in rows] == list(range(1, 8))


def test_dictionary_and_bags(spark, lemmas):
    dictionary = tp.build_dictionary(lemmas).collect()
    assert sorted(r["token_id"] for r in dictionary) == list(range(12))
    docs = dict(lemmas.collect())
    for r in dictionary:
        assert r["doc_freq"] == sum(r["token"] in tokens for tokens in docs.values())
    bags = {(r["docname"], r["token"]): r["n"] for r in tp.bag_of_words(lemmas, ["docname"]).collect()}
    assert bags == {(d, t): tokens.count(t) for d, tokens in docs.items() for t in set(tokens)}
    assert dict(tp.corpus_stats(lemmas).collect()) == {"unique_tokens": 12, "documents": 60}


def test_filter_extremes(spark):
    df = spark.createDataFrame([("a", 49), ("b", 50), ("c", 100), ("d", 101)], "token string, doc_freq long")
    assert sorted(r["token"] for r in tp.filter_extremes(df, 200).collect()) == ["b", "c"]


@pytest.mark.parametrize("column", ["lemmatized_text", "stemmed_text"])
def test_lda_with_an_odd_number_of_topics(lemmas, column):
    trained, words = pipelines.lda_topics(lemmas.withColumnRenamed("lemmatized_text", column), k=5, column=column, passes=5)
    rows = words.collect()
    assert len(rows) == 50 and len({(r["topic"], r["rank"]) for r in rows}) == 50
    assert all(r["weight"] > 0 for r in rows) and len(trained.vectorizer.vocabulary) == 12
    relative = tp.topic_word_weights(words).collect()
    assert len(relative) == 50
    assert {r["rank"] for r in relative if r["relative"] == 1.0} >= {1}


def test_lda_refuses_a_vocabulary_over_the_bound(lemmas, monkeypatch):
    monkeypatch.setattr(tp, "MAX_LDA_VOCABULARY", 5)
    with pytest.raises(ValueError):
        tp.train_lda(lemmas, 2)


def test_topics_of_a_vocabulary_over_the_bound(lemmas, monkeypatch):
    small, _ = pipelines.lda_topics(lemmas, 3, passes=5)
    assert pipelines.lda_shares(lemmas, small, ["docname"]).count() == 60
    monkeypatch.setattr(tp, "MAX_LDA_VOCABULARY", 5)
    trained, words = pipelines.lda_topics(lemmas, 3, passes=20)
    assert words.dtypes == [("topic", "int"), ("rank", "int"), ("word", "string"), ("weight", "double")]
    rows = words.collect()
    assert len({(r["topic"], r["rank"]) for r in rows}) == len(rows) == 30  # 10 of 12 words of each topic
    shares = {r["docname"]: r["shares"] for r in pipelines.lda_shares(lemmas, trained, ["docname"]).collect()}
    assert len(shares) == 60 and all(sum(s) == pytest.approx(1) for s in shares.values())
    with pytest.raises(ValueError):
        pipelines.lda_topics(lemmas, 3, min_df=2.0)


def test_kmeans_topics(spark):
    rng = random.Random(2)
    rows = [(str(i), [rng.gauss(c, 0.1), rng.gauss(-c, 0.1)]) for i, c in enumerate([1.0, 5.0, -5.0] * 30)]
    docs = spark.createDataFrame(rows, "docname string, document_embeddings array<double>")
    words = spark.createDataFrame([("uno", [1.0, -1.0]), ("dos", [-1.0, 1.0]), ("tres", [1.0, 1.0])],
                                  "word string, embedding array<float>")
    found = pipelines.kmeans_topics(docs, words, k=3, words=2)
    assert found.words.count() == 6
    assigned = dict(tp.assign_topics(docs, found.model, ["docname"]).collect())
    assert len(assigned) == 90
    assert all(assigned[str(i)] == assigned[str(i + 3)] for i in range(87))


def test_relevance(spark):
    weights = spark.createDataFrame([(0, "a", 3.0), (0, "b", 1.0), (1, "b", 2.0), (1, "c", 2.0)],
                                    "topic int, word string, weight double")
    frequencies = spark.createDataFrame([("a", 3), ("b", 3), ("c", 2)], "word string, n long")
    got = {(r["topic"], r["word"]): r["relevance"] for r in tp.topic_term_relevance(weights, frequencies, 0.6).collect()}
    want = 0.6 * math.log(3 / 4) + 0.4 * math.log((3 / 4) / (3 / 8))
    assert got[(0, "a")] == pytest.approx(want, abs=1e-6) and len(got) == 4


def test_corpus_stats_reads_the_documents_once(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],), ([],), (None,)], "lemmatized_text array<string>")
    got = tp.corpus_stats(df)
    assert dict(got.collect()) == {"unique_tokens": 2, "documents": 4}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert dict(tp.corpus_stats(df.limit(0)).collect()) == {"unique_tokens": 0, "documents": 0}
