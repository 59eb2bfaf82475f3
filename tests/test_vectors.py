import pytest
from pyspark.sql import functions as F

from glotta.operators import vectors as vx

WORDS = [("casa", [1.0, 0.0]), ("perro", [0.0, 1.0]), ("rojo", [1.0, 1.0])]
DOCS = [("1", ["Casa", "perro"]), ("2", ["rojo", "zzz"]), ("3", ["zzz"]), ("4", []), ("5", None)]


@pytest.fixture
def words(spark):
    return spark.createDataFrame(WORDS, "word string, embedding array<float>")


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "docname string, normalized_text array<string>")


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_mean_of_known_words(words, docs, max_bytes):
    got = vx.document_to_vector(docs, words, ["docname"], max_broadcast_bytes=max_bytes)
    assert dict(got.collect()) == {"1": [0.5, 0.5], "2": [1.0, 1.0]}


def test_words_in_model(words, docs):
    got = dict(vx.words_in_model(docs, words, ["docname"]).select("docname", "normalized_text").collect())
    assert got == {"1": ["Casa", "perro"], "2": ["rojo"], "3": [], "4": [], "5": None}


def test_dropped_documents_are_counted(words, docs):
    made = vx.document_to_vector(docs, words, ["docname"])
    assert dict(vx.embeddable_counts(docs, made, ["docname"]).collect()) == {True: 2, False: 3}


def test_broadcast_bound_counts_bytes(spark, words):
    assert vx.broadcastable(words) and not vx.broadcastable(words, 100)


def test_hot_word_takes_the_salted_path_whole(spark, words):
    docs = spark.range(2000).select(F.col("id").cast("string").alias("docname"),
                                    F.array(F.lit("casa"), F.lit("perro")).alias("normalized_text"))
    got = vx.document_to_vector(docs, words, ["docname"], max_broadcast_bytes=0)
    assert got.count() == 2000
    assert got.select("document_embeddings").distinct().collect()[0][0] == [0.5, 0.5]


def test_tokens_are_not_sorted_with_their_vectors(words, docs):
    made = vx.document_to_vector(docs, words, ["docname"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "Sort" not in plan


def test_vectors_of_other_lengths_are_an_error(spark, docs):
    odd = spark.createDataFrame([("casa", [1.0, 0.0]), ("perro", [1.0])], "word string, embedding array<float>")
    with pytest.raises(Exception, match="numbers each"):
        vx.document_to_vector(docs, odd.orderBy("word"), ["docname"]).collect()
