"""Crossing a size bound changes neither rows nor columns."""

import pytest
from pyspark.sql import functions as F

from glotta.operators import arrays, blocks, classification, language, normalization, topics, translation
from glotta.plans import pipelines


@pytest.fixture
def docs(spark):
    rows = [("a", ["rey", "casa", "xx"], "c1", {"k": 1}), ("a", ["rey", "casa", "xx"], "c1", {"k": 1}),
            ("b", [], "c2", None), ("c", None, None, {"k": 2})]
    return spark.createDataFrame(rows, "docname string, normalized_text array<string>, w string, pos map<string,int>")


def both_ways(monkeypatch, run):
    """The result with look-ups written into the plan, and joined."""
    inline = run()
    inline_rows = sorted(map(str, inline.collect()))
    monkeypatch.setattr(arrays.inline_rows, "__defaults__", (0,))
    joined = run()
    return (inline.columns, inline_rows), (joined.columns, sorted(map(str, joined.collect())))


def test_vocabulary_filter(spark, docs, monkeypatch):
    words = spark.createDataFrame([("rey",), ("rey",), ("xx",)], "word string")
    a, b = both_ways(monkeypatch, lambda: normalization.keep_in_vocabulary(docs, words, ["docname"]))
    assert a == b and len(a[1]) == 4


def test_lemmas_with_repeated_forms(spark, docs, monkeypatch):
    lexicon = spark.createDataFrame([("rey", "z", "NOUN"), ("rey", "m", "NOUN"), ("casa", "casar", "VERB")],
                                    "form string, lemma string, pos string")
    a, b = both_ways(monkeypatch, lambda: normalization.lemmatize_pos_filter(docs, ["docname"], lexicon))
    assert a == b and "'m'" in a[1][0]


def test_translation_with_repeated_words(spark, monkeypatch):
    docs = spark.createDataFrame([("a", "la king", "en", 1), ("a", "la king", "en", 1), ("b", None, "en", 2)],
                                 "docname string, cleaned_text string, language string, token long")
    lexicon = spark.createDataFrame([("en", "king", "rey"), ("en", "king", "el rey")],
                                    "lang string, token string, es_token string")
    a, b = both_ways(monkeypatch, lambda: translation.lexicon_translate(docs, ["docname"], lexicon))
    assert a == b and "la el rey" in a[1][0]


def test_stems_beyond_the_bound(docs):
    lemmas = docs.withColumnRenamed("normalized_text", "lemmatized_text")
    small = normalization.stem_documents(lemmas)
    large = normalization.stem_documents(lemmas, max_broadcast_rows=0)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_many_stems_are_not_joined_to_tokens(spark, docs, monkeypatch):
    monkeypatch.setattr(blocks, "ENTRIES", 3)
    monkeypatch.setattr(blocks, "CHUNK", 2)
    lemmas = docs.withColumnRenamed("normalized_text", "lemmatized_text").unionByName(spark.createDataFrame(
        [("d", ["reyes", None, "casas"], "c3", None)], "docname string, lemmatized_text array<string>, w string, pos map<string,int>"))
    small = normalization.stem_documents(lemmas)
    large = normalization.stem_documents(lemmas, max_broadcast_rows=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_lda_counts_the_words_that_are_left(spark, monkeypatch):
    docs = spark.createDataFrame([([f"w{i}", f"w{(i + 1) % 12}"],) for i in range(12)] * 2,
                                 "lemmatized_text array<string>")
    monkeypatch.setattr(topics, "MAX_LDA_VOCABULARY", 12)
    assert len(topics.train_lda(docs, k=2, passes=1, min_df=2).vectorizer.vocabulary) == 12
    monkeypatch.setattr(topics, "MAX_LDA_VOCABULARY", 5)
    with pytest.raises(ValueError, match="12 tokens are left"):
        topics.train_lda(docs, k=2, passes=1, min_df=2)


def test_many_topics_and_languages(spark):
    weights = spark.range(1200).select(F.col("id").alias("topic"), F.lit("w").alias("word"), F.lit(2.0).alias("weight"))
    freq = spark.createDataFrame([("w", 3)], "word string, n long")
    assert topics.topic_term_relevance(weights, freq).count() == 1200
    texts = spark.range(510).select(F.col("id").cast("string").alias("docname"), F.concat(
        F.lit("l"), "id").alias("language"), F.lit("some text").alias("cleaned_text"))
    assert len(language.fit_language_profiles(texts).languages) == 510


def test_texts_in_no_fitted_language_are_unknown(spark):
    known = [("1", "en", "the house of the king and the garden by the river where children play all day"),
             ("2", "es", "la casa del rey y el jardín junto al río donde los niños juegan todo el día")]
    train = spark.createDataFrame(known, "docname string, language string, cleaned_text string")
    texts = [("ru", "дом короля и сад у реки"), ("ja", "王様の家と川のそばの庭"), ("ca", "això és una cosa ben diferent"),
             ("en", "the king and the children play by the river"), ("none", "123")]
    df = spark.createDataFrame(texts, "docname string, cleaned_text string")
    profiles = language.fit_language_profiles(train)
    got = dict(language.detect_language(df, profiles, ["docname"]).collect())
    assert got == {"ru": "unknown", "ja": "unknown", "ca": "unknown", "en": "en", "none": None}
    found = language.add_detected_language(df, profiles, ["docname"])
    done = {r.docname: r for r in translation.translate_detected(found, ["docname"]).collect()}
    assert done["ru"].route == "unsupported" and done["ru"].translated_text is None
    more = spark.createDataFrame([("3", "ru", "дом короля и сад у реки где дети играют")], train.schema)
    again = language.fit_language_profiles(train.unionByName(more))
    assert dict(language.detect_language(df, again, ["docname"]).collect())["ru"] == "ru"


def test_copies_are_on_one_side_of_the_split(spark):
    rows = [(f"d{i}", [float(i % 40), 1.0]) for i in range(400)]
    split = classification.content_split(spark.createDataFrame(rows, "docname string, v array<double>"), "v")
    sides = split.groupBy("v").agg(F.countDistinct("is_test").alias("n"))
    assert sides.filter("n > 1").isEmpty() and 0 < split.filter("is_test").count() < 200
    assert pipelines.train_document_classifier is not None
