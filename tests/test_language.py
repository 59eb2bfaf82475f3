from collections import Counter

import pytest
from pyspark.sql import functions as F

from glotta.operators.language import (add_detected_language, detect_language, fit_language_profiles,
                                       language_mismatch_counts)
from glotta.functions.text import char_trigrams
from glotta.operators import language as lg

TRAIN = [("a", "en", "the house of the king"), ("b", "es", "la casa de los reyes"), ("c", "fr", "la maison du roi est là")]
SCHEMA = "docname string, language string, cleaned_text string"


@pytest.fixture(scope="module")
def profiles(spark):
    return fit_language_profiles(spark.createDataFrame(TRAIN, SCHEMA))


def test_trigrams_cover_the_whole_text(spark):
    text = "Ab, " * 20_000 + "𐌰𐌱"
    got = spark.createDataFrame([(text,)], "t string").select(F.explode(char_trigrams(F.col("t"))).alias("g"))
    counts = {r["g"]: r["count"] for r in got.groupBy("g").count().collect()}
    letters = " " + "ab " * 20_000 + "𐌰𐌱 "
    want = Counter(letters[i:i + 3] for i in range(len(letters) - 2))
    assert {g: n for g, n in counts.items() if not any(ord(c) > 0xFFFF for c in g)} == {
        g: n for g, n in want.items() if not any(ord(c) > 0xFFFF for c in g)}
    assert not any("?" in g or "�" in g for g in counts)


def test_detects_and_keeps_rows_without_letters(spark, profiles):
    rows = [("1", "the king"), ("2", "los reyes de la casa"), ("3", "maison du roi"), ("4", ""), ("5", "12 34!"),
            ("6", None), ("7", "qqq www")]
    df = spark.createDataFrame(rows, "docname string, cleaned_text string")
    got = dict(detect_language(df, profiles, ["docname"]).collect())
    assert got["1"] == "en" and got["2"] == "es" and got["3"] == "fr"
    assert got["4"] is None and got["5"] is None and got["6"] is None
    assert got["7"] == "unknown" and len(got) == len(rows)


def test_shuffle_path_gives_the_same_labels(spark, profiles, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("docname"), F.col("lang").alias("language"),
        F.col("text").alias("cleaned_text"))
    fitted = fit_language_profiles(docs)
    small = dict(detect_language(docs, fitted, ["docname"]).collect())
    large = dict(detect_language(docs, fitted, ["docname"], max_broadcast_rows=0).collect())
    assert small == large and len(small) == docs.count()


def test_scores_are_smoothed_log_probabilities(spark, profiles):
    import math
    rows = {(r["language"], r["gram"]): r["score"] for r in profiles.as_rows().collect()}
    text = " the house of the king "
    grams = Counter(text[i:i + 3] for i in range(len(text) - 2))
    total = sum(grams.values())
    assert rows[("en", " th")] == round(math.log(3 / (total + profiles.size)) * 1e6)
    assert profiles.unseen["en"] == round(math.log(1 / (total + profiles.size)) * 1e6)


def test_no_training_text_means_no_language(spark):
    empty = fit_language_profiles(spark.createDataFrame([], SCHEMA))
    df = spark.createDataFrame([("1", "text")], "docname string, cleaned_text string")
    assert detect_language(df, empty, ["docname"]).collect()[0]["detected_language"] is None


def test_missing_detection_is_a_mismatch(spark, profiles):
    df = spark.createDataFrame([("1", "en", "the king"), ("2", "en", "los reyes de la casa"), ("3", "en", "12")], SCHEMA)
    found = add_detected_language(df, profiles, ["docname"])
    counts = dict(language_mismatch_counts(found).collect())
    assert counts == {False: 1, True: 2}


def test_numbers_give_what_joined_trigrams_give(spark):
    rows = [("1", "en", "the cat sat on the mat"), ("1", "en", "the dog"), ("2", "es", "el niño está en la montaña"), (None, "es", "ñu"),
            ("4", "fr", "𝐀𝐁𝐂𝐃 été"), ("5", None, "the the"), ("6", "en", None), ("7", "en", "123"), ("8", "fr", ""), ("9", "de", "日本語 Straße")]
    df = spark.createDataFrame(rows, "docname string, language string, cleaned_text string")
    profiles = lg.fit_language_profiles(df)
    plain = df.filter("language is not null").select("language", F.explode(char_trigrams(F.col("cleaned_text"))).alias("gram"))
    unseen = F.create_map(*(x for k, v in profiles.unseen.items() for x in (F.lit(k), F.lit(v))))
    seen = profiles.as_rows().filter(F.col("score") > unseen[F.col("language")]).select("language", "gram")
    assert set(map(tuple, seen.collect())) == set(map(tuple, plain.collect()))
    small, large = (lg._sums_in_place(df, profiles, ["docname"], "cleaned_text"), lg._sums_by_join(df, profiles, ["docname"], "cleaned_text"))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert "Generate" not in small._jdf.queryExecution().executedPlan().toString()
