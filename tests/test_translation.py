import numpy as np
import pytest
from pyspark.sql import functions as F

from glotta.functions.lexicons import supported_languages
from glotta.operators import translation as tr

SCHEMA = "docname string, language string, cleaned_text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_language_table(spark):
    rows = dict(supported_languages(spark).collect())
    assert len(rows) == 99
    assert rows["en"].endswith("en-ROMANCE") and rows["ca"].endswith("opus-mt-ca-es") and "es" not in rows


def test_routes(spark):
    df = frame(spark, [("1", "es", "x"), ("2", "en", "x"), ("3", "ca", "x"), ("4", "pt", "x"), ("5", None, "x")])
    got = {r["docname"]: r["route"] for r in tr.route_translation(df).collect()}
    assert got == {"1": "identity", "2": "english", "3": "generic", "4": "unsupported", "5": "unsupported"}


def test_english_prefix(spark):
    df = tr.route_translation(frame(spark, [("1", "en", "hi"), ("2", "fr", "bonjour")]))
    got = {r["docname"]: r["model_input"] for r in tr.english_target_prefix(df).collect()}
    assert got == {"1": ">>es<< hi", "2": "bonjour"}


ROWS = [("1", "en", "The king, and the queen's\n\ndog."), ("2", "fr", "Le roi et la reine"), ("3", "es", "The rey de la casa"),
        ("4", "pt", "o rei"), ("5", None, "x"), ("6", "ca", "el rei"), ("7", "en", ""), ("8", "en", None)]
WANT = {"1": "el king, y el queen's\n\ndog.", "2": "el roi y la reine", "3": "The rey de la casa", "4": None, "5": None,
        "6": "el rei", "7": "", "8": None}


def test_translate_keeps_spanish_whole_and_unsupported_null(spark):
    got = tr.translate(frame(spark, ROWS), ["docname"], "language")
    assert {r["docname"]: r["translated_text"] for r in got.collect()} == WANT


@pytest.mark.parametrize("bound", [10_000, 0])
def test_joined_lexicon_equals_inline(spark, monkeypatch, bound):
    monkeypatch.setattr(tr, "inline_rows", lambda lexicon: None)
    got = tr.lexicon_translate(tr.route_translation(frame(spark, ROWS)), ["docname"], max_broadcast_rows=bound)
    got = {r["docname"]: r["translated_text"] for r in got.collect()}
    want = dict(WANT, **{"4": "o rei", "5": "x"})
    assert got == want


def test_batches(spark):
    rows = [(str(i), "en", "t") for i in range(100)] + [(f"f{i}", "fr", "t") for i in range(15)] + [("z", "en", "")]
    got = tr.translation_batches(frame(spark, rows), ["docname"]).collect()
    assert len(got) == 115
    english = [r for r in got if r["language"] == "en"]
    assert sorted({r["batch"] for r in english}) == list(range(7))
    assert {r["batch"]: r["batch_rows"] for r in english} == {**{b: 15 for b in range(6)}, 6: 10}
    assert {r["is_short"] for r in english if r["batch"] < 6} == {False}
    assert all(r["is_short"] for r in english if r["batch"] == 6)
    assert not any(r["is_short"] for r in got if r["language"] == "fr")


def test_batches_honour_offset_and_limit_exactly(spark):
    df = frame(spark, [(str(i), "en", "t") for i in range(100)])
    first = {r["docname"] for r in tr.translation_batches(df, ["docname"], limit=37).collect()}
    rest = {r["docname"] for r in tr.translation_batches(df, ["docname"], offset=37).collect()}
    assert len(first) == 37 and len(rest) == 63 and not first & rest


def test_translate_corpus_skips_other_languages(spark):
    got = tr.translate_corpus(frame(spark, ROWS), ["docname"]).collect()
    assert {r["docname"] for r in got} == {"1", "2", "3"}


def test_user_model(spark):
    def make():
        return lambda names, texts: np.array([f"{n[-5:]}:{t}" for n, t in zip(names, texts)], dtype=object)

    got = tr.translate_with_model(frame(spark, ROWS), make)
    got = {r["docname"]: r["translated_text"] for r in got.collect()}
    assert got["1"] == "MANCE:>>es<< " + ROWS[0][2]
    assert got["2"] == "fr-es:Le roi et la reine" and got["6"] == "ca-es:el rei"
    assert got["3"] == "The rey de la casa" and got["4"] is None and got["5"] is None
    assert len(got) == len(ROWS)
