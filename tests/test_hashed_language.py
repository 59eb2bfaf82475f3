import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glotta.operators import hashed_language as hl
from glotta.operators import language
from glotta.plans import registry

TRAIN = [("a", "en", "the house of the king"), ("b", "es", "la casa de los reyes"), ("c", "fr", "la maison du roi est là"),
         ("d", None, "no one knows"), ("e", "en", None)]


@pytest.fixture(scope="module")
def profiles(spark):
    return hl.fit_hashed_profiles(spark.createDataFrame(TRAIN, "docname string, language string, cleaned_text string"))


def letters(text):
    out = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    return " " + " ".join(out.split()) + " " if out.split() else " "


def marks(text):
    p = [ord(c) for c in letters(text)]
    for a, b, c in zip(p, p[1:], p[2:]):
        f, places, begins = hl.FACTORS, hl.PLACES, hl.BEGINS
        yield (c % places[0], (b * f[1] + c * f[2]) % places[1] + begins[1], (a * f[0] + b * f[1] + c * f[2]) % places[2] + begins[2])


def brute(text, profiles):
    found = list(marks(text))
    if not found:
        return None
    seen = profiles.counts.sum(axis=1) > 0
    scores = [sum(int(profiles.scores[t if seen[t] else b if seen[b] else u, i]) for u, b, t in found)
              for i in range(len(profiles.languages))]
    best = scores.index(max(scores))
    known = sum(profiles.counts[t, best] > 0 for _, _, t in found)
    return profiles.languages[best] if known >= 0.6 * len(found) else "unknown"


def test_counts_by_hand(profiles):
    assert profiles.languages == ["en", "es", "fr"]
    want = np.zeros_like(profiles.counts)
    for _, lang, text in TRAIN:
        if lang and text:
            for places in marks(text):
                want[list(places), profiles.languages.index(lang)] += 1
    assert np.array_equal(profiles.counts, want)


TEXTS = ["the king", "los reyes de la casa", "maison du roi", "", "12 34!", None, "qqq www", "là est", "a", "𐌰𐌱 𐌰", "ñandú!",
         "the " * 3000, "Ünïcode là LÀ", "\x00\n\t", "the house\x00of"]


def test_labels_equal_brute_force(spark, profiles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, "the king")], "id long, cleaned_text string")
    rows = language.detect_language(df, profiles, ["id"]).collect()
    got = {r["id"]: r["detected_language"] for r in rows}
    assert len(rows) == len(TEXTS) + 1 and got[None] == "en"
    for i, t in enumerate(TEXTS):
        assert got[i] == (None if t is None else brute(t, profiles)), t
    added = language.add_detected_language(df, profiles, ["id"])
    assert added.columns == ["id", "cleaned_text", "detected_language"]
    assert {r["id"]: r["detected_language"] for r in added.collect()} == got


def test_runs_of_any_size_give_the_same(profiles, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("the king casa de los roi maison là".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    column = pa.array([letters(t) for t in texts] + [None])
    any_ = profiles.counts.sum(axis=1) > 0
    whole = hl._detected(column, profiles, any_, 0.6)
    monkeypatch.setattr(hl, "CHUNK", 50)
    assert hl._detected(column, profiles, any_, 0.6) == whole == [brute(t, profiles) for t in texts] + [None]
    assert hl._detected(column.slice(7, 20), profiles, any_, 0.6) == whole[7:27]


def test_no_profiles(spark):
    df = spark.createDataFrame([("x", "en", None)], "docname string, language string, cleaned_text string")
    made = hl.fit_hashed_profiles(df)
    assert made.languages == []
    assert hl.detect_hashed(df, made, ["docname"]).collect() == [("x", None)]
    many = spark.range(300).select(F.col("id").cast("string").alias("language"), F.lit("text").alias("cleaned_text"))
    with pytest.raises(ValueError):
        hl.fit_hashed_profiles(many)


def test_held_out_documents(spark, sf_dir):
    rows = registry.language_accuracy_by_length(spark, sf_dir).collect()
    assert sum(r["correct"] for r in rows) >= 0.95 * sum(r["n"] for r in rows)


def test_same_labels_as_whole_trigram_profiles(spark, sf_dir):
    docs = registry.cleaned(spark, sf_dir)
    old = language.detect_language(docs, language.fit_language_profiles(docs), ["docname"])
    new = language.detect_language(docs, hl.fit_hashed_profiles(docs), ["docname"])
    same = old.alias("a").join(new.alias("b"), "docname").filter(F.expr("a.detected_language <=> b.detected_language")).count()
    assert same >= 0.99 * docs.count()
