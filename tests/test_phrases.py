import random
import re

import pytest
from pyspark.sql import functions as F

from glotta.operators import phrases as ph
from glotta.plans import registry

LEXICON = [("en", "house", "casa"), ("en", "White House", "Casa Blanca"), ("en", "white", "blanco"), ("en", "the white house of", "X"),
           ("en", "of course", "claro"), ("fr", "maison", "casa"), ("fr", "pomme de terre", "patata"), ("fr", "pomme", "manzana"),
           ("en", "house", "aaa"), ("en", "!!", "nothing"), ("fr", "l'eau", "el agua"), ("en", "course", "curso")]


def brute(text, lang, entries):
    """Every longest match from the left, by trying all entries at every word."""
    own = {p: es for (l, p), es in entries.items() if l == lang}
    out, at = [], 0
    words = [m.span() for m in re.finditer(r"\w+", text)]
    i = 0
    while i < len(words):
        best = None
        for n in range(1, 6):
            span = words[i:i + n]
            if len(span) == n and all(text[a[1]:b[0]].isspace() for a, b in zip(span, span[1:])):
                key = " ".join(text[s:e].lower() for s, e in span)
                if key in own:
                    best = n, own[key]
        if best:
            out += [text[at:words[i][0]], best[1]]
            at = words[i + best[0] - 1][1]
            i += best[0]
        else:
            i += 1
    return "".join(out) + text[at:]


def plain(lexicon):
    out = {}
    for lang, phrase, es in lexicon:
        key = lang, " ".join(re.findall(r"\w+", phrase.lower()))
        if key[1]:
            out[key] = min(es, out.get(key, es))
    return out


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "lang string, token string, es_token string")


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    words = ["the", "White", "house", "of", "course", "HOUSE", "pomme", "de", "terre", "maison", "é", "white"]
    gaps = [" ", "  ", "\n", ", ", " - ", " ", "."]
    rows = [(i, rng.choice(["en", "fr", "es", None]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 12))))
            for i in range(300)]
    rows += [(900, "en", None), (901, "en", ""), (902, "en", "..."), (903, "en", "the white house"), (904, "en", "the white house of cards"),
             (905, "fr", "l eau, l'eau"), (906, "en", "white house " * 5000), (906, "en", "white"), (None, "en", "of  course!")]
    return rows


def test_both_paths_equal_brute_force(spark, texts, lexicon):
    df = spark.createDataFrame(texts, "id long, language string, cleaned_text string")
    entries = plain(LEXICON)
    want = sorted(((i, lang, None if t is None else brute(t, lang, entries)) for i, lang, t in texts), key=repr)
    for bound in (ph.MAX_TRIE_ROWS, 0):
        got = ph.translate_phrases(df, lexicon, max_trie_rows=bound)
        assert got.columns == ["id", "language", "translated_text"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    some = {r["id"]: r["translated_text"] for r in ph.translate_phrases(df, lexicon).collect()}
    assert some[903] == "the Casa Blanca" and some[904] == "X cards" and some[905] == "el agua, l'eau"


def test_no_entries(spark, texts, lexicon):
    df = spark.createDataFrame(texts, "id long, language string, cleaned_text string")
    for bound in (ph.MAX_TRIE_ROWS, -1):
        got = ph.translate_phrases(df, lexicon.limit(0), max_trie_rows=bound).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(texts, key=repr)
    assert ph.translate_phrases(df.limit(0), lexicon).collect() == []


def test_given_texts_by_both_paths(spark, sf_dir):
    docs = registry.cleaned(spark, sf_dir).select("docname", "language", "cleaned_text")
    lexicon = registry.phrase_lexicon(spark, sf_dir)
    a, b = (sorted(map(tuple, ph.translate_phrases(docs, lexicon, max_trie_rows=n).collect())) for n in (ph.MAX_TRIE_ROWS, 0))
    assert a == b and a != sorted((d, lang, t) for d, lang, t in docs.collect())
    assert lexicon.select(F.size(F.split("token", " ")).alias("n")).distinct().count() == 4


def test_only_texts_of_languages_with_entries_are_cut(spark, texts, lexicon, monkeypatch):
    """Texts of other languages, most of a corpus, cost nothing; the first words of entries alone are looked up one by one."""
    df = spark.createDataFrame(texts, "id long, language string, cleaned_text string")
    cut = ph._pieces
    monkeypatch.setattr(ph, "_pieces", lambda text: F.when(F.col("language") == "en", cut(text)).otherwise(
        F.raise_error(F.lit("cut in vain")).cast("array<string>")))
    got = ph.translate_phrases(df, lexicon.filter("lang = 'en'")).collect()
    entries = plain([e for e in LEXICON if e[0] == "en"])
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((i, lang, None if t is None else brute(t, lang, entries)) for i, lang, t in texts), key=repr)


def test_entries_of_a_null_language(spark):
    df = spark.createDataFrame([(1, None, "a white b"), (2, "en", "a white b"), (3, None, None), (4, "fr", "")],
                               "id long, language string, cleaned_text string")
    lexicon = spark.createDataFrame([(None, "white", "x"), ("fr", "a", "y")], "lang string, token string, es_token string")
    got = sorted(tuple(r) for r in ph.translate_phrases(df, lexicon).select("id", "translated_text").collect())
    assert got == [(1, "a x b"), (2, "a white b"), (3, None), (4, "")]
