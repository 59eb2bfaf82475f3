import pytest
from pyspark.sql import functions as F

from glotta.functions import tagging, tokens as fx
from glotta.operators.arrays import distinct_values
from glotta.operators import normalization as nz

# Words and stems from the published sample vocabulary of the Spanish Snowball stemmer.
STEMS = """chihuahua chihuahu  chica chic  chicago chicag  chicas chic  chico chic  chicos chic  chila chil  chile chil
chilena chilen  chilenas chilen  chileno chilen  chilenos chilen  chilpancingo chilpancing  china chin  chinas chin
chinchilla chinchill  chino chin  chinos chin  chiquitas chiquit  torá tor  tórax torax  torcer torc  toreado tor
toreados tor  toreándolo tor  torear tor  toreara tor  torearlo tor  toreó tore  torero torer  toreros torer
torio tori  tormenta torment  tormentas torment  tornado torn  tornados torn  tornar torn  tornen torn  torneo torne
torneos torne  tornillo tornill  tornillos tornill  torniquete torniquet  torno torn  toro tor  toronto toront
toros tor  torpedearon torped  torpeza torpez  torrado torr  torralba torralb  torre torr  torrencial torrencial
torrenciales torrencial  torrente torrent  torreon torreon  torreón torreon  torres torr  torrescano torrescan""".split()


def test_tokenize_keeps_punctuation_and_order(spark):
    df = spark.createDataFrame([("Hola, ¿qué_tal? año-2",)], "t string")
    got = df.select(fx.tokenize(F.col("t")).alias("x")).first()["x"]
    assert got == ["Hola", ",", "¿", "qué_tal", "?", "año", "-", "2"]


def test_steps(spark):
    df = spark.createDataFrame([(["La", "casa", "la", "Roja", "casa"],)], "t array<string>")
    row = df.select(fx.lowercase(F.col("t")).alias("low"), fx.dedupe(F.col("t")).alias("set"),
                    fx.remove_stopwords(F.col("t")).alias("stop")).first()
    assert row["low"] == ["la", "casa", "la", "roja", "casa"]
    assert row["set"] == ["La", "Roja", "casa", "la"]
    assert row["stop"] == ["casa", "Roja", "casa"]


def test_normalize(spark):
    df = spark.createDataFrame([("1", "La CASA y la casa roja."), ("2", ""), ("3", None), ("4", "de la")],
                               "docname string, translated_text string")
    got = {r["docname"]: r["normalized_text"] for r in nz.normalize_documents(df).collect()}
    assert got == {"1": [".", "casa", "roja"], "2": None, "3": None, "4": []}
    kept = nz.nonempty_normalized(nz.normalize_documents(df))
    assert [r["docname"] for r in kept.collect()] == ["1"]


TOKENS = [("1", ["Casa", "perro", "rojo"]), ("2", []), ("3", None), ("4", ["xyz"])]


@pytest.mark.parametrize("tier", ["inline", "broadcast", "shuffle"])
def test_vocabulary(spark, monkeypatch, tier):
    if tier != "inline":
        monkeypatch.setattr(nz, "inline_rows", lambda lookup: None)
    bound = 0 if tier == "shuffle" else 1000
    df = spark.createDataFrame(TOKENS, "docname string, normalized_text array<string>")
    vocabulary = spark.createDataFrame([("casa",), ("rojo",), ("rojo",)], "word string")
    got = nz.keep_in_vocabulary(df, vocabulary, ["docname"], max_broadcast_rows=bound)
    assert dict(got.select("docname", "normalized_text").collect()) == {
        "1": ["Casa", "rojo"], "2": [], "3": None, "4": []}
    none = nz.keep_in_vocabulary(df, vocabulary.limit(0), ["docname"], max_broadcast_rows=bound)
    assert dict(none.select("docname", "normalized_text").collect()) == {"1": [], "2": [], "3": None, "4": []}
    assert nz.keep_in_vocabulary(df, None, ["docname"]) is df


LEMMA_TOKENS = [("1", ["canciones", "días", "rápidamente", "rojas", "famosas", "es", "123", ".", "cantar", "veces"]),
                ("2", []), ("3", None), ("4", ["es"])]


@pytest.mark.parametrize("tier", ["inline", "broadcast", "shuffle"])
def test_lemmas(spark, monkeypatch, tier):
    if tier != "inline":
        monkeypatch.setattr(nz, "inline_rows", lambda lookup: None)
    df = spark.createDataFrame(LEMMA_TOKENS, "docname string, normalized_text array<string>")
    got = nz.lemmatize_pos_filter(df, ["docname"], max_broadcast_rows=0 if tier == "shuffle" else 1000)
    assert dict(got.select("docname", "lemmatized_text").collect()) == {
        "1": ["canción", "día", "roja", "famoso", "vez"], "2": [], "3": None, "4": []}
    assert [r["docname"] for r in nz.nonempty_lemmas(got).collect()] == ["1"]


@pytest.mark.parametrize("bound", [1000, 0])
def test_stems(spark, bound):
    words, want = STEMS[::2], STEMS[1::2]
    df = spark.createDataFrame([(1, words), (2, [])], "d int, lemmatized_text array<string>")
    got = dict(nz.stem_documents(df, max_broadcast_rows=bound).collect())
    assert got[2] == []
    got = got[1]
    assert {w: g for w, g, x in zip(words, got, want) if g != x} == {}


def test_stem_rules(spark):
    cases = {"rápidamente": "rapid", "naciones": "nacion", "nación": "nacion", "facilidades": "facil",
             "absolutamente": "absolut", "haciéndolas": "hac", "sociología": "sociolog", "paguen": "pag",
             "distribuyendo": "distribu", "existencia": "existent", "a": "a", "y": "y", "1984": "1984", "": ""}
    df = spark.createDataFrame([(1, list(cases))], "d int, lemmatized_text array<string>")
    got = dict(nz.stem_documents(df).collect())[1]
    different = {w: (g, x) for (w, x), g in zip(cases.items(), got) if g != x}
    assert different == {}


def test_ruled_out_endings_change_no_class(spark):
    from glotta.functions import tagging
    stems = ["", "x", "cant", "ñandú", "a1", "Ópera", "日本", "_", "¿", "rápid"]
    ends = sorted({*(e for p, _ in tagging.POS_RULES[2:] for e in
                     "mente ción sión ciones siones dad dades tad tades miento mientos ismo ismos ista istas eza ezas aje ajes ando "
                     "iendo ar er ir aron ieron aban ían oso osas ivo ivas ica icos ado adas ido idas able ibles al ales".split()),
                   "", "s", "es", "ces", "ing", "the", "o", "\n", "ar\n", "s\u0085"})
    df = spark.createDataFrame([(a + b,) for a in stems for b in ends], "t string")
    plain = F.lit(tagging.DEFAULT_POS)
    for pattern, pos in reversed(tagging.POS_RULES):
        plain = F.when(F.col("t").rlike(pattern), pos).otherwise(plain)
    rows = df.select("t", tagging.rule_pos(F.col("t")).alias("got"), plain.alias("want")).withColumn(
        "lemma", tagging.rule_lemma(F.col("t"), F.col("want"))).withColumn("full", tagging._rule_lemma(F.col("t"), F.col("want")))
    assert rows.filter("got <> want or lemma <> full").collect() == [] and rows.filter("got is null or lemma is null").count() == 0


def test_large_vocabulary_is_looked_up_where_the_tokens_are(spark):
    rows = [("a", ["w1", "W2", "no", "w300"]), ("a", ["w1", "W2", "no", "w300"]), (None, ["no"]), ("c", []), ("d", None)]
    df = spark.createDataFrame(rows, "docname string, normalized_text array<string>")
    words = spark.range(1000).select(F.concat(F.lit("w"), "id").alias("word")).unionByName(spark.sql("select cast(null as string) word"))
    small = nz.keep_in_vocabulary(df, words, ["docname"])
    large = nz.keep_in_vocabulary(df, words, ["docname"], max_broadcast_rows=0)
    want = [("a", ["w1", "W2", "w300"])] * 2 + [(None, []), ("c", []), ("d", None)]
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, large.collect()), key=repr) == sorted(want, key=repr)
    for made in (small, nz.stem_documents(df, "normalized_text")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Generate" not in plan


def test_rules_over_distinct_words_equal_the_rules(spark):
    words = ("casas rojas luces naciones misiones papeles meses bellas famosas útil rápidamente comer comían 5as x2 _ ¿ a\n cosas\r\n "
             "luces\n\n es\u0085 İs ٣ mente ciudad ideas").split(" ") + ["", None]
    df = spark.createDataFrame([(words,), (None,), ([],), (words[:3] * 2,)], "t array<string>")
    pos = df.select(F.transform("t", tagging.rule_pos).alias("a"), distinct_values(F.col("t"), "string", tagging.rule_pos_of).alias("b"))
    for r in pos.collect():
        assert (r["a"] and r["a"][:-1]) == (r["b"] and r["b"][:-1])
    for kind in ("NOUN", "ADJ"):
        same = df.select(F.transform("t", lambda t: tagging.rule_lemma(t, F.lit(kind))).alias("a"), distinct_values(
            F.col("t"), "string", lambda own: tagging.rule_lemma_of(own, fx_pos(kind, len(own)))).alias("b"))
        assert all(r["a"] == r["b"] for r in same.collect())


def fx_pos(kind, n):
    import pyarrow as pa
    return pa.repeat(pa.scalar(kind), n)


def test_lemmas_keep_nulls_and_documents(spark):
    df = spark.createDataFrame([("1", ["casas", None, "comer"]), ("2", None), ("3", [])], "docname string, normalized_text array<string>")
    got = nz.lemmatize_pos_filter(df, ["docname"])
    assert dict(got.collect()) == {"1": ["casa", None], "2": None, "3": []}
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
