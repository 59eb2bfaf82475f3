import gzip
import os

import pytest
from pyspark.sql import functions as F

from glotta import scratch
from glotta.sources import corpus, translations, word_vectors
from glotta.operators import profiling


def test_tree_scan(spark, tmp_path):
    files = {("Wiki", "es", "año nuevo.txt"): "  hola\nmundo \n\n", ("APR", "en", "a+b %20.txt"): " x y ",
             ("PAN 11", "fr", "été"): " \n", ("APR", "en", "plain"): "one", ("Nil", "es", "nada é.txt"): "", ("Wiki", "es", "a+b"): ""}
    for (context, language, name), text in files.items():
        folder = tmp_path / "deep" / context / language
        os.makedirs(folder, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")
    got = {tuple(r)[:3]: r["text"] for r in corpus.scan_corpus(spark, str(tmp_path / "deep")).collect()}
    assert got == {key: text.strip() for key, text in files.items()}


TREE = [("Wiki", "es", "a+b %20=ü:1", " hola\nmundo \n"), (None, "es", "x", None), ("", "es", "x", "leer"), ("Nil", "fr", 'q"[{^#\'*?\\/', ""),
        ("Nil", "fr", "twice", "one"), ("Nil", "fr", "twice", "two"), ("__x", ".y", " z ", "z")]


def test_a_written_tree_is_the_tree_that_spark_writes(spark, tmp_path):
    df = spark.createDataFrame(TREE, "context string, language string, docname string, text string").repartition(3, "docname")
    corpus.write_hive_corpus(df, str(tmp_path / "own"))
    df.write.partitionBy(*corpus.KEYS).text(str(tmp_path / "spark"))

    def folders(name):
        return sorted(str(p.parent.relative_to(tmp_path / name)) for p in (tmp_path / name).rglob("part-*"))

    assert folders("own") == folders("spark") and len(folders("own")) == 5
    own, want = (sorted(map(repr, corpus.scan_hive_corpus(spark, str(tmp_path / n)).collect())) for n in ("own", "spark"))
    assert own == want


def test_an_empty_tree_and_a_session_left_as_it_was(spark, tmp_path):
    df = spark.createDataFrame([], "context string, language string, docname string, text string")
    before = spark.conf.get(corpus.LISTING)
    corpus.write_hive_corpus(df, f"file://{tmp_path}/empty tree")
    assert corpus.scan_hive_corpus(spark, f"file://{tmp_path}/empty tree").count() == 0
    assert spark.conf.get(corpus.LISTING) == before


def test_a_tree_is_written_without_a_process_for_each_file(spark, tmp_path):
    """Spark's writer leaves a checksum file, of which mode it sets by a process, beside each file on a local file system."""
    df = spark.range(40).select(F.lit("c").alias("context"), F.lit("es").alias("language"), F.col("id").cast("string").alias("docname"),
                                F.lit("t").alias("text"))
    corpus.write_hive_corpus(df, str(tmp_path / "tree"))
    names = [p.name for p in (tmp_path / "tree").rglob("*") if p.is_file() and "SUCCESS" not in p.name]
    assert len(names) == 40 and all(n.startswith("part-") for n in names)


def test_the_driver_does_not_list_the_files_of_a_tree(spark, tmp_path):
    rows = [("c", "es", f"d{i:03}", f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "context string, language string, docname string, text string")
    corpus.write_hive_corpus(df, str(tmp_path / "tree"))
    got = corpus.scan_hive_corpus(spark, f"file://{tmp_path}/tree")
    assert got.inputFiles() == [] and sorted(map(tuple, got.collect())) == rows
    os.remove(next((tmp_path / "tree").rglob("docname=d007/part-*")))
    (tmp_path / "tree/context=c/language=es/docname=d007/part-1.gz").write_bytes(gzip.compress(b" packed "))
    assert got.filter("docname = 'd007'").first()["text"] == "packed"


def test_a_filter_on_the_key_leaves_out_files(spark, tmp_path):
    df = spark.createDataFrame([("c", "es", "a", "one"), ("d", "es", "b", "two")], "context string, language string, docname string, text string")
    corpus.write_hive_corpus(df, str(tmp_path / "tree"))
    scanned = corpus.scan_hive_corpus(spark, str(tmp_path / "tree")).filter("context = 'c'")
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter") and [r["text"] for r in scanned.collect()] == ["one"]


@pytest.mark.parametrize("compressed", [True, False])
def test_word_vectors(spark, tmp_path, compressed):
    text = "3 4\nhola 0.1 -2 3e-2 4\naño 1 2 3 4 \n, 0 0 0 1\n"
    path = str(tmp_path / ("v.vec.gz" if compressed else "v.vec"))
    with (gzip.open if compressed else open)(path, "wt", encoding="utf-8") as f:
        f.write(text)
    got = {r["word"]: r["embedding"] for r in word_vectors.scan_word_vectors(spark, path).collect()}
    assert set(got) == {"hola", "año", ","}
    assert got["hola"] == pytest.approx([0.1, -2, 0.03, 4]) and got["año"] == [1.0, 2.0, 3.0, 4.0]


def test_translation_store(spark, tmp_path):
    docs = spark.createDataFrame([("c", "fr", str(i), f"t{i}") for i in range(50)] + [("d", "en", "x", "y")],
                                 "context string, language string, docname string, translated_text string")
    path = str(tmp_path / "store")
    translations.write_translations(docs, path)
    read = translations.read_translations(spark, path)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, docs.collect()))
    plan = read.filter("language = 'fr'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(language" in plan
    more = docs.select("context", "language", "docname").unionByName(
        spark.createDataFrame([("c", "fr", "missing")], "context string, language string, docname string"))
    found = translations.translation_lookup(more, read)
    assert dict(profiling.missing_translation_counts(found).collect()) == {False: 51, True: 1}
    assert translations.translated_only(found).count() == 51


def test_sample_peek_row(spark):
    df = spark.range(100).select(F.format_string("%03d", "id").alias("docname"))
    first = [r[0] for r in corpus.sample_n(df, 10, ["docname"]).collect()]
    assert len(set(first)) == 10
    assert first == [r[0] for r in corpus.sample_n(df.repartition(5), 10, ["docname"]).collect()]
    assert first != [r[0] for r in corpus.sample_n(df, 10, ["docname"], seed=1).collect()]
    assert [r[0] for r in corpus.peek(df, ["docname"], 2).collect()] == ["000", "001"]
    assert [r[0] for r in corpus.row_at(df, ["docname"], 42).collect()] == ["042"]
    assert corpus.row_at(df, ["docname"], 100).count() == 0


def test_value_counts_skip_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "language string")
    assert [tuple(r) for r in profiling.value_counts(df, "language").collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_shared_dir_is_the_session_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch.shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert scratch.new_path(spark, "t") != scratch.new_path(spark, "t")
    made = scratch.materialize(spark.range(3).toDF("x"), "t")
    assert made.count() == 3
