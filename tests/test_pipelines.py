import pytest
from pyspark.sql import functions as F

from glotta.operators.language import fit_language_profiles
from glotta.operators.classification import train_classifier
from glotta.plans import pipelines, registry
from glotta.streaming.scoring import score_stream

KEY = ["docname"]


@pytest.fixture(scope="module")
def scorer(spark, sf_dir):
    words = registry.bound_word_vectors(spark, sf_dir)
    profiles = fit_language_profiles(registry.cleaned(spark, sf_dir))
    model = train_classifier(registry.labelled(spark, sf_dir, words), "label")
    return lambda docs: pipelines.score_documents(docs, KEY, profiles, words, model)


@pytest.fixture(scope="module")
def scored(spark, sf_dir, scorer):
    return {r["docname"]: r for r in scorer(registry.corpus(spark, sf_dir)).collect()}


def test_every_document_is_scored_once(spark, sf_dir, scored):
    docs = registry.raw_documents(spark, sf_dir)
    assert len(scored) == docs.count()
    right = sum(scored[r["docname"]]["detected_language"] == r["language"] for r in docs.collect())
    assert right >= 0.98 * len(scored)
    classes = sum(scored[r["docname"]]["class_"] == r["language"] for r in docs.collect())
    assert classes >= 0.9 * len(scored)
    assert all(r["probability"] is None or 0 < r["probability"] <= 1 for r in scored.values())


def test_odd_documents_keep_their_row(spark, scorer):
    rows = [("empty", ""), ("digits", "12 34"), ("null", None), ("unknown", "zzzz qqqq")]
    got = {r["docname"]: r for r in scorer(spark.createDataFrame(rows, "docname string, text string")).collect()}
    assert set(got) == {"empty", "digits", "null", "unknown"}
    assert got["empty"]["class_"] is None and got["digits"]["detected_language"] is None
    assert got["unknown"]["class_"] is None and got["unknown"]["detected_language"] is not None


def test_partitioning_does_not_change_the_answer(spark, sf_dir, scorer, scored):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        docs = registry.raw_documents(spark, sf_dir).repartition(5)
        again = {r["docname"]: r for r in scorer(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {k: r["class_"] for k, r in again.items()} == {k: r["class_"] for k, r in scored.items()}


def test_stream_equals_batch(spark, sf_dir, scorer, scored, tmp_path):
    docs = registry.raw_documents(spark, sf_dir)
    docs.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        score_stream(stream, scorer, out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 2
    assert {r["docname"]: r["class_"] for r in got.collect()} == {k: r["class_"] for k, r in scored.items()}
    assert got.count() == len(scored)


def test_labelled_vectors_and_lemmas(spark, sf_dir):
    docs = registry.raw_documents(spark, sf_dir)
    store = registry.store(spark, sf_dir)
    made = pipelines.labelled_vectors(docs, store, registry.bound_word_vectors(spark, sf_dir), ["context", "language", "docname"])
    assert 0 < made.count() <= store.count() and "context" in made.columns
    lemmas = pipelines.lemmatized_corpus(store, KEY, stems=True)
    assert lemmas.filter(F.size("stemmed_text") != F.size("lemmatized_text")).count() == 0


@pytest.mark.parametrize("folder", [True, False])
def test_stream_reads_a_table_of_one_file_or_of_several(spark, tmp_path, folder):
    docs = spark.range(6).selectExpr("id doc_id", "concat('text ', id) text", "'en' lang", "'src' source")
    name = tmp_path / "documents.parquet"
    docs.repartition(3 if folder else 1, "doc_id").write.parquet(str(name if folder else tmp_path / "made"))
    if not folder:
        name.write_bytes(next((tmp_path / "made").glob("part-*.parquet")).read_bytes())
    out = str(tmp_path / "out")
    score_stream(registry.arriving_documents(spark, str(tmp_path)), lambda df: df, out, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["docname"] for r in spark.read.parquet(out).collect()) == [str(i) for i in range(6)]
