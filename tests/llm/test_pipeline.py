"""Each stage of the pipeline against a brute-force version of it, on what the stage before it kept."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from glotta.llm import packing
from glotta.llm.common import materialize
from tests.llm import test_decontamination, test_line_dedup, test_outliers, test_packing, test_simhash


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, sf_dir), "test-stage")
        out.append((name, docs, made))
        docs = made
    return out


def pairs(df):
    return {(r.doc_id, r.text) for r in df.collect()}


def test_columns_stay(spark, sf_dir, stages):
    wanted = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(made.columns == wanted for _, _, made in stages[:-1])


def test_quality_rules(spark, sf_dir, stages):
    _, before, after = stages[0]
    kept = pairs(after)
    failed = {(i, t) for i, t in pairs(before) if test_outliers.base_failed(test_outliers.brute_counts(t))}
    assert failed and not failed & kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert {x for x in pairs(before) - failed if labels.get(x[0]) == 1} <= kept


def test_line_dedup_stage(stages):
    _, before, after = stages[1]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    gone = {}
    for (id_, n, _, _, _, kept), _ in test_line_dedup.brute(docs).items():
        if not kept:
            gone.setdefault(id_, set()).add(n)
    want = set()
    for id_, text in docs:
        left = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone.get(id_, ()))
        if id_ not in gone or left.strip():
            want.add((id_, left))
    assert pairs(after) == want and gone
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_simhash_stage(stages):
    _, before, after = stages[2]
    rows = [(r.doc_id, test_simhash.brute_fingerprint(r.text)) for r in before.collect()]
    components = test_simhash.brute_components(rows)
    assert {i for i, _ in pairs(after)} == {i for (i, _), c in components.items() if i == c}


def test_decontamination_stage(spark, sf_dir, stages):
    _, before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in test_decontamination.brute(pairs(before), items)}
    assert pairs(after) == {x for x in pairs(before) if x[0] not in bad} and bad


def test_packing_stage(stages):
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    test_packing.check_packing(after.collect(), sorted(pairs(before)), tokenizer)


def test_run_equals_its_stages(spark, sf_dir, stages):
    wanted = sorted(map(tuple, stages[-1][2].select("doc_id", "piece", "length", "ids_crc32").collect()))
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == wanted
