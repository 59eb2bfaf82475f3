import hashlib
import math

import pytest

from glotta.operators.ranking import at_least_first, first_by_hash, hash_rank, order_rank
from glotta.plans import registry
from pyspark.sql import functions as F


def order(rows, seed):
    return sorted(rows, key=lambda k: (hashlib.md5(f"{seed}|{k}".encode()).hexdigest(), k))


def test_hash_rank_equals_a_sort_with_one_hot_group(spark):
    rows = [(i, "hot" if i % 10 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = {(r["g"], r["id"]): r["rank"] for r in hash_rank(df, ["id"], 53, within=["g"]).collect()}
    for group in ("hot", None):
        for want, key in enumerate(order([i for i, g in rows if g == group], 53), start=1):
            assert got[(group, key)] == want


def test_global_rank(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = [r["k"] for r in hash_rank(df, ["k"], 1).orderBy("rank").collect()]
    assert got == order(list(range(500)), 1)


@pytest.mark.parametrize("n", [1, 9, 10, 101, 2000])
def test_first_by_hash_takes_exactly_the_share(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = first_by_hash(df, ["k"], 53, F.ceil(F.col("n") * F.lit(0.1))).collect()
    assert len(got) == n
    want = set(order(list(range(n)), 53)[:math.ceil(0.1 * n)])
    assert {r["k"] for r in got if r["selected"]} == want


def test_order_rank_of_many_ties(spark):
    rows = [(f"w{i}", 1 if i % 10 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "word string, n long")
    got = order_rank(df, [F.desc("n"), F.col("word")])
    assert got.columns == ["word", "n", "rank"]
    want = {r: k for k, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert {(r["word"], r["n"]): r["rank"] for r in got.collect()} == want
    assert order_rank(df.limit(0), [F.desc("n"), F.col("word")]).count() == 0


def test_more_vectors_than_the_old_bound(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    more = spark.range(120_000).select(F.col("id").cast(given.schema["vec_id"].dataType).alias("vec_id"),
                                       F.array(F.col("id").cast("float")).alias("embedding"))
    more.write.parquet(f"{tmp_path}/embeddings.parquet")
    (tmp_path / "documents.parquet").symlink_to(f"{sf_dir}/documents.parquet")
    counts = registry.word_frequencies(spark, str(tmp_path)).collect()
    words = [r["word"] for r in sorted(counts, key=lambda r: (-r["n"], r["word"]))]
    bound = {r["word"]: r["embedding"][0] for r in registry.bound_word_vectors(spark, str(tmp_path)).collect()}
    assert bound == {w: float(k) for k, w in enumerate(words)}


def test_only_numbers_that_can_be_first_stay(spark):
    counts = [1] * 500 + [2] * 50 + [31, 32, 33, 63, 64, 65, 1000, 1001, 10**9]
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(counts)], "word string, n long")
    for want in (-1, 0, 1, 3, 5, 9, 10, 59, 60, 559, 10**6):
        kept = sorted((r["n"] for r in at_least_first(df, want).collect()), reverse=True)
        assert kept == sorted(counts, reverse=True)[:len(kept)] and len(kept) >= min(max(want, 0), len(counts))
    assert at_least_first(df, 9).count() < 100
    assert at_least_first(df.limit(0), 5).count() == 0
