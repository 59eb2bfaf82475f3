import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from glotta.llm import merkle
from glotta.llm.oracles import ORACLE_SQL


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def grown(nodes):
    """All levels of one tree, the top last."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, i, node):
    """Siblings in turn, and the top that ``node`` leads to in the place of the i-th leaf."""
    siblings = []
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        siblings += run[:i % 3] + run[i % 3 + 1:]
        run[i % 3] = node
        node, i = h(*run), i // 3
    return siblings, node


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    by = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf(r))) for s in sources}
    trees = {s: grown([leaf(r) for r in by[s]]) for s in sources}
    top = grown([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", "") if hit and r[4] is not None else r[4]))
            low, node = climb(trees[s], i, node)
            high, node = climb(top, k, node)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*low, *high), node, node == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, merkle.verified_documents(df).collect()), key=repr)
    assert got == brute(rows)
    return got


@pytest.mark.parametrize("sizes", [[1], [2], [4], [1, 1], [1, 3, 10], [9, 27, 28, 1], [1] * 11])
def test_equal_to_brute_force(spark, sizes):
    rows = [(i * 7 % 31, f"s{k}", "en", i, f"line {i}\nnext" if i % 3 else f"one {i}") for k, n in enumerate(sizes)
            for i in range(n)]
    got = check(spark, rows)
    if max(sizes) > 3:
        assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark, odd, odd_rows, nothing):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows]
    renamed = odd.withColumns({"tree": F.lit(1), "rank": F.lit(2), "digest": F.lit("x"), "leaf": F.lit("y"), "path": F.lit(0)})
    got = merkle.verified_documents(renamed).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    empty = merkle.verified_documents(nothing)
    assert empty.collect() == [] and empty.columns == merkle.verified_documents(odd).columns


def test_null_source_first_and_bytewise_order(spark):
    check(spark, [(1, None, None, None, None), (2, "é", "fr", 1, "a\n"), (3, "z", "en", 2, ""), (4, "Z", "en", 2, "\n"),
                  (5, "😀", "en", 2, "\n"), (6, "￿", "en", 2, "b"), (None, "z", None, 3, "c\n"), (None, None, "en", None, "\n"),
                  (1, None, None, None, None), (-4, "z", "en", 0, "d\n")])


def test_requests_descend_alone(spark):
    rows = spark.range(50).select(F.col("id").alias("doc"), (F.col("id") % 2).alias("part"), merkle.leaf([F.col("id")]).alias("leaf"))
    made = merkle.manifest(rows, ["doc"], "part")
    everything = {(r["tree"], r["rank"]): r for r in merkle.prove(made).collect()}
    assert len(everything) == 50
    asked = spark.createDataFrame([(1, 0), (1, 24), (26, 7), (26, 99), (2, 0)], "tree long, rank long")
    got = {(r["tree"], r["rank"]): r for r in merkle.prove(made, asked).collect()}
    assert got == {k: everything[k] for k in [(1, 0), (1, 24), (26, 7)]}


def test_equal_subtrees_are_stored_once(spark):
    same = spark.range(27).select(F.lit(1).alias("doc"), F.lit("s").alias("part"), F.lit("ab" * 32).alias("leaf"))
    made = merkle.manifest(same, ["doc"], "part")
    assert made.trees.records.count() == 3 and merkle.prove(made).count() == 27
    assert made.root == grown(["ab" * 32] * 27)[-1][0]


def test_names_that_are_taken(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.range(1).select(F.lit("x").alias("leaf"), F.lit(1).alias("Rank"), "id"), ["id"], "id")


def test_query_equals_its_sql(spark, sf_dir):
    got = merkle.op12_merkle_manifest(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    cursor = con.execute(ORACLE_SQL["op12_merkle_manifest"])
    assert [c[0] for c in cursor.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
