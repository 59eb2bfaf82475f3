import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from glotta.llm import prefix_trie as pt
from glotta.llm.oracles import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string"


def remainder(c, m):
    return c - m * int(c / m)


def rebuilt(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            by[conv].append(((turn is not None, turn), told, role, text))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - remainder(c, 20), [])[:h] + own[h:]
    return out


def brute(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, ms in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(ms) - 1) * words
            leaves[node[:d]] += not children[node]
    out = []
    for node, ms in members.items():
        ends = sorted(c for c in ms if len(paths[c]) == len(node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == pt.NODE
    return sorted(map(tuple, df.collect()), key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(pt.prefix_trie(pt.rebuilt_paths(df))) == brute(rebuilt(rows))


def talk(rng, convs, said, turns):
    return [(c, t, rng.choice(["user", "assistant"]) if said > 2 else "user", f"say {rng.randrange(said)}" * rng.randint(1, 2))
            for c in convs for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("parts", ["1", "2", "13"])
def test_equal_to_brute_force(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rng = random.Random(int(parts))
        check(spark, talk(rng, range(150), 2, 5))
        # One text only: all paths lie on one line, so that most nodes span many shards; gaps leave hosts out.
        check(spark, [(c, t, "user", "the same") for c in range(-45, 300, 3) for t in range(1 + c % 7)])
        # A large group of copies between others, and long paths.
        rows = talk(rng, range(1000, 1040), 9, 4) + [(c, t, "user", f"copy {t}") for c in range(200) for t in range(4)]
        check(spark, rows + [(c, t, "user", "long") for c in (401, 402, 423) for t in range(60 + c % 3)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shards_of_any_size_give_the_same_nodes():
    """The stack alone, over every way to cut sorted paths in three."""
    rng = random.Random(3)
    step = lambda ch, w: ch * 16 + w.to_bytes(8, "big")
    rows = sorted((b"".join(step(rng.choice([b"a", b"b"]), 3) for _ in range(rng.randint(0, 4))), c) for c in range(12))
    want = None
    for i in range(1, 11):
        for j in range(i + 1, 12):
            shards = [rows[:i], rows[i:j], rows[j:]]
            within = [pt._common(s[0][0], s[-1][0]) for s in shards]
            across = [pt._common(a[-1][0], b[0][0]) for a, b in zip(shards, shards[1:])]
            sums = defaultdict(lambda: [0, 0, 0, 0, b"", set()])
            for k, shard in enumerate(shards):
                run = pt.Shard(k, within, across)
                for row in shard:
                    run.add(*row)
                run.end()
                for n, r in enumerate(run.out):
                    key = (r[8], r[1]) if r[8] is not None else ("local", k, n)
                    for at in range(4):
                        sums[key][at] += r[3 + at]
                    if r[8] is not None:
                        sums[key][4] += (b"," if sums[key][4] and r[11] else b"") + r[11]
                    sums[key][5].add((r[0], r[1], None if r[8] is not None else r[7]))
            nodes = sorted((min(c for c, _, _ in v[5]), max(d for _, d, _ in v[5]), *v[:4],
                            hashlib.sha256(v[4]).hexdigest() if k[0] != "local" else max(e for _, _, e in v[5]))
                           for k, v in sums.items())
            want = want or nodes
            assert nodes == want


def test_odd_rows(spark, nothing):
    rows = [(0, 1, "user", "a b"), (0, None, None, None), (0, 1, "user", "a b"), (0, 1, "user", "A"), (1, 0, "user", ""),
            (1, 0, None, "x\ty\x0bz"), (1, 1, "user", "w " * 50_000), (2, None, None, None), (45, 0, "a", "b"), (46, 0, "a", "b"),
            (47, 0, "ab", ""), (48, 0, "a", "b"), (None, 0, "user", "lost"), (None, None, None, None), (-7, 0, "u", "v"),
            (-7, 0, "u", "v"), (2**62, 0, "u", "\xa0 é"), (-(2**62), 3, "u", "v")]
    check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumns({c: F.lit("x") for c in ("host", "keys", "first", "path", "part", "shard", "depth", "owner")})
    assert got(pt.prefix_trie(pt.rebuilt_paths(clash))) == brute(rebuilt(rows))
    assert got(pt.prefix_trie(pt.rebuilt_paths(df.limit(0)))) == []
    only_null = df.filter("conv_id is null")
    assert got(pt.prefix_trie(pt.rebuilt_paths(only_null))) == []


def test_turnless_conversations_are_in_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(40, 60) if c != 40]
    paths = rebuilt(rows)
    assert any(not p for p in paths.values())
    check(spark, rows)


def test_query_equals_its_sql(spark, sf_dir):
    df = pt.op11_splitter_skeleton_trie(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf_dir}/conversations.parquet')")
    cursor = con.execute(ORACLE_SQL["op11_splitter_skeleton_trie"])
    assert [c[0] for c in cursor.description] == df.columns
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(df) == sorted(cursor.fetchall(), key=repr) == brute(rebuilt(map(tuple, rows)))
