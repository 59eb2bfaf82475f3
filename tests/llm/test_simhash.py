import re
from collections import Counter

import numpy as np
import xxhash

from glotta.llm import simhash
from glotta.llm.common import connected_components


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_roots(rows):
    """``{fingerprint: smallest fingerprint of its group}`` over all pairs."""
    prints = sorted({fp for _, fp in rows})
    parent = {p: p for p in prints}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= simhash.RADIUS:
                parent[find(b)] = find(a)
    return {p: find(p) for p in prints}


def brute_components(rows):
    """``{(id, fingerprint): smallest id}``."""
    root, least = brute_roots(rows), {}
    for id_, fp in rows:
        if id_ is not None:
            least[root[fp]] = min(least.get(root[fp], id_), id_)
    return {(id_, fp): least.get(root[fp]) for id_, fp in rows}


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = np.array(simhash.covering_masks(), dtype=np.uint64)
    rng = np.random.default_rng(0)
    assert len(masks) == 2 ** (simhash.RADIUS + 1) - 1
    for _ in range(20_000):
        bits = rng.choice(64, rng.integers(1, simhash.RADIUS + 1), replace=False)
        difference = np.uint64(sum(1 << int(b) for b in bits))
        assert (masks & difference == 0).any()


def test_odd_rows_equal_brute_force(odd, odd_rows):
    got = Counter((r.id, r.fp & (2**64 - 1), r.component_id) for r in simhash.group(odd).collect())
    rows = [(r[0], brute_fingerprint(r[1])) for r in odd_rows]
    want = brute_components(rows)
    assert got == Counter((*row, want[row]) for row in rows)


def test_split_buckets_lose_no_link(spark):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 2**63))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(300)}
    prints |= {int(x) for x in rng.integers(0, 2**63, 100)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(df, bucket=128)).collect()}
    want = brute_components([(i, p & (2**64 - 1)) for i, p in enumerate(signed)])
    by_component = {}
    for (i, _), component in want.items():
        by_component.setdefault(component, set()).add(roots.get(signed[i], signed[i]))
    assert all(len(x) == 1 for x in by_component.values())
    assert len({next(iter(x)) for x in by_component.values()}) == len(by_component)


def test_keep_one_keeps_one_of_each_group(odd, odd_rows):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = [(r[0], brute_fingerprint(r[1])) for r in odd_rows]
    components = brute_components(rows)
    found = [(r.doc_id, brute_fingerprint(r.text)) for r in kept.collect()]
    roots = brute_roots(rows)
    assert len({roots[fp] for _, fp in found}) == len(found) == len(set(roots.values()))
    assert all(id_ == components[id_, fp] for id_, fp in found)


def test_empty(nothing):
    assert simhash.group(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    want = {i: (f"{fp:016x}", c) for (i, fp), c in brute_components(rows).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9_covering_simhash(spark, sf_dir).collect()}
    assert got == want
