import random
from collections import Counter

import numpy as np

from glotta.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits):
    out = bytearray(text)
    for _ in range(edits):
        at, kind = rng.randint(0, len(out)), rng.randint(0, 2)
        if kind == 0:
            out.insert(at, rng.choice(b"abcd"))
        elif at < len(out) and kind == 1:
            del out[at]
        elif at < len(out):
            out[at] = rng.choice(b"abcd")
    return bytes(out)


def brute(docs, tau=ld.TAU):
    """Counter of ``(id, line_no, class id, class line, links, kept)`` by comparing all lines."""
    first, rows = {}, []
    for id_, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                place = (id_ is None, id_ or 0, n)
                rows.append((id_, n, line, place))
                first[line] = min(first.get(line, place), place)
    lines = sorted(first, key=lambda x: len(x.encode()))
    raw = [x.encode() for x in lines]
    counts = np.array([np.bincount(np.frombuffer(x, np.uint8), minlength=256) for x in raw], dtype=np.int32)
    parent, links = list(range(len(raw))), Counter()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(raw)):
        if len(raw[i]) < ld.MIN_BYTES:
            continue
        j = i + 1
        while j < len(raw) and len(raw[j]) <= len(raw[i]) + tau:
            if np.abs(counts[i] - counts[j]).sum() <= 2 * tau and distance(raw[i], raw[j]) <= tau:
                links[lines[i]] += 1
                links[lines[j]] += 1
                parent[find(i)] = find(j)
            j += 1
    root = {x: find(i) for i, x in enumerate(lines)}
    least = {}
    for x in lines:
        least[root[x]] = min(least.get(root[x], first[x]), first[x])
    out = Counter()
    for id_, n, line, place in rows:
        none, class_id, class_line = least[root[line]]
        out[id_, n, None if none else class_id, class_line, links[line], place == least[root[line]]] += 1
    return out


def test_banded_bit_parallel_distance():
    rng = random.Random(1)
    pairs = []
    for _ in range(2500):
        a = bytes(rng.choice(b"ab\0c") for _ in range(rng.randint(0, 30)))
        pairs.append((a, edited(rng, a, rng.randint(0, 5))))
    for tau in (1, 2, 3, 4):
        assert ld.within(pairs, tau).tolist() == [distance(a, b) <= tau for a, b in pairs]


def test_no_pair_within_tau_escapes_the_segments():
    rng = random.Random(2)
    for tau in (1, 2, 3):
        for _ in range(500):
            a = bytes(rng.choice(b"abc") for _ in range(rng.randint(12, 60)))
            b = edited(rng, a, tau)
            if a == b or len(b) < 8:
                continue
            short, long = sorted((a, b), key=len)
            index = set(ld.index_signatures(ld._Lines([short]), tau)[1].tolist())
            probe = set(ld.probe_signatures(ld._Lines([long]), tau, 8)[1].tolist())
            assert index & probe
            sketches = ld._Lines([a, b]).sketches()
            assert int(sketches[0] ^ sketches[1]).bit_count() <= 4 * tau


def test_classes_equal_brute_force(spark):
    rng = random.Random(3)
    base = [bytes(rng.choice(b"abcd efg") for _ in range(rng.randint(18, 60))).decode() for _ in range(30)]
    docs = []
    for i in range(80):
        lines = [edited(rng, rng.choice(base).encode(), rng.randint(0, 3)).decode() if rng.random() < 0.6
                 else rng.choice(["short", "", " ", "é" * 15, "x" * 25]) for _ in range(rng.randint(0, 6))]
        docs.append((i if i % 11 else None, "\n".join(lines) if lines else None))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ld.line_classes(df).select("id", "line_no", "class_id", "class_line_no", "n_links", "kept").collect()
    named = Counter(tuple(r) for r in got if r.id is not None)
    assert named == Counter({k: v for k, v in brute(docs).items() if k[0] is not None})
    assert len(got) == sum(brute(docs).values())


def test_odd_rows(odd, odd_rows):
    out = ld.drop_repeated_lines(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    lines = Counter(x.strip(" \t\r\x0b\x0c") for r in rows for x in (r.text or "").split("\n"))
    repeated_rows = {r[1] for r, n in Counter((r[0], r[1]) for r in odd_rows).items() for r in [r] if n > 1}
    allowed = {x.strip(" \t\r\x0b\x0c") for t in repeated_rows for x in (t or "").split("\n")} | {""}
    assert all(n == 1 for x, n in lines.items() if x not in allowed)
    everything = {x.strip(" \t\r\x0b\x0c") for r in odd_rows for x in (r[1] or "").split("\n")}
    gone = everything - set(lines)
    assert all(any(distance(x.encode(), y.encode()) <= ld.TAU for y in lines if abs(len(x) - len(y)) <= 2) for x in gone)
    # Texts without a line of words are left alone.
    assert sum(r.text is None for r in rows) == sum(r[1] is None for r in odd_rows)
    assert sum(r.text == "" for r in rows) == sum(r[1] == "" for r in odd_rows)


def test_empty(nothing):
    assert ld.line_classes(nothing).count() == 0 and ld.drop_repeated_lines(nothing).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(map(tuple, ld.op10_segment_line_join(spark, sf_dir).collect()))
    assert got == brute(docs)
