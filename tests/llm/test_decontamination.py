import re

import pytest

from glotta.llm import decontamination as dc

SEPARATOR = re.compile(r"[\x20\x09-\x0D!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+")


def words(text):
    return [w for w in SEPARATOR.split(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]


def brute(docs, items):
    """``{(doc_id, item_id)}`` by comparing the shingles of every document with every item."""
    found = set()
    parts = []
    for item, text in items:
        lines = [words(x) for x in (text or "").split("\n", 1)]
        if sum(map(len, lines)) >= dc.MIN_WORDS:
            parts.append((item, [{tuple(x[i:i + 5]) for i in range(len(x) - 4)} or {tuple(x)} for x in lines if x]))
    for doc, text in docs:
        own = words(text)
        grams = {tuple(own[i:i + k]) for k in range(1, 6) for i in range(len(own) - k + 1)}
        for item, wanted in parts:
            if all(len(p & grams) >= dc.OVERLAP * len(p) for p in wanted):
                found.add((doc, item))
    return found


@pytest.fixture(scope="module")
def items(spark, odd_rows):
    text = odd_rows[3][1] or "seven words of a text that counts"
    rows = [(1, " ".join(text.split()[:30])), (1, " ".join(text.split()[:30])), (2, None), (3, ""), (4, "one"),
            (5, "What is it?\n" + " ".join(text.split()[:12])), (6, "not to be found in any of them at all"), (None, text)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_rows_equal_brute_force(odd, odd_rows, items):
    got = {(r.doc_id, r.item_id) for r in dc.leaks(odd, items).collect()}
    want = brute([(r[0], r[1]) for r in odd_rows], [tuple(r) for r in items.collect()])
    assert got == want and want


def test_decontaminate_drops_only_leaks(odd, odd_rows, items):
    kept = dc.decontaminate(odd, items)
    assert kept.columns == odd.columns
    bad = {d for d, _ in brute([(r[0], r[1]) for r in odd_rows], [tuple(r) for r in items.collect()])}
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert all((r[0], r[1]) in texts for r in odd_rows if r[0] not in bad)
    assert len(texts) < len({(r[0], r[1]) for r in odd_rows})


def test_several_passes_give_the_same(monkeypatch, odd, items):
    whole = {(r.doc_id, r.item_id) for r in dc.leaks(odd, items).collect()}
    monkeypatch.setattr(dc, "PASS_WORDS", 40)
    monkeypatch.setattr(dc, "SHARD", 2)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(odd, items).collect()} == whole


def test_retrieval_misses_no_piece_above_its_threshold():
    """The bounds of the blocks never hide a score: compared with scoring every piece for every passage."""
    import random

    import numpy as np

    from glotta.llm.words import split

    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40))) for _ in range(40)]
    index = dc.build_index(list(enumerate(texts)))
    docs = [" ".join(rng.choice(vocabulary[:50]) for _ in range(rng.randint(1, 600))) for _ in range(30)]
    docs += [d + " " + t for d, t in zip(docs, texts)]
    parsed = split([d.encode() for d in docs], lower=True, punctuation=True)
    got = dc.retrieve(index, parsed, parsed.hashes())
    shard = index.shards[0]
    want = set()
    for d, doc in enumerate(docs):
        own = split([doc.encode()], lower=True, punctuation=True).hashes()
        for at in range(0, max(1, len(own) - dc.STRIDE), dc.STRIDE):
            terms = np.intersect1d(own[at:at + 2 * dc.STRIDE], index.vocabulary)
            score = shard.impact[shard.row[np.searchsorted(index.vocabulary, terms)]].sum(axis=0)
            want |= {(d, int(shard.item[i])) for i in np.flatnonzero(score >= shard.threshold * (1 + 1e-5))}
    assert want <= set(got)


def test_empty(nothing, odd, items):
    assert dc.leaks(nothing, items).count() == 0
    assert dc.leaks(odd, items.limit(0)).count() == 0
    assert dc.decontaminate(odd, items.limit(0)).count() == odd.count()


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in dc.op4_bm25_decontamination(spark, sf_dir).collect()}
    assert got == brute(docs, items) and got
