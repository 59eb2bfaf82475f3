import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from glotta.llm import suffix_dedup


def brute(docs, length=suffix_dedup.LENGTH):
    """Every byte of every length-byte string that starts twice or more."""
    seen = Counter(t[k:k + length] for t in ((x or "").encode() for _, x in docs) for k in range(len(t) - length + 1))
    out = []
    for id_, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - length + 1):
            if seen[data[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((id_, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def mixed(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcé ") for _ in range(rng.randint(150, 900))) for _ in range(12)]
    docs = []
    for i in range(120):
        parts = [rng.choice(shared)[rng.randint(0, 90):] if rng.random() < 0.5
                 else "".join(rng.choice("abcd") for _ in range(rng.randint(0, 400))) for _ in range(rng.randint(0, 5))]
        docs.append((i, "".join(parts)))
    return docs + [(500, "x" * 1000), (501, "x" * 199), (502, "ab" * 300), (503, "y" * 200), (504, "z" * 201)]


@pytest.mark.parametrize("bucket", [suffix_dedup.BUCKET, 2])
def test_equals_brute_force(spark, bucket):
    docs = mixed(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, suffix_dedup.remove_repeats(df, bucket=bucket).collect())) == brute(docs)


def test_odd_rows_equal_brute_force(odd, odd_rows):
    got = Counter(map(tuple, suffix_dedup.remove_repeats(odd).collect()))
    assert got == brute([(r[0], r[1]) for r in odd_rows])


def test_empty(nothing):
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_long_texts_are_sampled_alike_in_blocks(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)).encode() for n in (30_000, 150, 12_345, 700)]
    whole = set(zip(*(x.tolist() for x in suffix_dedup.samples(texts))))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 5000)
    assert set(zip(*(x.tolist() for x in suffix_dedup.samples(texts)))) == whole


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, suffix_dedup.op7_blockwise_suffix_dedup(spark, sf_dir).collect())) == brute(docs)
