import random
import re
from collections import Counter

import numpy as np
import pytest

from glotta.llm import outliers as ol

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def base_failed(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def exact_mcd(x):
    """Concentration steps on arrays, from the same idea of a robust start."""
    centre, scale = np.median(x, axis=0), np.maximum(np.median(abs(x - np.median(x, axis=0)), axis=0), 1e-2)
    keep = np.argsort((((x - centre) / scale) ** 2).sum(axis=1))[: int(0.75 * len(x))]
    for _ in range(20):
        mean, cov = x[keep].mean(axis=0), np.cov(x[keep].T) + np.diag(ol.FLOOR**2 / 25)
        gap = x - mean
        keep = np.argsort((gap * np.linalg.solve(cov, gap.T).T).sum(axis=1))[: int(0.75 * len(x))]
    return mean, cov


def test_counts_equal_brute_force(odd_rows):
    rng = random.Random(1)
    texts = [r[1] or "" for r in odd_rows if len(r[1] or "") < 40_000]
    texts += ["".join(rng.choice("ab \n\t#é|") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    got = ol.text_counts([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert tuple(int(got[c][i]) for c in ol.COUNTS) == brute_counts(text)


def test_the_estimate_ignores_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(ol.P, ol.P)) * 0.2 + np.eye(ol.P)
    good = rng.normal(size=(1500, ol.P)) @ mixing.T * 0.3 + 1
    bad = rng.normal(size=(300, ol.P)) * 0.1 + 6
    rows = [("a", *map(float, r)) for r in np.concatenate([good, bad])] + [("b", *map(float, r)) for r in good + 5]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{f} double" for f in ol.FEATURES))
    found = {r.g: (np.array(r["mean"]), np.array(r["cov"]).reshape(ol.P, ol.P)) for r in ol.fit(df).collect()}
    assert set(found) == {"a", "b"}
    for group, shift in (("a", 0), ("b", 5)):
        mean, cov = found[group]
        want_mean, _ = exact_mcd(good + shift)
        assert np.abs(mean - want_mean).max() < 0.1
        truth = np.cov(good.T)
        assert np.abs(cov - truth).max() < 0.25 * np.abs(truth).max()
    gap = bad - found["a"][0]
    assert ((gap * np.linalg.solve(found["a"][1], gap.T).T).sum(axis=1) > ol.chi_square(1 - ol.TAIL)).all()


def test_chi_square():
    assert ol.chi_square(0.5, 7) == pytest.approx(6.346, abs=0.02)  # published quantiles
    assert ol.chi_square(0.975, 7) == pytest.approx(16.013, abs=0.06)


def test_odd_rows(odd, odd_rows):
    rows = ol.judge(odd, ("doc_id", "text"), least=20).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    for r in rows:
        counts = tuple(r[c] for c in ol.COUNTS)
        if len(r.text or "") < 40_000:
            assert counts == brute_counts(r.text)
        assert r.base_failed == base_failed(counts) and not (r.base_failed and r.kept)
    kept = ol.keep_good(odd, least=20)
    assert kept.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r.doc_id, r.text) for r in rows if r.kept)


def test_empty(nothing):
    assert ol.judge(nothing).count() == 0 and ol.keep_good(nothing).count() == 0


def test_query_on_labelled_documents(spark):
    """Every labelled clean document that the base rules keep stays; most low-quality ones go."""
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in ol.op3_robust_quality_outliers(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    for id_, r in rows.items():
        assert tuple(r[c] for c in ol.COUNTS) == brute_counts(texts[id_])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    judged = [(x.quality, rows[x.doc_id].kept) for x in labels if not rows[x.doc_id].base_failed]
    assert all(kept for quality, kept in judged if quality == 1)
    low = [kept for quality, kept in judged if quality == 0]
    assert sum(low) <= 0.2 * len(low)
