import hashlib
import random
import re
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glotta.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    """The base spans by the plain patterns."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = (True, all(int(x) <= 255 for x in m.group().split(".")) if kind == 1 else None,
                    12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                    9 <= len(digits) <= 15)[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def check(row, text):
    base = brute(text)
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
    assert row.base_sha256 == hashlib.sha256(pii.text_of(base).encode()).hexdigest()
    spans = [s for s in row.spans.split(",") if s]
    assert set(filter(None, pii.text_of(base).split(","))) <= set(spans)
    assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))


@pytest.fixture(scope="module")
def calls(spark):
    """Texts with each kind, look-alikes that fail, and phone numbers that lack their plus."""
    rng = random.Random(1)
    rows = []
    for i in range(600):
        phone = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        part = rng.choice([
            f"call me at +1 {phone} today", f"write to a{i}@mail.example.com please", f"from 10.{i % 250}.3.4 again",
            f"release 1.{i}.400.7 is out", f"number {rng.randint(10**15, 10**16 - 1)} noted", f"see user@host{i} there",
            f"order {rng.randint(10**6, 10**7)}", "nothing here"])
        rows.append((i, f"Some words before. {part}\nand after."))
    rows += [(1000 + i, f"Some words before. call me at +1 (3{i:02}) 555-12{i:02} today\nand after.") for i in range(60)]
    return rows


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["1", "23", "255", "4111111111111111", "+1", " ", "-", ".", "@", "a.b", "(", ")", "x", "\n", "é", "+", "300"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_are_read_in_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "+1((" * 100_000, "1." * 200_000, "a:" * 100_000, "at dot " * 50_000):
        runs = [m.span() for m in pii.DIGITS.finditer(text)]
        pii.candidates(text, runs, pii.base_spans(text, runs))


def test_trees_and_thresholds(spark, calls):
    df = spark.createDataFrame(calls, "doc_id long, text string")
    scanned = pii.materialize(pii.scan(df), "test-pii")
    model, thresholds = pii.train(scanned)
    assert len(thresholds) == 4 and all(t >= 0.5 for t in thresholds)
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    for id_, text in calls:
        check(rows[id_], text)
    kept = pii.redact(df)
    assert kept.columns == df.columns
    for r in kept.collect():
        text = dict(calls)[r.doc_id]
        assert not brute(r.text) or brute(text) != brute(r.text)
        assert r.text.startswith("Some words before.") and r.text.endswith("and after.")


def test_odd_rows(odd, odd_rows):
    rows = pii.find(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.redact(odd).count() == len(odd_rows)


def test_empty(nothing):
    assert pii.find(nothing).count() == 0 and pii.redact(nothing).count() == 0


def test_query_equals_the_patterns(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pii.op2_boosted_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r, texts[r.doc_id])


def test_numbers_beside_each_other_are_candidates():
    def phones(text):
        runs = [m.span() for m in pii.DIGITS.finditer(text)]
        return {text[s:e] for s, k, e in pii.candidates(text, runs, pii.base_spans(text, runs)) if k == 3}

    assert {"030 1234567", "030 7654321"} <= phones("Call 030 1234567 / 030 7654321")
    assert {"555 123 4567", "2023 555 123 4567"} <= phones("2023 555 123 4567")
    cards = "4111 1111 1111 1112 4111 1111 1111 1113"
    runs = [m.span() for m in pii.DIGITS.finditer(cards)]
    assert {(0, 2, 19), (20, 2, 39)} <= set(pii.candidates(cards, runs, pii.base_spans(cards, runs)))
    for text in ("1 " * 100_000, "+123456789 " * 20_000):
        runs = [m.span() for m in pii.DIGITS.finditer(text)]
        assert len(pii.candidates(text, runs, pii.base_spans(text, runs))) <= 2 * pii.MOST_DIGITS * len(runs)


def test_plus_less_numbers_beside_others_are_added(spark, calls):
    rng = random.Random(9)
    planted = []
    for i in range(40):
        one, two = (f"1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}" for _ in range(2))
        planted.append((5000 + i, f"Some words before. call me at {one} / {two} today or then\nand after.", one, two))
    pairs = [(3000 + i, f"Some words before. call me at +1 ({200 + i}) 555-{1100 + i} / +1 ({500 + i}) 555-{2100 + i} today\n"
              "and after.") for i in range(120)]
    rows = pii.find(spark.createDataFrame(calls + pairs + [p[:2] for p in planted], "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in rows.collect()}
    for id_, text, one, two in planted:
        phones = {text[int(s):int(e)] for k, s, e in (x.split(":") for x in found[id_].split(",") if x) if k == "phone"}
        assert {one, two} <= phones, (text, phones)


def test_long_numbers_and_tables_of_digits(spark):
    zeros = "0" * 5000
    texts = [".".join(zeros if i == part else "1" for i in range(4)) for part in range(4)] + [zeros, zeros + ".1", "1 " * 3000]
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i].n_ip for i in range(len(texts))] == [1, 1, 1, 1, 0, 0, 0]
    limit = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)  # for the brute-force version, which runs here and not in the workers
    try:
        for i, text in enumerate(texts):
            check(rows[i], text)
    finally:
        sys.set_int_max_str_digits(limit)
    scanned = pii.scan(spark.createDataFrame([(1, texts[-1]), (2, "")], "doc_id long, text string")).collect()
    runs = [m.span() for m in pii.DIGITS.finditer(texts[-1])]
    sizes = [len(r.candidates) for r in scanned if r.candidates is not None]
    assert max(sizes) <= pii.CHUNK and sum(sizes) == len(pii.candidates(texts[-1], runs, pii.base_spans(texts[-1], runs)))
    assert sorted(r.doc_id for r in scanned if r.base is not None) == [1, 2]


def test_choice_equals_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        def spans(n):
            return [dict(start=s, kind=rng.randrange(4), end=s + rng.randint(1, 9), p=rng.choice([0.6, 0.7, 0.8]))
                    for s in (rng.randrange(60) for _ in range(n))]

        base, scored = spans(rng.randrange(4)), spans(rng.randrange(25))
        want = [(b["start"], b["kind"], b["end"]) for b in base]
        for c in sorted(scored, key=lambda c: (-c["p"], c["start"], c["kind"], -c["end"])):
            if all(c["end"] <= s or e <= c["start"] for s, _, e in want):
                want.append((c["start"], c["kind"], c["end"]))
        assert pii._chosen(base, scored) == sorted(want)


def test_all_candidates_are_trained_on(spark, monkeypatch):
    """A class beyond the rows weighs no more, but none of its candidates is left out."""
    docs = spark.createDataFrame([(i, f"call +34 911 23{i:04d} or 5551234{i:03d} a@b{i}.org, x@y{i}") for i in range(300)], "doc_id long, text string")
    scanned = pii.scan(docs).persist()
    decided = scanned.select(F.explode("candidates").alias("c")).filter("c.label >= 0").count()
    seen = []
    monkeypatch.setattr(pii, "materialize", lambda df, name: seen.append(df.count()) or df)
    model, thresholds = pii.train(scanned, rows=40)
    assert seen == [decided] and decided > 600 and len(thresholds) == 4
