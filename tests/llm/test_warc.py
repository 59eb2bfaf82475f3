import base64
import gzip
import hashlib
from collections import Counter

import pytest

from glotta.llm import warc
from glotta.llm.common import new_path

PAGES = "page_id long, url string, html string, id long, path string"


def brute(pages):
    """Counter of ``(id, bytes, digest, url)`` and the elected id of each payload."""
    elected, n = {}, Counter()
    for id_, _, html, *_ in pages:
        key = html or ""
        n[key] += 1
        if id_ is not None:
            elected[key] = max(elected.get(key, id_), id_)
    return elected, n


@pytest.fixture(scope="module")
def pages():
    big = "x" * (17 << 20)
    return [(1, "u\r\n x", big, 0, ""), (2, None, big, 0, ""), (None, "http://a", None, 0, ""), (3, "b", "", 0, ""),
            (3, "b", "", 0, ""), (None, None, "é\0ß\r\n\r\n", 0, None), (4, "http://é/ü", "é\0ß\r\n\r\n", None, ""),
            (5, "c", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", 0, ""), (6, "d", " ", 0, "")]


@pytest.mark.parametrize("few", [warc.FEW_REVISITS, 0])
def test_odd_rows_survive_the_round_trip(spark, pages, monkeypatch, few):
    monkeypatch.setattr(warc, "FEW_REVISITS", few)
    first, second = new_path(spark, "warc-a"), new_path(spark, "warc-b")
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(3), first)
    warc.dedup_archives(spark, first, second)
    captured, rows = warc.read_headers(spark, first).collect(), warc.read_headers(spark, second).collect()
    elected, n = brute(pages)
    code = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): h or "" for _, _, h, *_ in pages}
    assert len(rows) == len(pages) and len({r.record_id for r in rows}) == len(rows)
    assert not {r.record_id for r in rows} & {r.record_id for r in captured}
    want = Counter((i, len((h or "").encode()), warc.digest((h or "").encode())) for i, _, h, *_ in pages)
    assert Counter((r.source_id, r.payload_bytes, r.payload_digest) for r in rows) == want
    responses = {r.payload_digest: r for r in rows if r.record_type == "response"}
    assert len(responses) == len(n) == sum(r.record_type == "response" for r in rows)
    for r in rows:
        own = responses[r.payload_digest]
        assert own.source_id == elected.get(code[r.payload_digest])
        if r.record_type == "revisit":
            assert (r.refers_to_id, r.refers_to_uri) == (own.record_id, own.target_uri)


def test_bodies_are_whole_and_files_are_plain_gzip(spark, pages):
    path = new_path(spark, "warc-c")
    warc.write_archives(spark.createDataFrame(pages, PAGES).coalesce(1), path)
    found = []
    for row in spark.read.format("binaryFile").load(path).collect():
        content = bytes(row.content)
        assert gzip.decompress(content).startswith(b"WARC/1.1\r\n")
        for _, data in warc.members(content):
            fields, block = warc.parse(data)
            assert data.endswith(b"\r\n\r\n") and int(fields["content-length"]) == len(block)
            found.append(block.split(b"\r\n\r\n", 1)[1].decode())
    assert found == [h or "" for _, _, h, *_ in pages]


def test_small_payloads_stay_responses(spark):
    path, out = new_path(spark, "warc-d"), new_path(spark, "warc-e")
    warc.write_archives(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                                              "page_id long, url string, html string"), path)
    warc.dedup_archives(spark, path, out, min_payload=3)
    got = {r.source_id: r.record_type for r in warc.read_headers(spark, out).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty(spark):
    path, out = new_path(spark, "warc-f"), new_path(spark, "warc-g")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    warc.dedup_archives(spark, path, out)
    assert warc.read_headers(spark, out).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    elected, _ = brute(rows)
    want = set()
    for id_, url, html in rows:
        other = elected[html or ""]
        data = (html or "").encode()
        want.add((id_, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "response" if other == id_ else "revisit", None if other == id_ else other, url))
    assert set(map(tuple, warc.op1_warc_revisits(spark, sf_dir).collect())) == want
