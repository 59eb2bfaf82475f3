import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glotta.llm import byte_bpe
from glotta.llm.byte_bpe import NO_PAIR, ByteBpe, PairTree

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def all_ids(bpe, text):
    return [i for block in bpe.encode(text) for i in block.tolist()]


def brute_merge(bpe, word):
    """The definition: look at all pairs, merge the leftmost of the lowest rank, start again."""
    ids = [bpe.symbols[b] for b in word]
    while True:
        ranked = [(bpe.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in bpe.ranks]
        if not ranked:
            return ids
        i = min(ranked)[1]
        ids[i:i + 2] = [bpe.made[bpe.ranks[ids[i], ids[i + 1]]]]


def test_root_is_the_minimum():
    rng = random.Random(1)
    for n in (1, 2, 3, 7, 8, 33):
        keys = [rng.choice([NO_PAIR, rng.randrange(50)]) for _ in range(n)]
        tree = PairTree(list(keys))
        for _ in range(200):
            place, key = rng.randrange(n), rng.choice([NO_PAIR, rng.randrange(50)])
            keys[place] = key
            tree.put(place, key)
            assert tree.root[0] == min(keys)


def test_merges_equal_brute_force(bpe):
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 90] * 20:
        word = bytes(rng.choice(b"aehint rs\xc3\xa9\xff") for _ in range(n))
        assert bpe.merge(word) == brute_merge(bpe, word)
    assert bpe.merge(b"aa" * 30) == brute_merge(bpe, b"aa" * 30)


ODD = ["", " ", "  ", "\n\n", " \n\t x", "a  b", "it's we'll I'd 'tis 'S", "x" * 3000, "ab" * 2000, "1234567 89", "<|endoftext|>",
       "a <|endoftext|> b<|endoftext|><|endoftext|>  ", "<|endoftext", "日本語 テキスト", "a b c\x1cd\x85e", "\x00\x01", "🙂🙂👩‍👩‍👧",
       "é́", "�", "½²٣४", " 　 x"]


def test_equal_to_the_library(bpe, library, spark, sf_dir):
    texts = ODD + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    for text in texts:
        ids = all_ids(bpe, text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        decoded = bpe.token_bytes(np.array(ids, dtype=np.int64)).decode("utf-8", "replace")
        assert decoded == library.decode(ids, skip_special_tokens=False) == text


def test_every_cut_of_unusual_characters(bpe, library):
    """White space, letters and numbers as the library knows them, over a slice of all code points."""
    for code in [*range(0, 0x3100), *range(0xFE00, 0x11000, 7), *range(0x11000, 0x110000, 997)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)} {chr(code)}b  {chr(code)}1"
            assert all_ids(bpe, text) == library.encode(text, add_special_tokens=False).ids, hex(code)


def test_blocks_change_nothing(bpe, monkeypatch):
    text = "The quick  brown fox's 12 dens.\n\n " * 50
    whole = all_ids(bpe, text)
    monkeypatch.setattr(byte_bpe, "BLOCK_TOKENS", 7)
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 10)
    assert len(list(bpe.encode(text))) > 50 and all_ids(bpe, text) == whole


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_query_and_odd_rows(spark, odd, odd_rows, nothing, library):
    got = byte_bpe.round_trip(odd).collect()
    want = [(row[0], *expected(library, row[1])) for row in odd_rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert byte_bpe.round_trip(nothing).collect() == []
    assert byte_bpe.encode(nothing).collect() == [] and byte_bpe.decode(byte_bpe.encode(nothing)).collect() == []


def test_query_over_the_table(spark, sf_dir, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in byte_bpe.op13_segment_tree_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    assert all(got[i] == expected(library, text) for i, text in rows)


def test_encode_then_decode_gives_the_texts(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD + [None])]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("ids", F.lit("taken")).withColumn("id", F.lit(0))
    encoded = byte_bpe.encode(df)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {
        i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode(encoded).collect()} == {i: t or "" for i, t in rows}


def test_ids_that_make_no_text(spark, library):
    cut = library.encode("é", add_special_tokens=False).ids + library.encode("日", add_special_tokens=False).ids[:1]
    df = spark.createDataFrame([(1, None), (2, []), (3, [-1, 10**6, None, 15496]), (4, cut), (5, [50256, 50256])],
                               "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in byte_bpe.decode(df).collect()}
    assert got[1] == got[2] == "" and got[3] == library.decode([15496]) and got[5] == "<|endoftext|>" * 2
    assert got[4] == library.decode(cut, skip_special_tokens=False)
