import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from glotta.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check_packing(rows, docs, tokenizer):
    """Every piece is there with its ids, and every sequence is gapless and within the capacity."""
    want = Counter()
    for id_, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.SEPARATOR], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            piece = ids[at:at + packing.CAPACITY]
            want[id_, k, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(sequences)


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


def test_patterns_use_every_item_once():
    for seed in range(200):
        rng = random.Random(seed)
        capacity, counts = rng.choice([10, 50, 100, 2048]), Counter()
        for _ in range(rng.randint(1, 150)):
            counts[rng.randint(1 if seed % 3 else capacity // 4 or 1, capacity)] += rng.randint(1, 5)
        used = Counter()
        for runs, times in packing.pack_counts(dict(counts), capacity):
            assert times > 0 and sum(length * k for length, k in runs) <= capacity
            for length, k in runs:
                used[length] += k * times
        assert used == counts


def test_small_instances_are_packed_optimally():
    for seed in range(150):
        rng = random.Random(seed)
        items = [rng.randint(8, 20) for _ in range(9)]
        assert sum(t for _, t in packing.pack_counts(Counter(items), 30)) == optimum(items, 30)


def test_the_reduction_fixes_only_dominating_sets():
    for seed in range(150):
        rng = random.Random(seed)
        items = [rng.randint(5, 28) for _ in range(8)]
        left = packing._Counts(Counter(items))
        left.take(max(items))
        found = packing._dominating(max(items), left, 30)
        if found is not None:
            rest = Counter(items) - Counter([max(items), *found])
            assert optimum(list(rest.elements()), 30) + 1 == optimum(items, 30)


def test_words_are_encoded_as_in_the_whole_text(tokenizer):
    odd = ["Don't you'll. İstanbul, ﬁne x a b é é. é, ΑΣ ²½ a\x1cb 'S''s it's_ 12,345. ß ǅ 中文字 \u0000 a--b '' !'s end.",
           "A. <|endoftext|>x, <|ENDOFTEXT|> b. c", "x y\u0085z w. 　v", "..., a., b.. c.\nd,\te ,f"]
    ids = packing._Ids(public_tokenizers.path(packing.VOCABULARY))
    for text in odd:
        words = packing._plain(text.encode()).split()
        ids.learn(set(words))
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert ids.of(words) == want


def test_odd_rows(odd, odd_rows, tokenizer):
    check_packing(packing.pack(odd).collect(), [(r[0], r[1]) for r in odd_rows], tokenizer)


def test_empty(nothing):
    assert packing.pack(nothing).count() == 0


def test_query(spark, sf_dir, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = packing.op8_reduced_best_fit_packing(spark, sf_dir).collect()
    assert check_packing(rows, docs, tokenizer) <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1
