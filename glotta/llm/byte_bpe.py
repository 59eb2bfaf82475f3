"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

The symbols of a pre-token are the leaves of a tree, each with the rank of the
pair that it begins; an inner node keeps the least of ``(rank, place)`` below it.
The root so names the leftmost pair of the lowest rank. Merging it changes three
leaves, each with one walk to the root, until the root holds no pair: a pre-token
of n bytes takes O(n log n) steps, however long it is.

Texts are cut into pre-tokens as the vocabulary's file says, with the strings of
its added tokens cut out first. The vocabulary is read on the driver and
broadcast; a worker keeps the ids of pre-tokens beside it from task to task, up to
a bound, and a kept entry changes no result. Long texts go through in blocks.

Defined results: a null text is empty and has no ids, which decode to an empty
text; ids outside the vocabulary decode to nothing and bytes that are not UTF-8
to U+FFFD; repeated rows are returned as often as they come; null ids are
carried; other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, pieces, table

VOCABULARY = "byte_bpe_50k.json"
KEPT_WORDS, KEPT_BYTES = 600_000, 16 << 20  # of pre-tokens whose ids a worker keeps
BLOCK_TOKENS = 1 << 18  # pre-tokens of one text that are in memory at once

# How byte-level vocabularies cut a text; \s there is Unicode white space.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# Bytes that stand for themselves in token strings; the others, in turn, are written as U+0100 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

NO_RANK = 1 << 24  # greater than any rank; a key is ``rank * length + place``
NO_PAIR = 1 << 62  # greater than any key


def byte_characters() -> list[str]:
    """The character that stands for each byte in token strings."""
    out = [chr(b) for b in range(256)]
    for k, b in enumerate(sorted(set(range(256)).difference(PRINTED))):
        out[b] = chr(256 + k)
    return out


class PairTree:
    """The least key of adjacent pairs at ``nodes[1]``, under point updates.

    A flat binary tree: node p has the children 2p and 2p + 1, the leaf of place
    i is node ``leaves + i``.
    """

    def __init__(self, keys: list[int]):
        self.leaves = leaves = 1 << (len(keys) - 1).bit_length()
        self.nodes = nodes = [NO_PAIR] * leaves + keys + [NO_PAIR] * (leaves - len(keys))
        for p in range(leaves - 1, 0, -1):
            a, b = nodes[2 * p], nodes[2 * p + 1]
            nodes[p] = a if a < b else b

    @property
    def root(self) -> list[int]:
        return self.nodes[1:2]

    def put(self, place: int, key: int) -> None:
        """Set one leaf."""
        at = self.leaves + place
        self.nodes[at] = key
        self.mend(at, at, at)

    def mend(self, a: int, b: int, c: int) -> None:
        """Bring the paths above three leaf nodes, a <= b <= c, up to date: one walk, in which equal nodes count once."""
        nodes = self.nodes
        while a > 1:
            a >>= 1
            b >>= 1
            c >>= 1
            x, y = nodes[2 * a], nodes[2 * a + 1]
            nodes[a] = x if x < y else y
            if b != a:
                x, y = nodes[2 * b], nodes[2 * b + 1]
                nodes[b] = x if x < y else y
            if c != b:
                x, y = nodes[2 * c], nodes[2 * c + 1]
                nodes[c] = x if x < y else y


class ByteBpe:
    """A vocabulary file: ids of pre-tokens and bytes of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        vocabulary: dict[str, int] = made["model"]["vocab"]
        self.symbols = [vocabulary[c] for c in byte_characters()]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # by rank
        for rank, pair in enumerate(made["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[a], vocabulary[b]] = rank
            self.made.append(vocabulary[a + b])
        self.added = {t["content"]: t["id"] for t in made["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0
        self._token_bytes(vocabulary)
        self.decimal = [b"%d" % i for i in range(len(self.width))]

    def _token_bytes(self, vocabulary: dict[str, int]) -> None:
        """All tokens' bytes in one buffer, with the place of each id."""
        value = {c: b for b, c in enumerate(byte_characters())}
        tokens = [b""] * (max([*vocabulary.values(), *self.added.values()]) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        for token, i in self.added.items():
            tokens[i] = token.encode()
        self.width = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.width) - self.width
        self.buffer = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: merges the leftmost pair of the lowest rank until none is left."""
        ids = [self.symbols[b] for b in word]
        n, rank = len(ids), self.ranks.get
        if n < 2:
            return ids
        tree = PairTree([rank(pair, NO_RANK) * n + i for i, pair in enumerate(zip(ids, ids[1:]))])
        nodes, leaves, mend, made = tree.nodes, tree.leaves, tree.mend, self.made
        none = NO_RANK * n
        if nodes[1] >= none:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n))  # n and -1: none
        while (least := nodes[1]) < none:
            i = least % n
            j = after[i]
            k = after[i] = after[j]
            new = ids[i] = made[least // n]
            ids[j] = -1
            a = b = c = leaves + i
            if j < n - 1:
                c = leaves + j
                nodes[c] = NO_PAIR
            if k < n:
                before[k] = i
                nodes[b] = rank((new, ids[k]), NO_RANK) * n + i
            else:
                nodes[b] = NO_PAIR
            if i:
                h = before[i]
                a = leaves + h
                nodes[a] = rank((ids[h], new), NO_RANK) * n + h
            mend(a, b, c)
        return [i for i in ids if i >= 0]

    def _learn(self, words: set[str]) -> None:
        if len(self.kept) > KEPT_WORDS or self.kept_bytes > KEPT_BYTES:
            self.kept.clear()
            self.kept_bytes = 0
        for word in words.difference(self.kept):
            data = word.encode()
            self.kept[word] = array("I", self.merge(data)).tobytes()
            self.kept_bytes += len(data)

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, in blocks."""
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                yield np.array([self.added[part]], dtype="<u4")
                continue
            if len(part) <= BLOCK_TOKENS:
                blocks = iter([PRE_TOKEN.findall(part)])
            else:
                found = (m.group() for m in PRE_TOKEN.finditer(part))
                blocks = iter(lambda: list(islice(found, BLOCK_TOKENS)), [])
            for words in blocks:
                self._learn(set(words))
                yield np.frombuffer(b"".join(map(self.kept.__getitem__, words)), dtype="<u4")

    def token_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, joined."""
        ids = ids.astype(np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.width))]
        width = self.width[ids]
        ends = np.cumsum(width)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + width, width)
        return self.buffer[at].tobytes()


def _shared(df: DataFrame, vocabulary: str | None) -> Broadcast[dict]:
    """The vocabulary of a file, some 50,000 tokens, once per worker; as plain data, since workers may lack this package."""
    import public_tokenizers

    return df.sparkSession.sparkContext.broadcast(vars(ByteBpe(vocabulary or public_tokenizers.path(VOCABULARY))))


def _of(state: dict) -> ByteBpe:
    bpe = ByteBpe.__new__(ByteBpe)
    bpe.__dict__ = state  # not a copy: what is kept stays with the worker
    return bpe


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(id_col, ids)``: the token ids of every text. ``vocabulary`` is the path of a tokenizer file."""
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = _shared(chosen, vocabulary)

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared.value)
        for first, texts in pieces(batch, "text"):
            rows = [np.concatenate([np.empty(0, "<u4"), *bpe.encode(t.decode("utf-8", "replace"))]) for t in texts]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()),
                                           pa.array(np.concatenate(rows).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), ids], names=["id", "ids"])

    schema = f"id {dict(chosen.dtypes)['id']}, ids array<int>"
    return map_batches(chosen, fn, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``(id_col, text)``: the text of every array of ids; a null array is an empty one."""
    chosen = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    shared = _shared(chosen, vocabulary)

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared.value)
        for i, ids in enumerate(batch.column(1)):
            known = [] if ids.values is None else ids.values.drop_null().to_numpy(zero_copy_only=False)
            text = bpe.token_bytes(np.asarray(known, dtype=np.int64)).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([text])], names=["id", "text"])

    schema = f"id {dict(chosen.dtypes)['id']}, text string"
    return map_batches(chosen, fn, schema).withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str | None = None) -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of every text, encoded and decoded block by block.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of
    the text that the ids decode to, in UTF-8. Neither ids nor texts leave the task.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = _shared(chosen, vocabulary)

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared.value)
        rows = []
        for _, texts in pieces(batch, "text"):
            for text in texts:
                n, listed, decoded = 0, hashlib.sha256(), hashlib.sha256()
                decoder = codecs.getincrementaldecoder("utf-8")("replace")
                for ids in bpe.encode(text.decode("utf-8", "replace")):
                    if len(ids):
                        listed.update((b"," if n else b"") + b",".join(map(bpe.decimal.__getitem__, ids.tolist())))
                        n += len(ids)
                    decoded.update(decoder.decode(bpe.token_bytes(ids)).encode())
                decoded.update(decoder.decode(b"", True).encode())
                rows.append((n, listed.hexdigest(), decoded.hexdigest()))
        counts, listed, decoded = zip(*rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(listed),
                                          pa.array(decoded)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"id {dict(chosen.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(chosen, fn, schema).withColumnRenamed("id", id_col)


def op13_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: number of ids and digests of ids and decoded text."""
    return round_trip(table(spark, sf_dir, "documents"))
