"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND.

The index is of the test items; every passage of every training document is a
query. Passages are windows of 2 * STRIDE words, one every STRIDE words, so an
item piece of at most STRIDE words that occurs in a document lies whole in some
passage. A piece is retrieved where its BM25 score reaches THRESHOLD of the
score it gives itself. As in WAND, a piece can only reach its threshold through
its essential terms (all but its commonest, which together stay below it), so
only their postings are walked. They are kept in blocks of BLOCK pieces with the
largest impact of each term in the block; the sum of those maxima over the
terms of a passage bounds what its essential terms bring to any piece of the
block, and only blocks whose bound suffices are scored in full. The bounds of
all passages of a batch are summed in one go, without leaving any out.

Retrieved pairs are verified on the whole document: the share of the question's
five-word shingles found there, and of the answer's, must each reach OVERLAP.
The question is the item's first line, the answer the others (none: only the
question counts); a part of fewer than five words is one shingle. Words are
lower-cased (A-Z) runs without white space and ASCII punctuation.

The index is built on the driver from at most PASS_WORDS words at a time (about
30 MB); a larger benchmark is worked through in several passes over the
documents, each against one share of the items.

Defined results: a null text or item is empty; an item of fewer than MIN_WORDS
words proves nothing and is never matched; repeated items with one id count
once, repeated documents each; other columns are carried by ``decontaminate``
and not read by ``leaks``; empty tables give no leaks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, pieces, table
from glotta.llm.words import Words, split

SHINGLE = 5
STRIDE = 128
BLOCK = 8
COMMON = 0.35  # of a piece's own score: terms that are not essential for it
SHARD = 256  # pieces in one impact matrix
THRESHOLD = 0.6
OVERLAP = 0.8
MIN_WORDS = SHINGLE
PASS_WORDS = 1_000_000
K1, B = 1.2, 0.75


@dataclass
class Shard:
    """Postings of up to SHARD pieces, in blocks of BLOCK; terms are numbered as in the vocabulary.

    The commonest terms of a piece, up to COMMON of its own score, are not
    essential for it: without any other term no passage reaches its threshold.
    """

    at: np.ndarray  # per term, where its essential postings start
    blocks: np.ndarray  # the block of each essential posting
    most: np.ndarray  # the largest essential impact of the term in that block
    missing: np.ndarray  # per block, the least that essential terms must bring to reach some threshold in it
    row: np.ndarray  # per term, its row in impact, or -1
    impact: np.ndarray  # terms x pieces
    threshold: np.ndarray  # per piece
    item: np.ndarray  # per piece, the position of its item


@dataclass
class Index:
    vocabulary: np.ndarray  # sorted word hashes
    shards: list[Shard]
    ids: list
    parts: list[list[tuple[int, np.ndarray]]]  # per item: (words in a shingle, shingle hashes) of question and answer


def _shingles(words: Words, hashes: np.ndarray) -> tuple[int, np.ndarray]:
    k = min(SHINGLE, len(hashes))
    return k, np.unique(words.shingles(k, hashes)[0]) if k else np.empty(0, np.uint64)


def build_index(items: list[tuple[object, str]]) -> Index:
    """The index of ``(id, text)`` items."""
    ids, parts, terms, owner = [], [], [], []
    for id_, text in items:
        lines = (text or "").split("\n", 1)
        found = [(w, w.hashes()) for w in (split([x.encode()], lower=True, punctuation=True) for x in lines)]
        h = np.concatenate([x[1] for x in found])
        if len(h) < MIN_WORDS:
            continue
        parts.append([_shingles(w, x) for w, x in found if len(x)])
        n = -(-len(h) // STRIDE)
        for piece in np.array_split(h, n):
            terms.append(piece)
            owner.append(len(ids))
        ids.append(id_)
    vocabulary = np.unique(np.concatenate(terms)) if terms else np.empty(0, np.uint64)
    postings = [np.unique(np.searchsorted(vocabulary, t), return_counts=True) for t in terms]
    df = np.bincount(np.concatenate([p[0] for p in postings]), minlength=len(vocabulary)) if postings else np.empty(0)
    idf = np.log(1 + (len(terms) - df + 0.5) / (df + 0.5))
    mean = np.mean([len(t) for t in terms]) if terms else 1.0
    shards = [_shard(len(vocabulary), postings[i:i + SHARD], df, idf, [len(t) / mean for t in terms[i:i + SHARD]],
                     np.array(owner[i:i + SHARD])) for i in range(0, len(terms), SHARD)]
    return Index(vocabulary, shards, ids, parts)


def _shard(n_terms: int, postings: list, df: np.ndarray, idf: np.ndarray, lengths: list[float],
           item: np.ndarray) -> Shard:
    used = np.unique(np.concatenate([t for t, _ in postings]))
    row = np.full(n_terms, -1, dtype=np.int32)
    row[used] = np.arange(len(used))
    impact = np.zeros((len(used), len(postings)), dtype=np.float32)
    essential = np.zeros_like(impact)
    missing = []
    for col, ((t, tf), length) in enumerate(zip(postings, lengths)):
        score = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))
        impact[row[t], col] = score
        order = np.argsort(-df[t], kind="stable")
        common = order[np.cumsum(score[order]) <= COMMON * score.sum()]
        essential[row[t], col] = score
        essential[row[t[common]], col] = 0
        missing.append(THRESHOLD * score.sum() - score[common].sum())
    starts = np.arange(0, len(postings), BLOCK)
    block_max = np.maximum.reduceat(essential, starts, axis=1)
    rows, blocks = np.nonzero(block_max)
    at = np.zeros(n_terms + 1, dtype=np.int64)
    np.cumsum(np.bincount(used[rows], minlength=n_terms), out=at[1:])
    return Shard(at, blocks, block_max[rows, blocks], np.minimum.reduceat(missing, starts), row, impact,
                 THRESHOLD * impact.sum(axis=0), item)


def retrieve(index: Index, words: Words, hashes: np.ndarray) -> dict[tuple[int, int], float]:
    """``(text, item) -> best score`` of all pairs of which some passage reaches some piece's threshold."""
    best: dict[tuple[int, int], float] = {}
    if not len(index.vocabulary) or not len(hashes):
        return best
    at = np.searchsorted(index.vocabulary, hashes)
    at[at == len(index.vocabulary)] = 0
    known = np.flatnonzero(index.vocabulary[at] == hashes)
    counts = words.counts()
    halves = np.maximum(1, -(-counts // STRIDE))
    first_half = np.concatenate([[0], np.cumsum(halves)])
    first_word = np.concatenate([[0], np.cumsum(counts)])
    doc, terms = words.doc[known], at[known]
    half = first_half[doc] + (known - first_word[doc]) // STRIDE  # ascending
    doc_of = np.repeat(np.arange(words.n_docs), halves)
    size = len(index.vocabulary)
    pairs = np.unique(half * size + terms)
    half_of, term_of = np.divmod(pairs, size)
    starts = np.searchsorted(half_of, np.arange(first_half[-1] + 1))
    has_next = np.append(doc_of[1:] == doc_of[:-1], False)
    for shard in index.shards:
        n_blocks = len(shard.missing)
        n = np.diff(shard.at)[term_of]
        posting = np.repeat(shard.at[term_of] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        cell = np.repeat(half_of, n) * n_blocks + shard.blocks[posting]
        bound = np.bincount(cell, shard.most[posting], minlength=first_half[-1] * n_blocks).reshape(-1, n_blocks)
        both = bound[:-1] + bound[1:] * has_next[:-1, None]  # a term in both halves counts twice: still a bound
        bound = np.concatenate([both, bound[-1:]])
        for h, block in zip(*np.nonzero(bound >= shard.missing * (1 - 1e-5))):
            own = np.unique(term_of[starts[h]:starts[h + 1 + has_next[h]]])
            rows = shard.row[own]
            cols = slice(block * BLOCK, (block + 1) * BLOCK)
            score = shard.impact[rows[rows >= 0], cols].sum(axis=0)
            for c in np.flatnonzero(score >= shard.threshold[cols] * (1 - 1e-5)):
                pair = int(doc_of[h]), int(shard.item[block * BLOCK + c])
                best[pair] = max(best.get(pair, 0.0), float(score[c]))
    return best


def find_leaks(index: Index, texts: list[bytes]) -> list[tuple[int, object, float, float, float | None]]:
    """``(text, item id, score, question overlap, answer overlap)`` of all verified pairs."""
    words = split(texts, lower=True, punctuation=True)
    hashes = words.hashes()
    found, grams = [], {}
    bounds = np.concatenate([[0], np.cumsum(words.counts())])
    for (doc, item), score in sorted(retrieve(index, words, hashes).items()):
        overlaps = []
        for k, wanted in index.parts[item]:
            if (doc, k) not in grams:
                own = slice(bounds[doc], bounds[doc + 1])
                one = Words(words.buf, words.base, words.starts[own], words.ends[own], words.doc[own])
                grams[doc, k] = one.shingles(k, hashes[own])[0]
            overlaps.append(float(np.isin(wanted, grams[doc, k]).mean()))
        if min(overlaps) >= OVERLAP:
            found.append((doc, index.ids[item], score, overlaps[0], overlaps[1] if len(overlaps) > 1 else None))
    return found


def index_passes(items: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """Indexes over shares of the items of about PASS_WORDS words each."""
    chosen = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).distinct()
    words = chosen.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).alias("n")).first().n or 0
    passes = -(-words // PASS_WORDS)
    for p in range(passes):
        share = chosen.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == p)
        yield build_index(sorted(((r.id, r.text) for r in share.collect()), key=repr))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` for every verified leak."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    names = [x.split()[0] for x in schema.split(", ")]
    found = chosen.sparkSession.createDataFrame([], schema)
    for index in index_passes(items):
        def run(batch: pa.RecordBatch, index=index):
            for first, texts in pieces(batch, "text"):
                if rows := find_leaks(index, texts):
                    at, *rest = zip(*rows)
                    ids = batch.column(0).take(pa.array([first + i for i in at]))
                    types = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [ids, *[pa.array(c, t) for c, t in zip(rest, types)]], names=names)

        found = found.unionByName(map_batches(chosen, run, schema))
    return found


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no verified leak."""
    for index in index_passes(items):
        def run(batch: pa.RecordBatch, index=index):
            clean = np.ones(batch.num_rows, dtype=bool)
            for first, texts in pieces(batch, text_col):
                clean[[first + row[0] for row in find_leaks(index, texts)]] = False
            yield batch.filter(pa.array(clean))

        docs = map_batches(docs, run, docs.schema)
    return docs


def op4_bm25_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
