"""LDA whose word-topic weights are a table: nothing of the size of the vocabulary reaches the driver.

Batch variational Bayes. The documents are written once as blocks, each with the
list of its words; the words are dealt to parts by a hash. In a pass every block
gets the weights of its own words from the parts, once for each word and not for
each document, finds the topics of its documents and gives back the shares that
its words gave to each topic, which the parts add up. These messages hold numbers
alone, in an order that block and part both know. The driver sees one number per
topic and pass, and the tables of a pass go with the next one.

Shares are added as whole multiples of 1 / FIXED, so that a table does not depend
on how documents are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta import SEED
from glotta.operators import blocks as block_tables
from glotta.operators.blocks import (CODES, COUNTS, DOC, INDEX, MODEL, NUMBERS, ORDER, ROW, SIZES, SPLIT, TOTALS, WORD, WORDS, blocks_of,
                                     dealt, held_of, keys_of, model_rows, pack, read, rows_of, unpack)
from glotta.operators.joins import has_at_most, lookup_join
from glotta.operators.once import explode_tokens
from glotta.operators.topics import LDA_PASSES, NUM_TOPICS
from glotta.scratch import delete_path, new_path, write_table

FIXED = 1 << 20
INNER_STEPS = 100
INNER_CHANGE = 1e-4  # mean change of a document's topic weights at which its inner steps end
MAX_BROADCAST_BYTES = 100_000_000  # of the table of words
MAX_TOPICS = 1000
CHUNK = 1 << 17  # words whose documents are worked on at once
START = 100_003
STORED = "word string, weights array<double>"


@dataclass(frozen=True)
class WordTopics:
    """``words`` is (word, weights): one number per topic, of which ``totals`` are the sums over all words."""

    words: DataFrame
    totals: list[float]
    alpha: float

    @property
    def k(self) -> int:
        return len(self.totals)


def _rest_of_digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function without the logarithm of x + 6, its greatest term."""
    y, r = x * (x + 5), 1 / (x + 6)
    steps = (2 * x + 5) * (3 * y * y + 20 * y + 24) / (y * (y + 4) * (y + 6))  # from x to x + 6
    s = r * r
    return -0.5 * r - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s / 240))) - steps


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive numbers."""
    x = np.asarray(x, dtype=np.float64)
    return np.log(x + 6) + _rest_of_digamma(x)


def exp_digamma(x: np.ndarray) -> np.ndarray:
    return (x + 6) * np.exp(_rest_of_digamma(x))


def document_topics(counts: np.ndarray, beta: np.ndarray, alpha: float) -> np.ndarray:
    """The variational weights of one document's topics; ``beta`` has a row of exp(E[log]) per distinct word."""
    k = beta.shape[1]
    gamma = np.full(k, alpha + counts.sum() / k)
    for _ in range(INNER_STEPS):
        before, theta = gamma, exp_digamma(gamma)
        norm = beta @ theta + 1e-100
        gamma = alpha + theta * (beta.T @ (counts / norm))
        if np.abs(gamma - before).mean() < INNER_CHANGE:
            break
    return gamma


def _widths(sizes: np.ndarray) -> np.ndarray:
    """The sizes rounded up to a quarter of the power of two below them, so that few widths occur."""
    unit = np.maximum(8, 1 << np.maximum(0, np.frexp(sizes)[1] - 3))
    return -(-sizes // unit) * unit


def _topics_of_equal_widths(counts: np.ndarray, beta: np.ndarray, alpha: float) -> np.ndarray:
    """``document_topics`` of documents with as many words each; ``beta`` is documents x topics x words, a count of 0 is no word.

    Each step works on the documents whose own steps have not ended, and on some that have.
    """
    out, going = np.zeros(beta.shape[:2]), np.arange(len(counts))
    open_ = np.ones(len(counts), dtype=bool)
    gamma = np.repeat(alpha + counts.sum(axis=1, keepdims=True) / beta.shape[1], beta.shape[1], axis=1)
    for step in range(INNER_STEPS):
        before, theta = gamma, exp_digamma(gamma)
        norm = np.matmul(theta[:, None, :], beta)[:, 0, :]
        norm += 1e-100
        gamma = alpha + theta * np.matmul(beta, np.divide(counts, norm, out=norm)[:, :, None])[:, :, 0]
        ended = open_ & ((np.abs(gamma - before).mean(axis=1) < INNER_CHANGE) | (step == INNER_STEPS - 1))
        if ended.any():
            out[going[ended]] = gamma[ended]
            open_ &= ~ended
            left = int(open_.sum())
            if not left:
                break
            if left < 0.75 * len(going):
                going, gamma, counts, beta = going[open_], gamma[open_], counts[open_], beta[open_]
                open_ = np.ones(left, dtype=bool)
    return out


def _runs(codes: np.ndarray, counts: np.ndarray, sizes: np.ndarray, beta: np.ndarray, alpha: float) -> Iterator[
        tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(documents, words, counts, beta, topics)`` of documents of about one size, about CHUNK words at a time.

    ``beta`` has a row per topic and a column per word. Documents are filled up to
    one width with a word that has none.
    """
    padded = np.concatenate([beta, np.zeros((len(beta), 1))], axis=1)
    widths, first = _widths(sizes), np.cumsum(sizes) - sizes
    order = np.argsort(widths, kind="stable")
    at = int(np.searchsorted(widths[order], 0, side="right"))
    while at < len(order):
        width = int(widths[order[at]])
        stop = min(at + max(1, CHUNK // width), int(np.searchsorted(widths[order], width, side="right")))
        docs = order[at:stop]
        place, inside = first[docs][:, None] + np.arange(width), np.arange(width) < sizes[docs][:, None]
        place[~inside] = 0
        words, n = np.where(inside, codes[place], beta.shape[1]), np.where(inside, counts[place], 0.0)
        own = np.ascontiguousarray(padded[:, words].transpose(1, 0, 2))
        yield docs, words, n, own, _topics_of_equal_widths(n, own, alpha)
        at = stop


def topics_of_documents(counts: np.ndarray, beta: np.ndarray, sizes: np.ndarray, alpha: float) -> np.ndarray:
    """``document_topics`` of documents of ``sizes`` words laid end to end, a row each."""
    out = np.zeros((len(sizes), beta.shape[1]))
    for docs, *_, gamma in _runs(np.arange(len(counts)), counts, sizes, beta.T, alpha):
        out[docs] = gamma
    return out


def _small(words: DataFrame, k: int) -> bool:
    return has_at_most(words.select("word"), MAX_BROADCAST_BYTES // (8 * k + 64))


class _Documents:
    """The documents of a block, the numbers that its words got, and which part has which word."""

    def __init__(self, held: dict[int, dict[int, bytes]], k: int, kind: type):
        sizes, codes, counts, order, split = (
            unpack(b"".join(own[i] for i in sorted(own)), np.int32)
            for own in (held.get(x, {}) for x in (SIZES, CODES, COUNTS, ORDER, SPLIT)))
        self.sizes, self.codes = sizes.astype(np.int64), np.cumsum(codes, dtype=np.int32)
        self.counts, self.order, self.split = counts.astype(np.float64), order, split
        got = held.get(NUMBERS, {})
        self.numbers = np.empty((len(order), k), kind)
        if got:
            self.numbers[order] = np.concatenate([unpack(got[p], kind).reshape(-1, k) for p in sorted(got)])

    def messages(self, key: int, numbers: np.ndarray) -> list[tuple]:
        """A row for each part with the numbers of its words."""
        dealt, ends = numbers[self.order], np.cumsum(self.split)
        return [(p, NUMBERS, key, pack(dealt[ends[p] - self.split[p]:ends[p]])) for p in np.flatnonzero(self.split).tolist()]


def bags_of(df: DataFrame, tokens: str, doc: Column) -> DataFrame:
    """``doc, bag``: each document's distinct tokens with their counts; documents without a token have no row.

    One shuffle by document, which both aggregations use.
    """
    each = explode_tokens(df.select(doc.alias("doc"), F.col(tokens).alias("_t")), ["doc"], "_t", "word").repartition("doc")
    counted = each.groupBy("doc", "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("doc").agg(F.collect_list(F.struct("word", "n")).alias("bag"))


def _vocabulary(key: int, table: pa.Table) -> pa.Table:
    """The words of a part in order, and the place of each block's words among them."""
    held = {block: read(data)[0] for block, data in held_of(table)[WORDS].items()}
    words = pa.chunked_array([*held.values()], pa.string()).unique()
    words = words.take(pc.array_sort_indices(words))
    rows = [(key, INDEX, block, pack(pc.index_in(own, value_set=words).to_numpy(zero_copy_only=False).astype(np.int32)))
            for block, own in sorted(held.items())]
    named = rows_of([*rows, *((key, WORD, i, None) for i in range(len(words)))])
    return pa.Table.from_batches([named]).append_column("word", pa.concat_arrays([pa.nulls(len(rows), pa.string()), words]))


def train_word_topics(df: DataFrame, k: int = NUM_TOPICS, tokens: str = "lemmatized_text", passes: int = LDA_PASSES,
                      alpha: float | None = None, eta: float | None = None, seed: int = SEED,
                      small: bool | None = None) -> WordTopics:
    """Fit ``k`` topics to token arrays in ``passes`` over the documents; tables of the passes before are removed.

    ``small`` keeps all words in one part; the result is the same.
    """
    if not 1 <= k <= MAX_TOPICS:
        raise ValueError(f"1 to {MAX_TOPICS} topics")
    spark = df.sparkSession
    alpha, eta = alpha or 1 / k, eta or 1 / k
    parts = 1 if small else _parts(k)
    paths = [new_path(spark, name) for name in ("topic-blocks", "topic-parts")]
    blocks = blocks_of(df.select(F.col(tokens).alias("_tokens")), _entries(k), parts, paths[0])
    of_blocks = blocks.filter(F.col("kind").isin(SIZES, CODES, COUNTS, ORDER, SPLIT))
    keys = keys_of(blocks, SIZES)
    of_parts = write_table(dealt([blocks.filter(F.col("kind") == WORDS)], [*range(parts)], _vocabulary, f"{ROW}, word string"), paths[1])
    index = of_parts.filter(F.col("kind") == INDEX).drop("word")
    # A start that depends on the word alone: about 1 for every topic.
    begun = F.array(*(F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col("word")), F.lit(START)).cast("long") for i in range(k)))
    named = of_parts.filter(F.col("kind") == WORD)
    started = named.withColumn("begun", begun)
    if not passes:
        words = named.select("word", F.transform(begun, lambda x: 0.5 + x / START).alias("weights"))

    def weights_of(numbers: np.ndarray, first: bool) -> np.ndarray:
        return 0.5 + numbers / START if first else numbers / FIXED + eta

    def given(key: int, numbers: np.ndarray, places: dict[int, bytes], first: bool) -> pa.Table:
        """What a part gives to the blocks, and its totals."""
        totals = np.floor(weights_of(numbers, first) * FIXED + 0.5).sum(axis=0).astype(np.int64)
        rows = [(block, NUMBERS, key, pack(numbers[unpack(data, np.int32)])) for block, data in sorted(places.items())]
        return pa.Table.from_batches([rows_of([*rows, (key, TOTALS, 0, pack(totals))])])

    def start(key: int, table: pa.Table) -> pa.Table:
        own = table.filter(pc.equal(table.column("kind"), WORD))
        numbers = own.take(pc.sort_indices(own, [("other", "ascending")])).column("begun").combine_chunks().flatten()
        return given(key, numbers.to_numpy(zero_copy_only=False).reshape(-1, k), held_of(table)[INDEX], True)

    def summed(held: dict[int, dict[int, bytes]]) -> np.ndarray:
        places = {block: unpack(data, np.int32) for block, data in held[INDEX].items()}
        out = np.zeros((max((int(x.max()) for x in places.values()), default=-1) + 1, k), np.int64)
        for block, data in held[NUMBERS].items():
            out[places[block]] += unpack(data, np.int64).reshape(-1, k)
        return out

    def add_up(key: int, table: pa.Table) -> pa.Table:
        held = held_of(table)
        return given(key, summed(held), held[INDEX], False)

    def final(key: int, table: pa.Table) -> pa.Table:
        own = table.filter(pc.equal(table.column("kind"), WORD))
        words = own.take(pc.sort_indices(own, [("other", "ascending")])).column("word").combine_chunks()
        weights = weights_of(summed(held_of(table)), False)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * k, pa.int32()), pa.array(weights.ravel()))
        return pa.Table.from_arrays([words.cast(pa.string()), lists], names=["word", "weights"])

    tables: list[str] = []
    for number in range(passes):
        if not number:
            got = dealt([index, started.drop("word")], [*range(parts)], start, ROW)
        else:
            got = dealt([index, shares], [*range(parts)], add_up, ROW)
        tables.append(new_path(spark, "topic-weights"))
        got = write_table(got, tables[-1])
        totals = sum((unpack(r["data"], np.int64) for r in got.filter(F.col("kind") == TOTALS).select("data").collect()),
                     np.zeros(k, np.int64)) / FIXED

        def run(key: int, table: pa.Table, psi=digamma(np.maximum(totals, 1 / FIXED)), first=not number) -> pa.Table:
            own = _Documents(held_of(table), k, np.int64)
            beta = np.exp(digamma(weights_of(own.numbers, first)) - psi)
            sums = np.zeros((k, len(beta) + 1))
            for _, words, counts, each, gamma in _runs(own.codes, own.counts, own.sizes, np.ascontiguousarray(beta.T), alpha):
                each *= exp_digamma(gamma)[:, :, None]
                each *= (counts / (each.sum(axis=1) + 1e-100))[:, None, :]
                at = words.ravel()
                for j in range(k):
                    np.add.at(sums[j], at, np.rint(each[:, j, :] * FIXED).ravel())
            return pa.Table.from_batches([rows_of(own.messages(key, sums[:, :-1].T.astype(np.int64)))])

        tables.append(new_path(spark, "topic-shares"))
        shares = write_table(dealt([of_blocks, got.filter(F.col("kind") == NUMBERS)], keys, run, ROW), tables[-1])
        for path in tables[:-1]:
            delete_path(spark, path)
        del tables[:-1]
    if passes:
        words = dealt([index, named, shares], [*range(parts)], final, STORED)
    words = write_table(words, new_path(spark, "word-topics"))
    for path in [*tables, *paths]:
        delete_path(spark, path)
    return WordTopics(words, _totals(words, k), alpha)


def _parts(k: int) -> int:
    return block_tables.PARTS * -(-k // 32)


def _entries(k: int) -> int:
    return max(1, block_tables.ENTRIES * 8 // max(8, k))


def _totals(words: DataFrame, k: int) -> list[float]:
    """The sum of each topic's weights, k numbers."""
    fixed = [F.sum(F.round(F.col("weights")[i] * FIXED).cast("decimal(38,0)")).alias(f"_{i}") for i in range(k)]
    return [float(x or 0) / FIXED for x in words.agg(*fixed).first()]


def topic_shares(df: DataFrame, model: WordTopics, keys: list[str], tokens: str = "lemmatized_text",
                 small: bool | None = None) -> DataFrame:
    """``keys, shares``: each document's share of every topic, summing to 1; without a known word all are equal.

    Rows of one key are one document, which each of them gets the shares of.
    ``small`` forces (or forbids) keeping all words in one part, which is else
    decided by their number; the result is the same.
    """
    spark, k, alpha = df.sparkSession, model.k, model.alpha
    psi = digamma(np.maximum(model.totals, 1 / FIXED))
    small = _small(model.words, k) if small is None else small
    parts = 1 if small else _parts(k)
    own = df.select(F.col(tokens).alias("_tokens"), F.struct(*keys).alias("doc"))
    path = new_path(spark, "topic-blocks")
    blocks = blocks_of(own, _entries(k), parts, path)
    repeated = not blocks.filter(F.col("kind") == DOC).groupBy("doc").count().filter("count > 1").isEmpty()
    if repeated:
        delete_path(spark, path)
        merged = own.groupBy("doc").agg(F.flatten(F.collect_list("_tokens")).alias("_tokens")).select("_tokens", "doc")
        blocks = blocks_of(merged, _entries(k), parts, new_path(spark, "topic-blocks"))
    own_keys = keys_of(blocks, DOC)

    def known(key: int, table: pa.Table) -> pa.Table:
        held = held_of(table)
        model_ = [read(data) for data in held.get(MODEL, {}).values()]
        words = pa.chunked_array([m[0] for m in model_], pa.string()).combine_chunks()
        weights = np.concatenate([m[1].flatten().to_numpy(zero_copy_only=False) for m in model_] or [np.empty(0)]).reshape(-1, k)
        rows = []
        for block, data in sorted(held.get(WORDS, {}).items()):
            at = pc.fill_null(pc.index_in(read(data)[0], value_set=words), len(weights)).to_numpy(zero_copy_only=False)
            rows.append((block, NUMBERS, key, pack(np.concatenate([weights, np.full((1, k), np.nan)])[at])))
        return pa.Table.from_batches([rows_of(rows)])

    def run(key: int, table: pa.Table) -> pa.Table:
        own = _Documents(held_of(table), k, np.float64)
        unknown = np.isnan(own.numbers[:, 0])
        beta = np.where(unknown[:, None], 0.0, np.exp(digamma(np.where(unknown[:, None], 1.0, own.numbers)) - psi))
        counts = np.where(unknown[own.codes], 0.0, own.counts)
        docs = table.filter(pc.equal(table.column("kind"), DOC))
        docs = docs.take(pc.sort_indices(docs, [("other", "ascending")])).column("doc").combine_chunks()
        rows = np.full((len(docs), k), 1 / k)
        for at, _, n_, _, gamma in _runs(own.codes, counts, own.sizes, np.ascontiguousarray(beta.T), alpha):
            some = n_.any(axis=1)
            rows[at[some]] = (gamma / gamma.sum(axis=1, keepdims=True))[some]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(docs) + 1) * k, pa.int32()), pa.array(rows.ravel()))
        return pa.Table.from_arrays([docs, lists], names=["doc", "shares"])

    # The words of the model may be many for one task: a part's are its own.
    asked = blocks.filter(F.col("kind") == WORDS).drop("doc")
    got = write_table(dealt([asked, model_rows(model.words.select("word", "weights"), parts)], [*range(parts)], known, ROW),
                      new_path(spark, "topic-weights"))
    kind = blocks.schema["doc"].dataType.simpleString()
    found = dealt([blocks.filter(~F.col("kind").isin(WORDS)), got], own_keys, run, f"doc {kind}, shares array<double>").select("doc.*", "shares")
    if not repeated:
        return found
    condition = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    joined = df.select(*keys).alias("a").join(found.alias("b"), condition, "left")
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in keys],
                         F.coalesce("b.shares", F.lit([1 / k] * k).cast("array<double>")).alias("shares"))


def topic_weights(model: WordTopics) -> DataFrame:
    """``topic, word, weight``: the probability of each word in each topic."""
    totals = F.lit([float(t) for t in model.totals])
    each = model.words.select("word", F.posexplode("weights").alias("topic", "w"))
    return each.select(F.col("topic").cast("int").alias("topic"), "word", (F.col("w") / F.get(totals, F.col("topic"))).alias("weight"))


def log_likelihood(df: DataFrame, model: WordTopics, tokens: str = "lemmatized_text") -> DataFrame:
    """``(n_words, per_word)``: the mean log-probability of the known tokens, given their documents' shares."""
    numbered = df.select(F.monotonically_increasing_id().alias("_doc"), F.col(tokens).alias("_tokens"))
    shares = topic_shares(numbered, model, ["_doc"], "_tokens")
    each = bags_of(numbered, "_tokens", F.col("_doc")).select(F.col("doc").alias("_doc"), F.explode("bag").alias("b"))
    weights = model.words.select("word", F.zip_with("weights", F.lit([float(t) for t in model.totals]), lambda w, t: w / t).alias("p"))
    each = lookup_join(each.select("_doc", "b.word", "b.n"), weights, "word", "inner", F.col("_doc"), small=_small(model.words, model.k))
    likely = F.aggregate(F.zip_with("p", "shares", lambda p, s: p * s), F.lit(0.0), lambda acc, x: acc + x)
    return each.join(shares, "_doc").agg(F.sum("n").alias("n_words"), (F.sum(F.col("n") * F.log(likely)) / F.sum("n")).alias("per_word"))
