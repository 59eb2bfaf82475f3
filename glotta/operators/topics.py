"""Topics: K-means on document vectors, LDA on bags of lemmas, and their descriptions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import LDA, KMeans, KMeansModel, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glotta import SEED
from glotta.operators.once import explode_tokens
from glotta.operators.ranking import hash_rank
from glotta.operators.vectors import to_features
from glotta.scratch import materialize

# Topic-model settings.
NUM_TOPICS = 10
WORDS_PER_CENTROID = 50
LDA_PASSES = 20
WORDS_PER_TOPIC = 10
NO_BELOW = 50
NO_ABOVE = 0.5

MAX_LDA_VOCABULARY = 2_000_000


class VocabularyTooLarge(ValueError):
    """More words are left than ``train_lda`` keeps on the driver."""


def train_kmeans(vectors: DataFrame, k: int = NUM_TOPICS, column: str = "document_embeddings",
                 seed: int = SEED) -> KMeansModel:
    features = to_features(vectors, column).select("features").persist()
    try:
        return KMeans(k=k, seed=seed).fit(features)
    finally:
        features.unpersist()


def assign_topics(vectors: DataFrame, model: KMeansModel, keys: list[str],
                  column: str = "document_embeddings") -> DataFrame:
    scored = model.transform(to_features(vectors, column))
    return scored.select(*keys, F.col("prediction").cast("int").alias("topic"))


def nearest_words(word_vectors: DataFrame, centers: dict[int, list[float]],
                  topn: int = WORDS_PER_CENTROID) -> DataFrame:
    """``(topic, rank, word, similarity)``: the ``topn`` words closest to each center by cosine.

    ``centers`` are the k trained centers, which the model holds on the driver
    already; they enter the plan as literals, so the word table is read once and
    nothing is joined. Words are cut to ``topn`` per topic in each task before
    the shuffle. Similarities are compared after rounding to six places.
    """
    def cosine(center: list[float]):
        norm = math.sqrt(sum(x * x for x in center))
        literal = F.lit([float(x) for x in center])
        dot = F.aggregate(F.zip_with("_e", literal, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        return F.round(F.try_divide(dot, F.col("_norm") * F.lit(norm)), 6)

    embedded = word_vectors.select("word", F.col("embedding").cast("array<double>").alias("_e"))
    squares = F.aggregate(F.transform("_e", lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x)
    cells = F.array(*[F.struct(F.lit(topic).alias("topic"), cosine(center).alias("similarity"))
                      for topic, center in sorted(centers.items())])
    scored = (embedded.withColumn("_norm", F.sqrt(squares)).select("word", F.explode(cells).alias("c"))
              .select("word", "c.topic", "c.similarity").filter(F.col("similarity").isNotNull()))
    best = Window.partitionBy("topic").orderBy(F.desc("similarity"), "word")
    return (scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= topn)
            .select("topic", "rank", "word", "similarity"))


def build_dictionary(df: DataFrame, tokens: str = "lemmatized_text") -> DataFrame:
    """``(token, token_id, doc_freq)`` for every distinct token; ids are 0..n-1 in token-hash order.

    The counts are written once: ranking reads them twice.
    """
    distinct = df.select(F.array_distinct(tokens).alias("_distinct"))
    freq = explode_tokens(distinct, [], "_distinct").groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))
    freq = materialize(freq, "dictionary")
    ranked = hash_rank(freq, ["token"], SEED, out="token_id")
    return ranked.select("token", (F.col("token_id") - 1).alias("token_id"), "doc_freq")


def filter_extremes(dictionary: DataFrame, n_documents: int, no_below: int = NO_BELOW,
                    no_above: float = NO_ABOVE) -> DataFrame:
    """Drop tokens in fewer than ``no_below`` documents or in more than ``no_above`` of them. Optional."""
    return dictionary.filter((F.col("doc_freq") >= no_below) & (F.col("doc_freq") <= no_above * n_documents))


def bag_of_words(df: DataFrame, keys: list[str], tokens: str = "lemmatized_text") -> DataFrame:
    """``(keys, token, n)``: how often each document holds each token."""
    return explode_tokens(df, keys, tokens).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))


def corpus_stats(df: DataFrame, tokens: str = "lemmatized_text") -> DataFrame:
    """``(stat, value)``: number of distinct tokens and number of documents."""
    # One pass over the documents: each adds a null to its tokens.
    kind = df.schema[tokens].dataType
    marked = F.concat(F.lit([None]).cast(kind), F.coalesce(F.array_compact(tokens), F.array().cast(kind)))
    counts = df.select(F.explode_outer(marked).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.count("token").alias("unique_tokens"),
                      F.coalesce(F.sum(F.when(F.col("token").isNull(), F.col("n"))), F.lit(0)).alias("documents"))
    return both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).alias("value"))
                                           for c in ("unique_tokens", "documents")])).alias("_s")).select("_s.*")


@dataclass(frozen=True)
class TrainedLda:
    vectorizer: CountVectorizerModel
    model: LDAModel


def train_lda(df: DataFrame, k: int = NUM_TOPICS, tokens: str = "lemmatized_text", passes: int = LDA_PASSES,
              subsampling_rate: float = 1.0, min_df: float = 1.0, max_df: float | None = None,
              seed: int = SEED) -> TrainedLda:
    """Online LDA; ``passes`` over the documents, each split into ``1 / subsampling_rate`` mini-batches.

    The model itself (vocabulary x k) lives on the driver in MLlib, so the tokens
    that ``min_df`` and ``max_df`` leave (counts from 1 on, else shares of the
    documents) are counted first: more than the bound is an error, never a cut.
    ``word_topics.train_word_topics`` has no such bound.
    """
    documents = df.select(tokens)
    # Counted before anything is cached: beyond the bound nothing is.
    n = documents.count() if any(x is not None and x < 1 for x in (min_df, max_df)) else 0
    least, most = (x if x is None or x >= 1 else x * n for x in (min_df, max_df))
    freq = documents.select(F.explode(F.array_distinct(tokens)).alias("t")).groupBy("t").count()
    kept = freq.filter(F.col("count") >= least)
    size = (kept if most is None else kept.filter(F.col("count") <= most)).count()
    if size > MAX_LDA_VOCABULARY:
        raise VocabularyTooLarge(f"{size} tokens are left, {MAX_LDA_VOCABULARY} at most: set min_df / max_df")
    documents = documents.persist()
    try:
        limits = {} if max_df is None else {"maxDF": float(max_df)}
        vectorizer = CountVectorizer(inputCol=tokens, outputCol="features", minDF=min_df,
                                     vocabSize=max(size, 1), **limits).fit(documents)
        bags = vectorizer.transform(documents).select("features").persist()
        try:
            model = LDA(k=k, optimizer="online", seed=seed, subsamplingRate=subsampling_rate,
                        maxIter=math.ceil(passes / subsampling_rate)).fit(bags)
        finally:
            bags.unpersist()
    finally:
        documents.unpersist()
    return TrainedLda(vectorizer, model)


def describe_topics(lda: TrainedLda, words: int = WORDS_PER_TOPIC) -> DataFrame:
    """``(topic, rank, word, weight)``: the heaviest words of each topic (k x ``words`` rows)."""
    vocabulary = lda.vectorizer.vocabulary
    rows = [(r["topic"], rank + 1, vocabulary[i], float(w))
            for r in lda.model.describeTopics(words).collect()
            for rank, (i, w) in enumerate(zip(r["termIndices"], r["termWeights"]))]
    spark = lda.model.describeTopics(1).sparkSession
    return spark.createDataFrame(rows, "topic int, rank int, word string, weight double")


def topic_word_weights(weights: DataFrame, words: int = WORDS_PER_TOPIC) -> DataFrame:
    """``(topic, rank, word, weight, relative)``: heaviest words, relative to the topic's maximum.

    Input ``(topic, word, weight)``. The first row of a topic is its maximum, so
    the cut to ``words`` rows per topic happens first, before the shuffle.
    """
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
    top = weights.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= words)
    whole = Window.partitionBy("topic")
    return top.select("topic", "rank", "word", "weight",
                      F.round(F.col("weight") / F.max("weight").over(whole), 6).alias("relative"))


def topic_term_relevance(weights: DataFrame, word_frequencies: DataFrame, lam: float = 0.6,
                         topn: int = 30) -> DataFrame:
    """``(topic, rank, word, relevance)``: lam * log p(w|t) + (1 - lam) * log(p(w|t) / p(w)).

    ``weights(topic, word, weight)`` are normalised per topic and
    ``word_frequencies(word, n)`` over the corpus. Relevance is rounded to six
    places before ranking, so ties are broken by the word alone.
    """
    total_n = word_frequencies.agg(F.sum("n").alias("t")).first()["t"] or 1
    totals = weights.groupBy("topic").agg(F.sum("weight").alias("_total"))  # one small row per topic
    joined = weights.filter(F.col("weight") > 0).join(word_frequencies, "word").join(totals, "topic")
    p_wt = F.col("weight") / F.col("_total")
    p_w = F.col("n") / F.lit(float(total_n))
    relevance = F.round(F.lit(lam) * F.log(p_wt) + F.lit(1 - lam) * F.log(p_wt / p_w), 6)
    best = Window.partitionBy("topic").orderBy(F.desc("relevance"), "word")
    return (joined.withColumn("relevance", relevance).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= topn).select("topic", "rank", "word", "relevance"))
