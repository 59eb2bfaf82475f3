"""End-to-end plans: prepare, train, evaluate, score, find topics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta import SEED
from glotta.operators import classification, evaluation, topics, word_topics
from glotta.operators.boosting import BoostedClassifier
from glotta.operators.cleaning import clean_text
from glotta.operators.hashed_language import HashedProfiles
from glotta.operators.language import LanguageProfiles, detect_language
from glotta.operators.normalization import (lemmatize_pos_filter, nonempty_lemmas, normalize_documents, stem_documents)
from glotta.operators.translation import translate_detected
from glotta.operators.vectors import document_to_vector
from glotta.scratch import materialize
from glotta.sources.models import load_holdout, load_model, save_model
from glotta.sources.translations import translated_only, translation_lookup


def embed_documents(df: DataFrame, word_vectors: DataFrame, keys: list[str],
                    text: str = "translated_text") -> DataFrame:
    """``keys, document_embeddings`` of the documents that have at least one known word.

    The vocabulary filter of normalisation is the inner join with the word
    vectors, so it is applied once, here.
    """
    normalized = normalize_documents(df.select(*keys, text), text)
    return document_to_vector(normalized, word_vectors, keys)


def labelled_vectors(corpus: DataFrame, store: DataFrame, word_vectors: DataFrame, keys: list[str],
                     label: str = "context") -> DataFrame:
    """``keys, label, document_embeddings`` for the translated documents, written once."""
    group = list(dict.fromkeys(keys + [label]))
    translated = translated_only(translation_lookup(corpus.select(*group), store, keys))
    return materialize(embed_documents(translated, word_vectors, group), "labelled-vectors")


@dataclass(frozen=True)
class ClassifierRun:
    model: classification.TrainedClassifier | BoostedClassifier
    train: DataFrame
    test: DataFrame
    report: DataFrame


def train_document_classifier(vectors: DataFrame, keys: list[str], label: str = "context", method: str = "softmax",
                              path: str | None = None, seed: int = SEED) -> ClassifierRun:
    """Hold out about one tenth, train on the rest, report on the hold-out; save when ``path`` is given.

    Documents of one vector, copies above all, are on one side of the split.
    """
    split = classification.content_split(vectors, "document_embeddings", seed=seed)
    train = split.filter(~F.col("is_test")).drop("is_test")
    test = split.filter("is_test").drop("is_test")
    model = classification.train_classifier(train, label, method=method, seed=seed, test=test)
    report = evaluate(test, model, label)
    if path is not None:
        save_model(model, path, test)
    return ClassifierRun(model, train, test, report)


def evaluate(test: DataFrame, model: classification.TrainedClassifier | PipelineModel | BoostedClassifier,
             label: str = "context") -> DataFrame:
    predicted = classification.predict_class(test, model, [label])
    return evaluation.classification_report(predicted, label, "class_")


def evaluate_saved(spark, path: str, label: str = "context") -> DataFrame:
    """Score the stored hold-out with the stored model."""
    return evaluate(load_holdout(spark, path), load_model(path), label)


def score_documents(df: DataFrame, keys: list[str], profiles: LanguageProfiles | HashedProfiles, word_vectors: DataFrame,
                    model: classification.TrainedClassifier | PipelineModel | BoostedClassifier, lexicon: DataFrame | None = None,
                    text: str = "text") -> DataFrame:
    """Clean, detect, translate, normalise, embed and classify raw texts.

    Returns ``keys, detected_language, class_, probability`` for every document;
    one that cannot be translated or embedded has a NULL class. The labels (one
    small row per document) are needed twice, so they are written once.
    """
    cleaned = clean_text(df.select(*keys, text), text).select(*keys, "cleaned_text")
    detected = materialize(detect_language(cleaned, profiles, keys), "detected-languages")
    translated = translate_detected(cleaned.join(detected, keys, "left"), keys, lexicon)
    group = keys + ["detected_language"]
    vectors = embed_documents(translated, word_vectors, group)
    predicted = classification.predict_class(vectors, model, keys)
    return detected.join(predicted, keys, "left")


def lemmatized_corpus(df: DataFrame, keys: list[str], lexicon: DataFrame | None = None,
                      text: str = "translated_text", stems: bool = False) -> DataFrame:
    """``keys, lemmatized_text`` (and ``stemmed_text``) of documents with a lemma left."""
    normalized = normalize_documents(df.select(*keys, text), text).drop(text)
    lemmas = nonempty_lemmas(lemmatize_pos_filter(normalized, keys, lexicon))
    if not stems:
        return lemmas
    return stem_documents(lemmas.withColumn("_tokens", F.col("lemmatized_text")), "_tokens")


@dataclass(frozen=True)
class KMeansTopics:
    model: KMeansModel
    words: DataFrame


def kmeans_topics(vectors: DataFrame, word_vectors: DataFrame, k: int = topics.NUM_TOPICS,
                  words: int = topics.WORDS_PER_CENTROID, seed: int = SEED) -> KMeansTopics:
    """Cluster document vectors and describe each center by its nearest words."""
    model = topics.train_kmeans(vectors, k, seed=seed)
    centers = {i: [float(x) for x in c] for i, c in enumerate(model.clusterCenters())}
    return KMeansTopics(model, topics.nearest_words(word_vectors, centers, words))


def lda_topics(lemmas: DataFrame, k: int = topics.NUM_TOPICS, column: str = "lemmatized_text",
               **options) -> tuple[topics.TrainedLda | word_topics.WordTopics, DataFrame]:
    """Fit LDA on lemmas (or stems) and describe the topics.

    A vocabulary beyond the bound of ``train_lda`` is kept as a table, with as many
    passes over the documents. That form has no mini-batches and cuts no words:
    with options of these the error of ``train_lda`` stands.
    """
    try:
        trained = topics.train_lda(lemmas, k, column, **options)
    except topics.VocabularyTooLarge:
        if options.keys() - {"passes", "seed"}:
            raise
        trained = word_topics.train_word_topics(lemmas, k, column, **options)
    return trained, describe_lda(trained)


def describe_lda(trained: topics.TrainedLda | word_topics.WordTopics, words: int = topics.WORDS_PER_TOPIC) -> DataFrame:
    """``(topic, rank, word, weight)``: the heaviest words of each topic of either form."""
    if isinstance(trained, topics.TrainedLda):
        return topics.describe_topics(trained, words)
    found = topics.topic_word_weights(word_topics.topic_weights(trained), words)
    return found.select("topic", F.col("rank").cast("int").alias("rank"), "word", "weight")


def lda_shares(df: DataFrame, trained: topics.TrainedLda | word_topics.WordTopics, keys: list[str],
               column: str = "lemmatized_text") -> DataFrame:
    """``keys, shares``: each document's share of every topic of either form."""
    if isinstance(trained, topics.TrainedLda):
        scored = trained.model.transform(trained.vectorizer.transform(df))
        return scored.select(*keys, vector_to_array("topicDistribution").alias("shares"))
    return word_topics.topic_shares(df, trained, keys, column)
