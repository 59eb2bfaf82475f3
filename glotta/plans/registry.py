"""Every operator as a query over the given tables: ``name -> f(spark, sf_dir)``.

``documents`` is the corpus: ``source`` is the context, ``lang`` the language and
``doc_id`` the document name. Arrays are shown as joined text and floats rounded
to six places, so results compare by value.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta import SEED
from glotta.functions import text as text_fx
from glotta.functions import tokens as token_fx
from glotta.functions.lexicons import ENGLISH_TARGET_PREFIX, TO_SPANISH, supported_languages
from glotta.operators import (calibration, classification, cleaning, hashed_language, language, normalization,
                              phrases, profiling, tagger, topic_layout, topics, translation, vectors, word_topics)
from glotta.operators.evaluation import classification_report
from glotta.operators.once import explode_tokens
from glotta.operators.ranking import at_least_first, order_rank
from glotta.plans import pipelines
from glotta.scratch import materialize, new_path
from glotta.sources import corpus as corpus_source
from glotta.sources import models, translations, word_vectors
from glotta.streaming.scoring import score_stream

DOC = ["docname"]
SMALL_TABLE = 128 << 20


# --- bindings of the given tables -------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The given table over all cores: its files are too few to split, and small enough to move.

    By its size in bytes as the optimizer knows it; a larger table is left alone.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if size <= SMALL_TABLE else df


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bound = corpus_source.corpus_from_table(docs, "source", "lang", "doc_id", "text")
    return dealt(bound, "docname")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as it is scanned, for queries that only count or scan."""
    return corpus_source.corpus_from_table(table(spark, sf_dir, "documents"), "source", "lang", "doc_id", "text")


def cleaned(spark, sf_dir) -> DataFrame:
    return cleaning.clean_text(corpus(spark, sf_dir)).drop("text")


def normalized(spark, sf_dir) -> DataFrame:
    """``docname, normalized_text`` of the cleaned texts."""
    docs = normalization.normalize_documents(cleaned(spark, sf_dir), "cleaned_text")
    return docs.select("docname", "language", "context", "normalized_text")


def lemmas(spark, sf_dir) -> DataFrame:
    return normalization.lemmatize_pos_filter(normalized(spark, sf_dir), DOC)


def bound_word_vectors(spark, sf_dir) -> DataFrame:
    """The word of frequency rank r gets vector r - 1: one row per given vector.

    Words are ranked in ranges of their order, whatever their number; those rarer
    than any that can have a vector are left out before.
    """
    vecs = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    counts = materialize(profiling.word_frequencies(normalized(spark, sf_dir)), "word-counts")
    last = vecs.agg(F.max("vec_id").alias("v")).first()["v"]
    ranked = order_rank(at_least_first(counts, -1 if last is None else last + 1), [F.desc("n"), F.col("word")])
    ranked = ranked.select("word", (F.col("rank") - 1).alias("vec_id"))
    return materialize(ranked.join(vecs, "vec_id").select("word", "embedding"), "bound-word-vectors")


def store(spark, sf_dir) -> DataFrame:
    """Translations of the corpus languages; other documents have none."""
    done = translation.translate_corpus(cleaned(spark, sf_dir), DOC)
    return done.select(*corpus_source.KEYS, "translated_text")


def labelled(spark, sf_dir, words: DataFrame | None = None) -> DataFrame:
    """Vectors of the translated documents with the language as the class to learn."""
    words = words if words is not None else bound_word_vectors(spark, sf_dir)
    docs = cleaned(spark, sf_dir)
    translated = translation.translate(docs, DOC, "language").withColumn("label", F.col("language"))
    made = pipelines.embed_documents(translated, words, ["docname", "label"])
    return materialize(made, "labelled-vectors")


def joined(tokens: str, out: str | None = None):
    return F.array_join(tokens, " ").alias(out or tokens)


# --- scans, sources, sinks --------------------------------------------------------------------------

def corpus_scan(spark, sf_dir):
    """Writes the corpus as a tree of text files, one folder per key, and scans it."""
    root = new_path(spark, "corpus-tree")
    corpus_source.write_hive_corpus(corpus(spark, sf_dir), root)
    return corpus_source.scan_hive_corpus(spark, root)


def word_vectors_scan(spark, sf_dir):
    path = new_path(spark, "vec-gz")
    word_vectors.write_word_vectors(bound_word_vectors(spark, sf_dir), path)
    read = word_vectors.scan_word_vectors(spark, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read.select("word", F.size("embedding").cast("bigint").alias("dims"), F.round(total, 6).alias("total"))


def translation_store_write(spark, sf_dir):
    path = new_path(spark, "translations")
    translations.write_translations(store(spark, sf_dir), path)
    return translations.read_translations(spark, path)


def translation_lookup(spark, sf_dir):
    found = translations.translation_lookup(raw_documents(spark, sf_dir).drop("text"), store(spark, sf_dir))
    return found.select("docname", "translated_text")


def translated_only(spark, sf_dir):
    found = translations.translation_lookup(raw_documents(spark, sf_dir).drop("text"), store(spark, sf_dir))
    return translations.translated_only(found).select("docname", "language")


def model_save_load(spark, sf_dir):
    data = labelled(spark, sf_dir)
    path = new_path(spark, "classifier")
    models.save_model(classification.train_classifier(data, "label"), path)
    return classification.predict_class(data, models.load_model(path), ["docname", "label"])


def model_store(spark, sf_dir):
    """``(model, n, equal)``: rows that a joint classifier, K-means and LDA give after loading, and how many are as before."""
    data = labelled(spark, sf_dir)
    boosted = classification.train_classifier(data, "label", method="boosted")
    kmeans = topics.train_kmeans(data)
    lda = _lda(spark, sf_dir)[1]
    uses = [("boosted", boosted, lambda m: classification.predict_class(data, m, DOC), DOC),
            ("kmeans", kmeans, lambda m: topics.assign_topics(data, m, DOC), DOC),
            ("lda", lda, pipelines.describe_lda, ["topic", "rank"])]
    out = None
    for name, model, use, keys in uses:
        path = new_path(spark, f"model-{name}")
        models.save_model(model, path)
        rest = lambda df: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias("rest"))  # noqa: B023, E731
        before, after = rest(use(model)), rest(use(models.load_model(path))).withColumnRenamed("rest", "again")
        found = before.join(after, keys, "full").agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"),
            F.sum(F.col("rest").eqNullSafe(F.col("again")).cast("long")).alias("equal"))
        out = found if out is None else out.unionByName(found)
    return out


def sample_n(spark, sf_dir):
    return corpus_source.sample_n(raw_documents(spark, sf_dir), 10, DOC).select("docname", "language")


def peek(spark, sf_dir):
    return corpus_source.peek(raw_documents(spark, sf_dir), DOC)


def peek_row(spark, sf_dir):
    return corpus_source.row_at(raw_documents(spark, sf_dir), DOC, 100)


# --- cleaning ---------------------------------------------------------------------------------------

def clean_pixels(spark, sf_dir):
    sized = F.concat(F.length("text"), F.lit("px|"), F.col("text"), F.lit(" 12px"))
    return corpus(spark, sf_dir).select("docname", text_fx.clean_pixels(sized).alias("cleaned_text"))


def clean_box_assign(spark, sf_dir):
    pages = dealt(table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", text_fx.clean_box_assign(F.col("html")).alias("cleaned_text"))


def remove_long_words(spark, sf_dir):
    return corpus(spark, sf_dir).select("docname", text_fx.remove_long_words(F.col("text")).alias("cleaned_text"))


def remove_urls(spark, sf_dir):
    pages = dealt(table(spark, sf_dir, "pages"), "page_id")
    wrapped = F.concat(F.lit("see "), F.col("url"), F.lit(" for more. "), F.col("html"))
    return pages.select("page_id", text_fx.remove_urls(wrapped).alias("cleaned_text"))


def clean_text(spark, sf_dir):
    return cleaned(spark, sf_dir).select("docname", "cleaned_text")


def strip_wiki_trailers(spark, sf_dir):
    wiki = F.concat(F.col("text"), F.lit("\nCategory: "), F.col("context"), F.lit("\n* "), F.col("language"),
                    F.lit(": "), F.col("docname"), F.lit("\nend"))
    return corpus(spark, sf_dir).select("docname", text_fx.strip_wiki_trailers(wiki).alias("stripped_text"))


def nonempty_cleaned(spark, sf_dir):
    return cleaning.nonempty_cleaned(cleaned(spark, sf_dir)).select("docname")


# --- language ---------------------------------------------------------------------------------------

def fit_language_profiles(spark, sf_dir):
    return language.fit_language_profiles(cleaned(spark, sf_dir)).as_rows()


def detect_language(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    return language.detect_language(docs, language.fit_language_profiles(docs), DOC)


def fit_hashed_profiles(spark, sf_dir):
    """The counts of every language's n-grams by their place in the table."""
    made = hashed_language.fit_hashed_profiles(cleaned(spark, sf_dir))
    rows = [(made.languages[i], int(place), int(made.counts[place, i])) for place, i in zip(*made.counts.nonzero())]
    return spark.createDataFrame(rows, "language string, place bigint, n bigint")


def detect_language_hashed(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    return language.detect_language(docs, hashed_language.fit_hashed_profiles(docs), DOC)


def language_accuracy_by_length(spark, sf_dir):
    """Profiles of nine tenths of the documents judged on the other tenth."""
    docs = cleaned(spark, sf_dir).withColumn("_held", F.col("docname").cast("bigint") % 10 == 0)
    made = hashed_language.fit_hashed_profiles(docs.filter("not _held"))
    return hashed_language.accuracy_by_length(docs.filter("_held"), made)


def safe_detect(spark, sf_dir):
    """Half of the rows are texts, half their lengths: digits alone have no language."""
    docs = cleaned(spark, sf_dir)
    digits = docs.select(F.concat(F.lit("n"), "docname").alias("docname"),
                         F.length("cleaned_text").cast("string").alias("cleaned_text"))
    both = docs.select("docname", "cleaned_text").unionByName(digits)
    return language.detect_language(both, language.fit_language_profiles(docs), DOC)


def language_mismatch_counts(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    found = language.detect_language(docs, language.fit_language_profiles(docs), ["docname", "language"])
    return language.language_mismatch_counts(found)


# --- translation ------------------------------------------------------------------------------------

def supported_language_counts(spark, sf_dir):
    """Every supported language with the number of documents in it."""
    counts = raw_documents(spark, sf_dir).groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    langs = supported_languages(spark)
    return langs.join(counts, langs["lang"] == counts["language"], "left").select(
        "lang", "model_name", F.coalesce("n", F.lit(0)).alias("n"))


def route_translation(spark, sf_dir):
    return translation.route_translation(raw_documents(spark, sf_dir).drop("text")).select(
        "docname", "language", "route", "model_name")


def english_target_prefix(spark, sf_dir):
    routed = translation.route_translation(cleaned(spark, sf_dir))
    return translation.english_target_prefix(routed).select("docname", "model_input")


def translation_batches(spark, sf_dir):
    return translation.translation_batches(cleaned(spark, sf_dir), DOC)


def lexicon_translate(spark, sf_dir):
    return translation.lexicon_translate(cleaned(spark, sf_dir), DOC).select("docname", "translated_text")


def phrase_lexicon(spark, sf_dir) -> DataFrame:
    """Entries of one to four words, from the first words of the benchmark's items, which some documents quote."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("(" + text_fx.WORD + "+)"), F.lit(1))
    n = (F.col("item_id") % 4 + 1).cast("int")
    items = table(spark, sf_dir, "benchmark").select(n.alias("n"), words.alias("w")).filter(F.size("w") >= F.col("n"))
    token = F.array_join(F.slice("w", F.lit(1), F.col("n")), " ")
    return items.select(F.lit("en").alias("lang"), token.alias("token"), F.concat(F.lit("<"), F.upper(token), F.lit(">")).alias("es_token"))


def translate_phrases(spark, sf_dir):
    docs = cleaned(spark, sf_dir).select("docname", "language", "cleaned_text")
    made = phrases.translate_phrases(docs, materialize(phrase_lexicon(spark, sf_dir), "phrase-lexicon"))
    return made.select("docname", "translated_text")


def translate_with_model(spark, sf_dir):
    """The model hook with a stand-in for a user's model: the default lexicon applied to a batch of texts.

    The factory closes over plain values only and is defined here, so it travels
    to the Python workers by value and they need not be able to import this package.
    """
    lexicon = {lang: dict(words) for lang, words in TO_SPANISH.items()}
    prefix = ENGLISH_TARGET_PREFIX

    def load_model():
        import re

        import numpy as np

        word = re.compile(r"\w+")

        def predict(model_names, texts):
            out = []
            for name, text in zip(model_names, texts):
                lang = name.split("opus-mt-")[1].split("-")[0]
                known = lexicon.get(lang, {})
                body = text.removeprefix(prefix) if lang == "en" else text
                out.append(word.sub(lambda m: known.get(m.group().lower(), m.group()), body))
            return np.array(out, dtype=object)

        return predict

    done = translation.translate_with_model(cleaned(spark, sf_dir), load_model)
    return done.select("docname", "translated_text")


def translate_corpus(spark, sf_dir):
    return store(spark, sf_dir)


def translate_detected(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    found = language.add_detected_language(docs, language.fit_language_profiles(docs), DOC)
    return translation.translate_detected(found, DOC).select("docname", "detected_language", "route",
                                                             "translated_text")


# --- normalisation ----------------------------------------------------------------------------------

def tokenize(spark, sf_dir):
    docs = corpus(spark, sf_dir).withColumn("tokens", token_fx.tokenize(F.col("text")))
    return docs.select("docname", joined("tokens"))


def lowercase_tokens(spark, sf_dir):
    docs = corpus(spark, sf_dir).withColumn("tokens", token_fx.lowercase(token_fx.tokenize(F.col("text"))))
    return docs.select("docname", joined("tokens"))


def dedupe_tokens(spark, sf_dir):
    docs = corpus(spark, sf_dir).withColumn("tokens", token_fx.dedupe(token_fx.tokenize(F.lower("text"))))
    return docs.select("docname", joined("tokens"))


def remove_stopwords(spark, sf_dir):
    docs = corpus(spark, sf_dir).withColumn("tokens", token_fx.remove_stopwords(token_fx.tokenize(F.col("text"))))
    return docs.select("docname", joined("tokens"))


def keep_in_vocabulary(spark, sf_dir):
    vocabulary = bound_word_vectors(spark, sf_dir).select("word")
    return normalization.keep_in_vocabulary(normalized(spark, sf_dir), vocabulary, DOC).select(
        "docname", joined("normalized_text"))


def normalize_document(spark, sf_dir):
    return normalized(spark, sf_dir).select("docname", joined("normalized_text"))


def nonempty_normalized(spark, sf_dir):
    return normalization.nonempty_normalized(normalized(spark, sf_dir)).select("docname")


def lemmatize_pos_filter(spark, sf_dir):
    return lemmas(spark, sf_dir).select("docname", joined("lemmatized_text"))


def nonempty_lemmas(spark, sf_dir):
    return normalization.nonempty_lemmas(lemmas(spark, sf_dir)).select("docname")


def _tagger(spark, sf_dir):
    return tagger.fit_tagger(tagger.sentences(cleaned(spark, sf_dir).select("docname", "cleaned_text"), DOC))


def tagger_counts(spark, sf_dir):
    """How often word classes follow each other and which words they have, over all sentences."""
    return _tagger(spark, sf_dir).counts


def tag_in_context(spark, sf_dir):
    docs = cleaned(spark, sf_dir).select("docname", "cleaned_text")
    tagged = tagger.tag_sentences(tagger.sentences(docs, DOC), _tagger(spark, sf_dir))
    return tagged.select("docname", "sentence", joined("tokens"), joined("tags"))


def lemmatize_in_context(spark, sf_dir):
    docs = cleaned(spark, sf_dir).select("docname", "cleaned_text")
    return tagger.lemmatize_in_context(docs, DOC, _tagger(spark, sf_dir)).select("docname", joined("lemmatized_text"))


def stem_vocabulary(spark, sf_dir):
    # Read for the vocabulary and for the documents.
    docs = materialize(lemmas(spark, sf_dir).select("docname", "lemmatized_text"), "lemmas")
    return normalization.stem_documents(docs).select("docname", joined("stemmed_text"))


# --- vectors ----------------------------------------------------------------------------------------

def words_in_model(spark, sf_dir):
    words = bound_word_vectors(spark, sf_dir)
    kept = vectors.words_in_model(normalized(spark, sf_dir), words, DOC)
    return kept.select("docname", F.coalesce(F.size("normalized_text"), F.lit(0)).cast("bigint").alias("known_words"))


def document_to_vector(spark, sf_dir):
    made = vectors.document_to_vector(normalized(spark, sf_dir), bound_word_vectors(spark, sf_dir), DOC)
    return made.select("docname", F.posexplode("document_embeddings").alias("dim", "v")).select(
        "docname", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))


def drop_unembeddable(spark, sf_dir):
    docs = normalized(spark, sf_dir)
    made = vectors.document_to_vector(docs, bound_word_vectors(spark, sf_dir), DOC)
    return vectors.embeddable_counts(docs, made, DOC)


def vector_to_matrix(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    made = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    rows = vectors.to_features(made, "v").withColumn("a", vector_to_array("features"))
    return rows.select("vec_id", F.size("a").cast("bigint").alias("dims"),
                       F.round(F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x), 6).alias("total"))


# --- classification ---------------------------------------------------------------------------------

def encode_classes(spark, sf_dir):
    return classification.encode_classes(raw_documents(spark, sf_dir).drop("text")).select(
        "docname", "context", F.col("context_categorical").cast("bigint").alias("context_categorical"))


def holdout_split(spark, sf_dir):
    return classification.holdout_split(raw_documents(spark, sf_dir).select("docname"), DOC)


def _run(spark, sf_dir, method="softmax", path=None):
    return pipelines.train_document_classifier(labelled(spark, sf_dir), DOC, "label", method, path)


def train_classifier(spark, sf_dir):
    return _run(spark, sf_dir).report


def train_classifier_trees(spark, sf_dir):
    return _run(spark, sf_dir, "trees").report


def train_classifier_boosted(spark, sf_dir):
    return _run(spark, sf_dir, "boosted").report


def training_curve_boosted(spark, sf_dir):
    """Log-loss of the joint model on training and test rows after each round."""
    run = _run(spark, sf_dir, "boosted")
    return classification.training_curve(run.model, run.train, run.test, "label").drop("class_")


def _calibrated(spark, sf_dir):
    """A joint model, its lines fitted to half of the rows that it has not seen, and the other half."""
    run = _run(spark, sf_dir, "boosted")
    held = classification.content_split(run.test, "document_embeddings", 0.5, seed=SEED + 1)
    fit, rest = (held.filter(c).drop("is_test") for c in (~F.col("is_test"), F.col("is_test")))
    return run, calibration.calibrate(run.model, fit, "label"), rest


def predict_class_calibrated(spark, sf_dir):
    run, model, _ = _calibrated(spark, sf_dir)
    return calibration.predict_calibrated(run.train.unionByName(run.test), model, ["docname", "label"])


def calibration_reliability(spark, sf_dir):
    _, model, rest = _calibrated(spark, sf_dir)
    return calibration.reliability(rest, model, "label")


def isotonic_calibration(spark, sf_dir):
    """Quality against a score that grows with the length of a document, calibrated bin by bin."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("score"))
    both = table(spark, sf_dir, "labels").join(docs, "doc_id")
    counts = calibration.score_counts(both, [], "score", F.col("quality") == 1, 64)
    return calibration.isotonic(materialize(counts, "score-counts")).select(
        F.col("bin").cast("bigint").alias("bin"), "n", "positives", F.round("rate", 6).alias("rate"))


def training_curve(spark, sf_dir):
    run = _run(spark, sf_dir, "trees")
    return classification.training_curve(run.model, run.train, run.test, "label")


def predict_class(spark, sf_dir):
    run = _run(spark, sf_dir)
    return classification.predict_class(run.test, run.model, ["docname", "label"])


def classification_report_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    both = table(spark, sf_dir, "labels").join(docs, "doc_id")
    guessed = both.select(F.col("quality").alias("label"), (F.col("n_chars") > 1000).cast("int").alias("predicted"))
    return rounded_report(classification_report(guessed))


def classification_report_language(spark, sf_dir):
    docs = cleaned(spark, sf_dir)
    found = language.detect_language(docs, language.fit_language_profiles(docs), ["docname", "language"])
    return rounded_report(classification_report(found, "language", "detected_language"))


def rounded_report(report: DataFrame) -> DataFrame:
    metrics = [F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")]
    return report.select("label", *metrics, "support")


def evaluate_saved(spark, sf_dir):
    path = new_path(spark, "classifier")
    _run(spark, sf_dir, path=path)
    return pipelines.evaluate_saved(spark, path, "label")


def _scorer(spark, sf_dir):
    words = bound_word_vectors(spark, sf_dir)
    profiles = hashed_language.fit_hashed_profiles(cleaned(spark, sf_dir))
    model = classification.train_classifier(labelled(spark, sf_dir, words), "label")
    return lambda docs: pipelines.score_documents(docs, DOC, profiles, words, model)


def score_documents(spark, sf_dir):
    return _scorer(spark, sf_dir)(corpus(spark, sf_dir))


def arriving_documents(spark, sf_dir) -> DataFrame:
    """The corpus as a file stream."""
    schema = table(spark, sf_dir, "documents").schema
    # A pattern, since a stream takes no single file: the table is a file of that name or a folder of files.
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    return corpus_source.corpus_from_table(source, "source", "lang", "doc_id", "text")


def score_documents_stream(spark, sf_dir):
    """The documents as a file stream, scored batch by batch."""
    out = new_path(spark, "scored")
    score_stream(arriving_documents(spark, sf_dir), _scorer(spark, sf_dir), out, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# --- topics -----------------------------------------------------------------------------------------

def kmeans_topics(spark, sf_dir):
    words = bound_word_vectors(spark, sf_dir)
    return pipelines.kmeans_topics(labelled(spark, sf_dir, words), words, k=6).words


def kmeans_assignments(spark, sf_dir):
    data = labelled(spark, sf_dir)
    return topics.assign_topics(data, topics.train_kmeans(data, 6), DOC)


def label_centers(spark, sf_dir) -> dict[int, list[float]]:
    """One center per label of ``embeddings``: the mean vector. At most k centers reach the driver."""
    per_dim = (table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
               .groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x")))
    rows = per_dim.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("c")).select(
        "label", F.col("c.x").alias("c")).collect()
    return {r["label"]: r["c"] for r in rows}


def nearest_words(spark, sf_dir):
    found = topics.nearest_words(bound_word_vectors(spark, sf_dir), label_centers(spark, sf_dir))
    return found.select(F.col("topic").cast("bigint").alias("topic"), F.col("rank").cast("bigint").alias("rank"),
                        "word", "similarity")


def build_dictionary(spark, sf_dir):
    return topics.build_dictionary(lemmas(spark, sf_dir))


def filter_extremes(spark, sf_dir):
    docs = normalization.nonempty_lemmas(lemmas(spark, sf_dir))
    n = docs.count()
    freq = profiling.word_frequencies(docs.withColumn("d", F.array_distinct("lemmatized_text")), "d")
    kept = topics.filter_extremes(freq.withColumnRenamed("n", "doc_freq"), n)
    return kept.select(F.col("word").alias("token"), "doc_freq")


def bag_of_words(spark, sf_dir):
    return topics.bag_of_words(lemmas(spark, sf_dir), DOC)


def corpus_stats(spark, sf_dir):
    return topics.corpus_stats(normalization.nonempty_lemmas(lemmas(spark, sf_dir)))


def _topic_documents(spark, sf_dir) -> DataFrame:
    """The lemmas that topics are trained on, written once: they are read again for words, passes and shares."""
    return materialize(normalization.nonempty_lemmas(lemmas(spark, sf_dir)).select("docname", "lemmatized_text"), "lemmas")


def _lda(spark, sf_dir):
    prepared = _topic_documents(spark, sf_dir)
    return prepared, *pipelines.lda_topics(prepared, k=6)


def lda_topics(spark, sf_dir):
    prepared, trained, _ = _lda(spark, sf_dir)
    return pipelines.lda_shares(prepared, trained, DOC).select(
        "docname", F.array_position("shares", F.array_max("shares")).cast("int").alias("topic"), F.array_max("shares").alias("share"))


def _word_topics(spark, sf_dir):
    prepared = _topic_documents(spark, sf_dir)
    return prepared, word_topics.train_word_topics(prepared, k=6, passes=10)


def lda_topic_tables(spark, sf_dir):
    """The likeliest topic of each document, from weights that are never on the driver."""
    prepared, model = _word_topics(spark, sf_dir)
    shares = word_topics.topic_shares(prepared, model, DOC)
    return shares.select("docname", (F.array_position("shares", F.array_max("shares")) - 1).cast("int").alias("topic"),
                         F.array_max("shares").alias("share"))


def describe_topic_tables(spark, sf_dir):
    return topics.topic_word_weights(word_topics.topic_weights(_word_topics(spark, sf_dir)[1]))


def describe_topics(spark, sf_dir):
    return _lda(spark, sf_dir)[2]


def language_word_weights(spark, sf_dir) -> DataFrame:
    """Each language as a topic; a word weighs the number of its documents that hold it."""
    docs = normalized(spark, sf_dir).withColumnRenamed("language", "topic")
    words = explode_tokens(docs, ["topic"], "normalized_text", "word")
    return words.groupBy("topic", "word").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def topic_word_weights(spark, sf_dir):
    found = topics.topic_word_weights(language_word_weights(spark, sf_dir))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def topic_term_relevance(spark, sf_dir):
    weights = materialize(language_word_weights(spark, sf_dir), "word-weights")
    frequencies = weights.groupBy("word").agg(F.sum("weight").cast("bigint").alias("n"))
    found = topics.topic_term_relevance(weights, frequencies)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def topic_distances(spark, sf_dir):
    """How far the words of each two languages lie from each other."""
    weights = materialize(language_word_weights(spark, sf_dir), "word-weights")
    return topic_layout.topic_distances(weights).withColumn("divergence", F.round("divergence", 6))


def topic_map(spark, sf_dir):
    """Share and place of the trained topics."""
    weights = materialize(word_topics.topic_weights(_word_topics(spark, sf_dir)[1]), "topic-weights")
    found = topic_layout.topic_layout(weights)
    return found.select("topic", F.round("share", 6).alias("share"),
                        *[F.round(F.col("coordinates")[i], 6).alias(c) for i, c in enumerate("xy")])


# --- profiling --------------------------------------------------------------------------------------

def count_documents(spark, sf_dir):
    return profiling.count_documents(raw_documents(spark, sf_dir))


def docs_by_language(spark, sf_dir):
    return profiling.value_counts(raw_documents(spark, sf_dir), "language")


def docs_by_context(spark, sf_dir):
    return profiling.value_counts(raw_documents(spark, sf_dir), "context")


def docs_by_docname(spark, sf_dir):
    return profiling.value_counts(raw_documents(spark, sf_dir), "docname")


def missing_translation_counts(spark, sf_dir):
    found = translations.translation_lookup(raw_documents(spark, sf_dir).drop("text"), store(spark, sf_dir))
    return profiling.missing_translation_counts(found)


def word_frequencies(spark, sf_dir):
    return profiling.word_frequencies(normalization.nonempty_normalized(normalized(spark, sf_dir)))


def word_frequencies_top(spark, sf_dir):
    return profiling.word_frequencies_top(normalization.nonempty_normalized(normalized(spark, sf_dir)), 200)


QUERIES = {
    "corpus_scan": corpus_scan,
    "word_vectors_scan": word_vectors_scan,
    "translation_store_write": translation_store_write,
    "translation_lookup": translation_lookup,
    "translated_only": translated_only,
    "model_save_load": model_save_load,
    "model_store": model_store,
    "sample_n": sample_n,
    "peek": peek,
    "peek_row": peek_row,
    "clean_pixels": clean_pixels,
    "clean_box_assign": clean_box_assign,
    "remove_long_words": remove_long_words,
    "remove_urls": remove_urls,
    "clean_text": clean_text,
    "strip_wiki_trailers": strip_wiki_trailers,
    "nonempty_cleaned": nonempty_cleaned,
    "fit_language_profiles": fit_language_profiles,
    "detect_language": detect_language,
    "fit_hashed_profiles": fit_hashed_profiles,
    "detect_language_hashed": detect_language_hashed,
    "language_accuracy_by_length": language_accuracy_by_length,
    "safe_detect": safe_detect,
    "language_mismatch_counts": language_mismatch_counts,
    "supported_languages": supported_language_counts,
    "route_translation": route_translation,
    "english_target_prefix": english_target_prefix,
    "translation_batches": translation_batches,
    "translate_batch": lexicon_translate,
    "translate_phrases": translate_phrases,
    "translate_with_model": translate_with_model,
    "translate_corpus": translate_corpus,
    "translate_detected": translate_detected,
    "tokenize": tokenize,
    "lowercase_tokens": lowercase_tokens,
    "dedupe_tokens": dedupe_tokens,
    "remove_stopwords": remove_stopwords,
    "keep_in_vocabulary": keep_in_vocabulary,
    "normalize_document": normalize_document,
    "nonempty_normalized": nonempty_normalized,
    "lemmatize_pos_filter": lemmatize_pos_filter,
    "nonempty_lemmas": nonempty_lemmas,
    "tagger_counts": tagger_counts,
    "tag_in_context": tag_in_context,
    "lemmatize_in_context": lemmatize_in_context,
    "stem_vocabulary": stem_vocabulary,
    "words_in_model": words_in_model,
    "document_to_vector": document_to_vector,
    "drop_unembeddable": drop_unembeddable,
    "vector_to_matrix": vector_to_matrix,
    "encode_classes": encode_classes,
    "holdout_split": holdout_split,
    "train_classifier": train_classifier,
    "train_classifier_trees": train_classifier_trees,
    "train_classifier_boosted": train_classifier_boosted,
    "training_curve": training_curve,
    "training_curve_boosted": training_curve_boosted,
    "predict_class": predict_class,
    "predict_class_calibrated": predict_class_calibrated,
    "calibration_reliability": calibration_reliability,
    "isotonic_calibration": isotonic_calibration,
    "classification_report": classification_report_quality,
    "classification_report_language": classification_report_language,
    "evaluate_saved": evaluate_saved,
    "score_documents": score_documents,
    "score_stream": score_documents_stream,
    "kmeans_topics": kmeans_topics,
    "kmeans_assignments": kmeans_assignments,
    "nearest_words": nearest_words,
    "build_dictionary": build_dictionary,
    "filter_extremes": filter_extremes,
    "bag_of_words": bag_of_words,
    "corpus_stats": corpus_stats,
    "lda_topics": lda_topics,
    "describe_topics": describe_topics,
    "lda_topic_tables": lda_topic_tables,
    "describe_topic_tables": describe_topic_tables,
    "topic_word_weights": topic_word_weights,
    "topic_term_relevance": topic_term_relevance,
    "topic_distances": topic_distances,
    "topic_map": topic_map,
    "count_documents": count_documents,
    "docs_by_language": docs_by_language,
    "docs_by_context": docs_by_context,
    "docs_by_docname": docs_by_docname,
    "missing_translation_counts": missing_translation_counts,
    "word_frequencies": word_frequencies,
    "word_frequencies_top": word_frequencies_top,
}
