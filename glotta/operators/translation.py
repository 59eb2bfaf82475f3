"""Translation into Spanish: routing, batching, lexicon and model translators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glotta import SEED
from glotta.functions.lexicons import (ENGLISH, ENGLISH_TARGET_PREFIX, TARGET_LANGUAGE, supported_languages,
                                       translation_lexicon)
from glotta.functions.literals import literal_map
from glotta.functions.text import WORD
from glotta.operators.arrays import inline_rows, rejoin_tokens
from glotta.operators.cleaning import nonempty_cleaned
from glotta.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from glotta.operators.ranking import hash_rank
from glotta.scratch import materialize

BATCH_SIZE = 15
CORPUS_LANGUAGES = ("fr", "en", "es")
PIECES = f"{WORD}+|[^{WORD[1:-1]}]+"


def route_translation(df: DataFrame, language: str = "language", languages: DataFrame | None = None) -> DataFrame:
    """Append ``model_name`` and ``route``: identity, english, generic or unsupported.

    An unknown or missing language is ``unsupported``: the row stays and can be
    counted. The built-in language table has 99 rows and is broadcast; for another
    table Spark decides by its size.
    """
    table = languages if languages is not None else F.broadcast(supported_languages(df.sparkSession))
    lookup = table.select(F.col("lang").alias("_lang"), "model_name")
    route = (F.when(F.col(language) == TARGET_LANGUAGE, "identity")
             .when(F.col(language) == ENGLISH, "english")
             .when(F.col("model_name").isNotNull(), "generic")
             .otherwise("unsupported"))
    joined = df.join(lookup, F.col(language) == F.col("_lang"), "left").drop("_lang")
    return joined.withColumn("route", route)


def english_target_prefix(df: DataFrame, text: str = "cleaned_text", out: str = "model_input") -> DataFrame:
    """Append the model input: English text names its target language in front."""
    prefixed = F.when(F.col("route") == "english", F.concat(F.lit(ENGLISH_TARGET_PREFIX), F.col(text)))
    return df.withColumn(out, prefixed.otherwise(F.col(text)))


def translation_batches(df: DataFrame, keys: list[str], language: str = "language", text: str = "cleaned_text",
                        batch_size: int = BATCH_SIZE, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Number the non-empty documents of each language and cut them into batches.

    Returns ``keys, language, batch, batch_rows, is_short``. ``offset`` and
    ``limit`` bound the document numbers of each language exactly, so a run can
    be resumed. The order is that of a hash of the key: fixed for a given corpus,
    and rankable without putting a whole language into one task. The keys of the
    non-empty documents are written once, so the text is read and cleaned once.
    """
    rows = materialize(nonempty_cleaned(df, text).select(*keys, language), "translation-rows")
    ranked = hash_rank(rows, keys, SEED, within=[language], out="_rank").withColumn("_rank", F.col("_rank") - 1)
    ranked = ranked.filter(F.col("_rank") >= offset)
    if limit is not None:
        ranked = ranked.filter(F.col("_rank") < limit)
    batched = ranked.withColumn("batch", F.floor((F.col("_rank") - offset) / batch_size)).drop("_rank")
    # The size of a batch follows from the number of documents of its language: one small row each.
    totals = rows.groupBy(F.col(language).alias("_language")).agg(F.count(F.lit(1)).alias("_n"))
    taken = F.col("_n") - offset if limit is None else F.least(F.col("_n"), F.lit(limit)) - offset
    size = F.least(F.lit(batch_size).cast("bigint"), taken - F.col("batch") * batch_size)
    return batched.join(totals, F.col(language).eqNullSafe(F.col("_language"))).select(
        *keys, language, "batch", size.alias("batch_rows"), (size < batch_size).alias("is_short"))


def _with_pieces(text: str) -> Column:
    """The text cut into words and the stretches between them; joined, they are the text again."""
    return F.regexp_extract_all(F.col(text), F.lit(PIECES), F.lit(0))


def _replacer(words: Column) -> Callable[[Column], Column]:
    return lambda piece: F.coalesce(F.element_at(words, F.lower(piece)), piece)


def lexicon_translate(df: DataFrame, keys: list[str], lexicon: DataFrame | None = None, text: str = "cleaned_text",
                      language: str = "language", out: str = "translated_text",
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace ``text`` by ``out``: every word found in the lexicon of its language is replaced.

    Look-up ignores case; other words and everything between words stay as they
    are. ``lexicon`` is ``(lang, token, es_token)``; of a repeated ``(lang, token)`` the
    least translation counts.
    The other columns of ``df`` stay; keep them narrow, they travel with each word
    when the lexicon is too large to be written into the plan.
    """
    lexicon = lexicon if lexicon is not None else translation_lexicon(df.sparkSession)
    rows = inline_rows(lexicon)
    if rows is not None:
        by_language: dict[str, dict[str, str]] = {}
        for row in sorted(rows, key=lambda r: r["es_token"], reverse=True):  # the least is written last
            by_language.setdefault(row["lang"], {})[row["token"]] = row["es_token"]
        translated = F.col(text)
        for lang, words in by_language.items():
            replaced = F.transform(_with_pieces(text), _replacer(literal_map(words)))
            translated = F.when(F.col(language) == lang, F.array_join(replaced, "")).otherwise(translated)
        return df.select(*[c for c in df.columns if c != text], translated.alias(out))

    words = lexicon.groupBy(F.col("lang").alias("_lang"), F.col("token").alias("_word")).agg(
        F.min("es_token").alias("es_token"))

    def look_up(exploded: DataFrame) -> DataFrame:
        with_word = exploded.withColumn("_word", F.lower("token")).withColumn("_lang", F.col("_carried")[language])
        return lookup_join(with_word, words, ["_lang", "_word"], "left", F.col("_row"), max_broadcast_rows)

    carried = [c for c in df.columns if c != text]
    pieces = rejoin_tokens(df, carried, _with_pieces(text), look_up, F.coalesce(F.col("es_token"), F.col("token")))
    return pieces.select(*carried, F.array_join("_values", "").alias(out))


def translate(df: DataFrame, keys: list[str], language: str, lexicon: DataFrame | None = None,
              text: str = "cleaned_text", out: str = "translated_text") -> DataFrame:
    """Route by ``language`` and replace ``text`` by its translation ``out``.

    Spanish stays whole and unsupported languages become NULL.
    """
    routed = route_translation(df, language).drop("model_name")
    lexicon = (lexicon if lexicon is not None else translation_lexicon(df.sparkSession)).filter(
        F.col("lang") != TARGET_LANGUAGE)
    translated = lexicon_translate(routed, keys, lexicon, text, language, out)
    return translated.withColumn(out, F.when(F.col("route") != "unsupported", F.col(out)))


def translate_corpus(df: DataFrame, keys: list[str], lexicon: DataFrame | None = None,
                     text: str = "cleaned_text", language: str = "language") -> DataFrame:
    """Translate the non-empty French, English and Spanish documents by their known language."""
    chosen = nonempty_cleaned(df.filter(F.col(language).isin(*CORPUS_LANGUAGES)), text)
    return translate(chosen, keys, language, lexicon, text).drop("route")


def translate_detected(df: DataFrame, keys: list[str], lexicon: DataFrame | None = None,
                       text: str = "cleaned_text") -> DataFrame:
    """Translate every document by its detected language."""
    return translate(df, keys, "detected_language", lexicon, text)


def translate_with_model(df: DataFrame, make_predict_fn: Callable, language: str = "language",
                         text: str = "cleaned_text", out: str = "translated_text",
                         batch_size: int = BATCH_SIZE) -> DataFrame:
    """Translate with a user's batch model instead of a lexicon.

    ``make_predict_fn()`` loads the model and returns ``fn(model_names, texts) ->
    translations`` over numpy arrays. It runs once per Python worker, so a model
    is loaded once and kept. Rows are ordered by model inside each partition, so
    a batch rarely mixes languages. Only routed rows are sent to Python.
    """
    model = predict_batch_udf(make_predict_fn, return_type=StringType(), batch_size=batch_size)
    prepared = english_target_prefix(route_translation(df, language), text, "_input")
    needs_model = F.col("route").isin("english", "generic") & (F.length("_input") > 0)
    sent = (prepared.filter(needs_model).sortWithinPartitions("model_name")
            .withColumn(out, model(F.col("model_name"), F.col("_input"))))
    kept = prepared.filter(~F.coalesce(needs_model, F.lit(False))).withColumn(
        out, F.when(F.col("route") != "unsupported", F.col(text)))
    return sent.unionByName(kept).drop("_input", "model_name")
