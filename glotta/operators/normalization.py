"""Token operators: normalise, vocabulary filter, lemmas, stems."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.functions import tokens as fx
from glotta.functions.lexicons import spanish_pos_lexicon
from glotta.functions.literals import literal_array
from glotta.functions.stemming import stem_words
from glotta.functions.tagging import rule_lemma, rule_lemma_of, rule_pos, rule_pos_of
from glotta.operators.arrays import filtered_values, inline_rows, rejoin_tokens, token_values
from glotta.operators.blocks import values_in_blocks
from glotta.operators.joins import MAX_BROADCAST_ROWS, has_at_most, lookup_join
from glotta.operators.once import explode_tokens, filter_computed
from glotta.scratch import materialize

ALLOWED_POS = ("NOUN", "ADJ")


def normalize_documents(df: DataFrame, text: str = "translated_text", out: str = "normalized_text") -> DataFrame:
    """Append lower-cased, distinct, sorted tokens without stop words; NULL for a missing or empty text."""
    return df.withColumn(out, fx.normalize(F.col(text)))


def nonempty_normalized(df: DataFrame, tokens: str = "normalized_text") -> DataFrame:
    """Keep documents that have at least one token."""
    return filter_computed(df, tokens, lambda t: F.size(t) > 0)


def keep_in_vocabulary(df: DataFrame, vocabulary: DataFrame | None, keys: list[str], tokens: str = "normalized_text",
                       max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Keep the tokens whose lower-cased form is in ``vocabulary(word)``, in their order.

    No vocabulary (``None``) means no filter; an empty one filters everything
    out. Documents stay even when no token is left. The other columns of ``df``
    are carried along; keep them narrow.
    """
    if vocabulary is None:
        return df
    rows = inline_rows(vocabulary)
    if rows is not None:
        allowed = literal_array(r["word"] for r in rows)
        return df.withColumn(tokens, F.filter(tokens, lambda t: F.array_contains(allowed, F.lower(t))))

    words = vocabulary.select(F.col("word").alias("_word"), F.lit(True).alias("_known")).filter("word is not null").distinct()
    if has_at_most(words, max_broadcast_rows):
        known = df.withColumn("_known", token_values(F.transform(tokens, F.lower), words))
        return known.withColumn(tokens, F.filter(tokens, lambda t, i: F.get("_known", i))).drop("_known")

    def look_up(exploded: DataFrame) -> DataFrame:
        with_word = exploded.withColumn("_word", F.lower("token"))
        return lookup_join(with_word, words, "_word", "left", F.col("_row"), small=False)

    carried = [c for c in df.columns if c != tokens]
    kept = rejoin_tokens(df, carried, F.col(tokens), look_up, F.when(F.col("_known"), F.col("token")))
    return kept.select(*[F.col("_values").alias(c) if c == tokens else F.col(c) for c in df.columns])


def lemmatize_pos_filter(df: DataFrame, keys: list[str], lexicon: DataFrame | None = None,
                         tokens: str = "normalized_text", out: str = "lemmatized_text",
                         allowed: tuple[str, ...] = ALLOWED_POS,
                         max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace the tokens by the lemmas of those whose class is allowed, in token order.

    The class and lemma come from ``lexicon(form, lemma, pos)``, of a repeated form
    from its least (lemma, pos); a form it does not hold is tagged by its ending.
    """
    lexicon = lexicon if lexicon is not None else spanish_pos_lexicon(df.sparkSession)

    rows = inline_rows(lexicon)
    if rows is not None:
        rows = sorted(rows, key=lambda r: (r["lemma"], r["pos"]), reverse=True)  # the least is written last
        known = {r["form"]: (r["lemma"], r["pos"]) for r in rows if r["form"] is not None}

        def lemmas_of(words: pa.Array) -> tuple[pa.Array, pa.Array]:
            at = pc.index_in(words, value_set=pa.array(list(known), pa.string()))
            own_lemma, own_pos = (pa.array([v[i] for v in known.values()], pa.string()).take(at) for i in (0, 1))
            pos = pc.coalesce(own_pos, rule_pos_of(words))
            return pc.coalesce(own_lemma, rule_lemma_of(words, pos)), pc.is_in(pos, value_set=pa.array(allowed, pa.string()))

        return df.select(*[c for c in df.columns if c != tokens], filtered_values(F.col(tokens), "string", lemmas_of).alias(out))

    def look_up(exploded: DataFrame) -> DataFrame:
        forms = lexicon.groupBy(F.col("form").alias("token")).agg(F.min(F.struct("lemma", "pos")).alias("_f"))
        forms = forms.select("token", F.col("_f.lemma").alias("lemma"), F.col("_f.pos").alias("pos_"))
        return lookup_join(exploded, forms, "token", "left", F.col("_row"), max_broadcast_rows)

    pos = F.coalesce(F.col("pos_"), rule_pos(F.col("token")))
    lemma = F.coalesce(F.col("lemma"), rule_lemma(F.col("token"), pos))
    carried = [c for c in df.columns if c != tokens]
    return rejoin_tokens(df, carried, F.col(tokens), look_up, F.when(pos.isin(*allowed), lemma)).withColumnRenamed(
        "_values", out)


def nonempty_lemmas(df: DataFrame, lemmas: str = "lemmatized_text") -> DataFrame:
    """Keep documents that have at least one lemma."""
    return filter_computed(df, lemmas, lambda t: F.size(t) > 0)


def stem_documents(df: DataFrame, tokens: str = "lemmatized_text", out: str = "stemmed_text",
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace the tokens by their stems, in the same order.

    Each distinct word is stemmed once and the stems are broadcast to the tokens.
    A vocabulary beyond the bound is not: blocks of documents get the stems of
    their words, each once. The other columns of ``df`` are carried along; keep
    them narrow.
    """
    carried = [c for c in df.columns if c != tokens]
    vocabulary = materialize(stem_words(explode_tokens(df, [], tokens).distinct(), "token"), "stems").select("token", "stem")
    if has_at_most(vocabulary, max_broadcast_rows):
        found = df.select(*carried, token_values(F.col(tokens), vocabulary).alias("_values"))
    else:
        found = values_in_blocks(df, carried, tokens, vocabulary)
    return found.select(*carried, F.filter("_values", lambda s: s.isNotNull()).alias(out))
