"""Corpus profiling: counts and word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.operators.once import explode_tokens


def count_documents(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(column, n)``, largest first, ties by value; missing values are not counted."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), column))


def missing_translation_counts(df: DataFrame, translated: str = "translated_text") -> DataFrame:
    return df.groupBy(F.col(translated).isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


def word_frequencies(df: DataFrame, tokens: str = "normalized_text") -> DataFrame:
    """``(word, n)`` over all documents. Normalised tokens are distinct, so ``n`` counts documents."""
    words = explode_tokens(df, [], tokens, "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_frequencies_top(df: DataFrame, n: int, tokens: str = "normalized_text") -> DataFrame:
    return word_frequencies(df, tokens).orderBy(F.desc("n"), "word").limit(n)
