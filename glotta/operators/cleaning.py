"""Text-cleaning operators: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.functions import text as fx
from glotta.operators.once import filter_computed


def clean_text(df: DataFrame, text: str = "text", out: str = "cleaned_text") -> DataFrame:
    """Append the cleaned text: the same as ``functions.text.clean``.

    A rule whose match must hold a certain piece of text is only run on rows
    that hold it. Searching for the piece is a byte scan, several times cheaper
    than the regex, and most texts hold none.
    """
    steps = [(fx.clean_pixels, ["px"]), (fx.clean_box_assign, ["=", "|"]), (fx.remove_long_words, None),
             (fx.remove_urls, ["http"])]
    current = df.withColumn(out, F.col(text))
    for rule, needed in steps:
        column = F.col(out)
        if needed is None:
            current = current.withColumn(out, rule(column))
            continue
        holds = column.contains(needed[0])
        for piece in needed[1:]:
            holds = holds | column.contains(piece)
        current = current.withColumn(out, F.when(holds, rule(column)).otherwise(column))
    return current


def strip_wiki_trailers(df: DataFrame, text: str = "text", out: str = "stripped_text") -> DataFrame:
    """Append the text without category tails and interlanguage lines (off in ``clean_text``)."""
    return df.withColumn(out, fx.strip_wiki_trailers(F.col(text)))


def nonempty_cleaned(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Keep rows whose cleaned text has at least one character."""
    return filter_computed(df, text, lambda t: F.length(t) > 0)
