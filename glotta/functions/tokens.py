"""Token-array expressions used by normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glotta.functions.literals import literal_array
from glotta.resources import spanish_stopwords

# A token is a run of word characters or one other visible character.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def tokenize(text: Column) -> Column:
    """Words and single punctuation marks, in text order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def lowercase(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def dedupe(tokens: Column) -> Column:
    """The set of tokens, sorted so that the result is deterministic."""
    return F.sort_array(F.array_distinct(tokens))


def remove_stopwords(tokens: Column, stopwords: tuple[str, ...] | None = None) -> Column:
    """Drop stop words whatever their case; order and repeats of the rest stay."""
    words = literal_array(stopwords or spanish_stopwords())
    return F.filter(tokens, lambda t: ~F.array_contains(words, F.lower(t)))


def normalize(text: Column, stopwords: tuple[str, ...] | None = None) -> Column:
    """Lower-cased, distinct, sorted tokens without stop words; NULL for no text.

    Lower-casing the text before splitting it equals lower-casing each token.
    ``array_except`` removes repeats and stop words in one hashed pass.
    """
    words = literal_array(stopwords or spanish_stopwords())
    tokens = F.sort_array(F.array_except(tokenize(F.lower(text)), words))
    return F.when(F.length(text) > 0, tokens)
