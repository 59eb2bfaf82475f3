"""Cleaning expressions: Column in, Column out, no Python per row.

Word characters are spelled ``[\\p{L}\\p{N}_]`` because Java's ``\\w`` is ASCII
by default. White space and word boundaries use ``(?U:...)`` so that a
non-breaking space or an accented letter counts as it does in Unicode regexes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
SPACE = r"(?U:\s)"

# What the cleaning rules remove.
# A look-behind pins the run-based rules to the start of a run. Matches are the
# same as without it, but a run of n characters costs n steps instead of n^2.
PIXELS = r"(?<![0-9])[0-9]++px\|?"
BOX_ASSIGN = rf"(?<!{WORD}){WORD}++{SPACE}?={SPACE}?{WORD}*|\|"
LONG_WORD = rf"(?<!{WORD}){WORD}{{40,}}"
URL = (r"https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}(?U:\b)"
       r"([-a-zA-Z0-9()@:%_+.~#?&/=]*)")
WIKI_CATEGORY = r"(?m)(Categoría|Catégorie|Category):.+$"
WIKI_INTERLANGUAGE = r"(?m)\*\s[a-z]+:.*$"


def _drop(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def strip_ends(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(text, F.lit(r"(?U)^\s+|\s+\z"), F.lit(""))


def clean_pixels(text: Column) -> Column:
    """Drop pixel sizes such as ``200px`` and one pipe right after them."""
    return _drop(text, PIXELS)


def clean_box_assign(text: Column) -> Column:
    """Drop ``key = value`` fragments of info boxes and every pipe."""
    return _drop(text, BOX_ASSIGN)


def remove_long_words(text: Column) -> Column:
    """Drop runs of 40 or more word characters."""
    return _drop(text, LONG_WORD)


def remove_urls(text: Column) -> Column:
    """Drop http and https addresses."""
    return _drop(text, URL)


def clean(text: Column) -> Column:
    """Pixels, box assignments, long words, URLs - in this order."""
    return remove_urls(remove_long_words(clean_box_assign(clean_pixels(text))))


def strip_wiki_trailers(text: Column) -> Column:
    """Cut category tails and interlanguage lines, on every line of the text."""
    return _drop(_drop(text, WIKI_CATEGORY), WIKI_INTERLANGUAGE)


def letters_only(text: Column) -> Column:
    """The lower-cased letters, with one space for each run of other characters and at both ends."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), F.lit(r"[^\p{L}]+"), F.lit(" "))


def char_trigrams(text: Column) -> Column:
    """Overlapping three-character windows over the letters of the whole text.

    The text is lower-cased and each run of other characters becomes one space;
    a space is added at both ends, so word starts and ends are visible. A text
    without letters gives an empty array. The look-ahead makes this one linear
    scan; ``substring`` per position would be quadratic in the text length.
    """
    return F.regexp_extract_all(letters_only(text), F.lit(r"(?=([\p{L} ]{3}))"), F.lit(1))
