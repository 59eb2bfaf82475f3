"""Word class and lemma of a Spanish form by its ending, for forms no lexicon holds."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings in order of precedence; the first that matches decides.
POS_RULES = [
    (r"^[^\p{L}]*$", "PUNCT"),
    (r"\p{N}", "NUM"),
    (r"mente$", "ADV"),
    (r"(ción|sión|ciones|siones|dad|dades|tad|tades|miento|mientos|ismo|ismos|ista|istas|eza|ezas|aje|ajes)$", "NOUN"),
    (r"(ando|iendo|ar|er|ir|aron|ieron|aban|ían)$", "VERB"),
    (r"(os[oa]|iv[oa]|ic[oa]|ad[oa]|id[oa])s?$|(able|ible|al)$|(ables|ibles|ales)$", "ADJ"),
]
DEFAULT_POS = "NOUN"

# A word of these letters alone has none of the endings above unless its last two or three letters are here.
LETTERS = "abcdefghijklmnopqrstuvwxyzáéíóúüñ"
TAILS_2 = ["ar", "er", "ir", "al"]
TAILS_3 = ("nte ión nes dad des tad tos nto smo mos sta tas eza zas aje jes ndo ron ban ían ble les oso osa sos sas ivo iva "
           "vos vas ico ica cos cas ado ada ido ida dos das").split()


def rule_pos(token: Column) -> Column:
    result = F.lit(DEFAULT_POS)
    for pattern, pos in reversed(POS_RULES):
        result = F.when(token.rlike(pattern), pos).otherwise(result)
    # Most words need no regex with many endings; set look-ups of the tail tell which.
    ruled_out = ~F.substring(token, -2, 2).isin(*TAILS_2) & ~F.substring(token, -3, 3).isin(*TAILS_3)
    return F.when(ruled_out & token.rlike(rf"^[{LETTERS}]++\z"), DEFAULT_POS).otherwise(result)


def rule_lemma(token: Column, pos: Column) -> Column:
    """The singular; for adjectives in -a(s) also the masculine."""
    # Only forms in -s have a singular to find, and only adjectives a masculine.
    own = (pos != "ADJ") & F.substring(token, -1, 1).isin(*(c for c in LETTERS if c != "s"))
    return F.when(own, token).otherwise(_rule_lemma(token, pos))


def _rule_lemma(token: Column, pos: Column) -> Column:
    singular = (
        F.when(token.rlike("(c|s)iones$"), F.regexp_replace(token, "iones$", "ión"))
        .when(token.rlike("ces$"), F.regexp_replace(token, "ces$", "z"))
        .when(token.rlike("[bdfgjlmnñrtvxy]es$"), F.regexp_replace(token, "es$", ""))
        .when(token.rlike("[aeioué]s$"), F.regexp_replace(token, "s$", ""))
        .otherwise(token)
    )
    masculine = F.regexp_replace(singular, "a$", "o")
    return F.when((pos == "ADJ") & token.rlike("(os|iv|ic|ad|id)as?$"), masculine).otherwise(singular)


# --- the same rules over an Arrow array of words, for lists that hold each word once -----------------

# Java's $ also stands before a line end that ends the word.
LINE_END = r"(\r\n|[\n\r\x{85}\x{2028}\x{2029}])?\z"


def _holds(words: pa.Array, pattern: str) -> pa.Array:
    ended = pattern.replace("$", LINE_END)
    return pc.fill_null(pc.match_substring_regex(words, ended), False)


def rule_pos_of(words: pa.Array) -> pa.Array:
    """``rule_pos`` of each word."""
    out = pa.repeat(pa.scalar(DEFAULT_POS), len(words))
    for pattern, pos in reversed(POS_RULES):
        out = pc.if_else(_holds(words, pattern), pos, out)
    return out


def rule_lemma_of(words: pa.Array, pos: pa.Array) -> pa.Array:
    """``rule_lemma`` of each word in its class."""
    def replaced(own: pa.Array, ending: str, by: str) -> pa.Array:
        return pc.replace_substring_regex(own, ending + LINE_END, by + r"\1")

    singular = words
    for pattern, ending, by in reversed([("(c|s)iones$", "iones", "ión"), ("ces$", "ces", "z"),
                                         ("[bdfgjlmnñrtvxy]es$", "es", ""), ("[aeioué]s$", "s", "")]):
        singular = pc.if_else(_holds(words, pattern), replaced(words, ending, by), singular)
    feminine = pc.and_(pc.fill_null(pc.equal(pos, "ADJ"), False), _holds(words, "(os|iv|ic|ad|id)as?$"))
    return pc.if_else(feminine, replaced(singular, "a", "o"), singular)
