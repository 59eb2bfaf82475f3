"""The published Snowball stemming rules for Spanish as SQL expressions.

Stemming needs no Python worker. A word travels with the 0-based offsets of its
regions RV, R1 and R2; what one step finds is a column that the next step reads.
The expressions are SQL text because they are large: building them one Column
call at a time costs more than running them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Suffix classes of the published algorithm.
PRONOUNS = "me|se|sela|selo|selas|selos|la|le|lo|las|les|los|nos"
GERUND_OR_INFINITIVE_ACCENTED = "iéndo|ándo|ár|ér|ír"
GERUND_OR_INFINITIVE = "ando|iendo|ar|er|ir"
STANDARD_DELETE = ("anza|anzas|ico|ica|icos|icas|ismo|ismos|able|ables|ible|ibles|ista|istas|oso|osa|osos|osas|"
                   "amiento|amientos|imiento|imientos")
STANDARD_ATION = "adora|ador|ación|adoras|adores|aciones|ante|antes|ancia|ancias"
STANDARD_LOGY = "logía|logías"
STANDARD_UTION = "ución|uciones"
STANDARD_ENCY = "encia|encias"
STANDARD_ADVERB = "mente"
STANDARD_AMENTE = "amente"
STANDARD_ITY = "idad|idades"
STANDARD_IVE = "iva|ivo|ivas|ivos"
Y_VERB = "ya|ye|yan|yen|yeron|yendo|yo|yó|yas|yes|yais|yamos"
VERB_AFTER_GU = "en|es|éis|emos"
VERB = ("arían|arías|arán|arás|aríais|aría|aréis|aríamos|aremos|ará|aré|"
        "erían|erías|erán|erás|eríais|ería|eréis|eríamos|eremos|erá|eré|"
        "irían|irías|irán|irás|iríais|iría|iréis|iríamos|iremos|irá|iré|"
        "aba|ada|ida|ía|ara|iera|ad|ed|id|ase|iese|aste|iste|an|aban|ían|aran|ieran|asen|iesen|aron|ieron|"
        "ado|ido|ando|iendo|ió|ar|er|ir|as|abas|adas|idas|ías|aras|ieras|ases|ieses|ís|áis|abais|íais|arais|"
        "ierais|aseis|ieseis|asteis|isteis|ados|idos|amos|ábamos|íamos|imos|áramos|iéramos|iésemos|ásemos")
RESIDUAL = "os|a|o|á|í|ó"
RESIDUAL_E = "e|é"
VOWEL = "aeiouáéíóúü"


def _in(word: str, endings: list[str]) -> str:
    return f"{word} in ({', '.join(repr(e) for e in endings)})"


def _suffix(word: str, alternatives: str) -> str:
    """The longest of the ``|``-separated endings that ``word`` has, or the empty string.

    One hashed set look-up per ending length, longest first: much cheaper per
    word than a regex that tries a hundred alternatives at every position.
    """
    by_length: dict[int, list[str]] = {}
    for ending in alternatives.split("|"):
        by_length.setdefault(len(ending), []).append(ending)
    tails = [(f"substring({word}, -{n}, {n})", by_length[n]) for n in sorted(by_length, reverse=True)]
    cases = " ".join(f"when {_in(tail, endings)} then {tail}" for tail, endings in tails)
    return f"case {cases} else '' end"


def _cut(word: str, n: str) -> str:
    return f"substring({word}, 1, length({word}) - {n})"


def _without(word: str, more: str) -> str:
    """``word`` without one further ending, if that lies in R2."""
    ending = f"({_suffix(word, more)})"
    inside = f"{ending} <> '' and length({word}) - length({ending}) >= r2"
    return f"case when {inside} then {_cut(word, f'length({ending})')} else {word} end"


def _region_columns() -> dict[str, str]:
    """R1 and R2 start after the first and second vowel + consonant, RV after one of three shapes."""
    v, c = f"[{VOWEL}]", f"[^{VOWEL}]"
    twice = f"^({c}*{v}+{c})({c}*{v}+{c})?"
    return {
        "w": "w",
        "a": f"length(regexp_extract(w, '{twice}', 1))",
        "b": f"length(regexp_extract(w, '{twice}', 0))",
        "v": f"length(regexp_extract(w, '^(?:.{c}+{v}|{v}{v}+{c}|{c}{v}.)', 0))",
    }


def _or_end(found: str) -> str:
    """A region whose shape is not in the word starts at the word's end."""
    return f"if({found}, length(w))"


STANDARD = "|".join([STANDARD_DELETE, STANDARD_ATION, STANDARD_LOGY, STANDARD_UTION, STANDARD_ENCY, STANDARD_AMENTE,
                     STANDARD_ADVERB, STANDARD_ITY, STANDARD_IVE])

# Each step lists its columns; it reads the columns of the step before.
STEPS: list[dict[str, str]] = [
    _region_columns(),
    {"w": "w", "rv": _or_end("v > 0, v"), "r1": _or_end("a > 0, a"), "r2": _or_end("b > a, b"),
     "pronoun": _suffix("w", PRONOUNS)},
    # An attached pronoun goes when it follows a gerund or infinitive in RV.
    {"w": "w", "rv": "rv", "r1": "r1", "r2": "r2", "pronoun": "pronoun", "base": _cut("w", "length(pronoun)")},
    {"w": "w", "rv": "rv", "r1": "r1", "r2": "r2", "pronoun": "pronoun", "base": "base",
     "accented": _suffix("base", GERUND_OR_INFINITIVE_ACCENTED), "plain": _suffix("base", GERUND_OR_INFINITIVE)},
    {"rv": "rv", "r1": "r1", "r2": "r2",
     "w": "case when pronoun = '' then w "
          "when accented <> '' and length(base) - length(accented) >= rv then "
          f"concat({_cut('base', 'length(accented)')}, translate(accented, 'áéí', 'aei')) "
          "when plain <> '' and length(base) - length(plain) >= rv then base "
          "when endswith(base, 'uyendo') and length(base) - 5 >= rv then base else w end"},
    # Derivational endings in R2 (`amente` in R1), then one more ending before some of them.
    {"w": "w", "rv": "rv", "r1": "r1", "r2": "r2", "suffix": _suffix("w", STANDARD)},
    {"w": "w", "rv": "rv", "r1": "r1", "r2": "r2", "suffix": "suffix", "base": _cut("w", "length(suffix)")},
    {"before": "w", "rv": "rv",
     "w": "case when suffix = '' or length(base) < if(suffix = 'amente', r1, r2) then w "
          "when suffix = 'amente' and endswith(base, 'iv') and length(base) - 2 >= r2 "
          f"then {_without(_cut('base', '2'), 'at')} "
          f"when suffix = 'amente' then {_without('base', 'os|ic|ad')} "
          f"when {_in('suffix', STANDARD_ATION.split('|'))} then {_without('base', 'ic')} "
          f"when {_in('suffix', STANDARD_LOGY.split('|'))} then concat(base, 'log') "
          f"when {_in('suffix', STANDARD_UTION.split('|'))} then concat(base, 'u') "
          f"when {_in('suffix', STANDARD_ENCY.split('|'))} then concat(base, 'ente') "
          f"when suffix = 'mente' then {_without('base', 'ante|able|ible')} "
          f"when {_in('suffix', STANDARD_ITY.split('|'))} then {_without('base', 'abil|ic|iv')} "
          f"when {_in('suffix', STANDARD_IVE.split('|'))} then {_without('base', 'at')} else base end"},
    # Verb endings that lie wholly in RV, for words the derivational step left alone.
    {"w": "w", "rv": "rv", "tail": "if(w = before, substring(w, rv + 1), '')"},
    {"w": "w", "rv": "rv", "y": _suffix("tail", Y_VERB), "verb": _suffix("tail", f"{VERB}|{VERB_AFTER_GU}")},
    {"rv": "rv",
     "w": f"case when y <> '' and endswith({_cut('w', 'length(y)')}, 'u') then {_cut('w', 'length(y)')} "
          f"when {_in('verb', VERB_AFTER_GU.split('|'))} and endswith({_cut('w', 'length(verb)')}, 'gu') "
          f"then {_cut('w', 'length(verb) - 1')} else {_cut('w', 'length(verb)')} end"},
    # The residual vowel, and the accents.
    {"w": "w", "rv": "rv", "tail": "substring(w, rv + 1)"},
    {"w": "w", "rv": "rv", "end": _suffix("tail", f"{RESIDUAL}|{RESIDUAL_E}")},
    {"w": f"translate(case when {_in('end', RESIDUAL_E.split('|'))} and endswith({_cut('w', '1')}, 'gu') "
          f"and length(w) - 2 >= rv then {_cut('w', '2')} else {_cut('w', 'length(end)')} end, 'áéíóú', 'aeiou')"},
]


def stem_words(df: DataFrame, word: str, out: str = "stem") -> DataFrame:
    """Append the stem of a word column, one projection per step.

    The columns of ``df`` must not have the names the steps use.
    """
    kept = [f"`{c}`" for c in df.columns]
    current = df.selectExpr(*kept, f"`{word}` as w")
    for step in STEPS:
        current = current.selectExpr(*kept, *[f"{sql} as `{name}`" for name, sql in step.items()])
    return current.withColumnRenamed("w", out)
