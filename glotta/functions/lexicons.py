"""Default lexicons and the table of translatable languages.

Small literal tables for use without any download. Real deployments pass their
own tables of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glotta.functions.literals import literal_table

TARGET_LANGUAGE = "es"
ENGLISH = "en"

# Language codes with a published model into Spanish. English has
# a multi-target model that needs its target named in front of the text.
SUPPORTED_LANGUAGES = """
aed af ase bcl bem ber bg bi bzs ca ceb chk crs csg csn da de ee eo et eu fi fr gaa gil gl guw ha hr ht id ig ilo is
iso it ja kg ko kqn lg ln loz lt lu lua lue lus lv mfe mfs mg mh mk mt niu nl nso ny pag pap pis pl pon prl ru run rw
sg sk sl sm sn sq srn ssp st sv swc tll tn to toi tr ts tum tvl tw ty tzo uk ve vsl war xh yo zai zne
""".split()
MODEL_NAME = "Helsinki-NLP/opus-mt-{}-es"
ENGLISH_MODEL_NAME = "Helsinki-NLP/opus-mt-en-ROMANCE"
ENGLISH_TARGET_PREFIX = ">>es<< "

# Function words and their usual Spanish rendering.
TO_SPANISH = {
    "en": {
        "the": "el", "of": "de", "and": "y", "to": "a", "in": "en", "is": "es", "that": "que", "for": "para",
        "it": "lo", "as": "como", "was": "fue", "with": "con", "be": "ser", "by": "por", "on": "sobre", "not": "no",
        "he": "él", "this": "este", "are": "son", "or": "o", "his": "su", "from": "desde", "at": "en", "which": "cual",
        "but": "pero", "have": "tener", "an": "un", "a": "un", "had": "tuvo", "they": "ellos", "you": "usted",
        "were": "eran", "their": "su", "one": "uno", "all": "todo", "we": "nosotros", "can": "puede", "her": "su",
        "has": "tiene", "there": "allí",
    },
    "fr": {
        "le": "el", "la": "la", "les": "los", "de": "de", "des": "de", "du": "del", "et": "y", "en": "en", "un": "un",
        "une": "una", "que": "que", "qui": "quien", "dans": "en", "est": "es", "pour": "para", "pas": "no",
        "sur": "sobre", "par": "por", "avec": "con", "il": "él", "elle": "ella", "au": "al", "aux": "a", "ce": "este",
        "se": "se", "ne": "no", "plus": "más", "ou": "o", "mais": "pero", "sont": "son", "nous": "nosotros",
        "vous": "vosotros", "je": "yo", "son": "su", "sa": "su", "ses": "sus", "à": "a", "être": "ser",
    },
    "de": {
        "der": "el", "die": "la", "das": "lo", "und": "y", "in": "en", "zu": "a", "den": "el", "von": "de",
        "mit": "con", "ist": "es", "nicht": "no", "ein": "un", "eine": "una", "für": "para", "auf": "sobre",
        "im": "en", "dem": "el", "des": "del", "sich": "se", "als": "como", "auch": "también", "es": "ello",
        "an": "a", "er": "él", "sie": "ella", "dass": "que", "aus": "de", "bei": "con", "wird": "será",
        "sind": "son", "oder": "o", "aber": "pero", "nach": "según", "war": "fue", "wie": "como", "ich": "yo",
    },
}

# Spanish forms whose class or lemma the suffix rules would get wrong.
SPANISH_FORMS = [
    ("día", "día", "NOUN"), ("días", "día", "NOUN"), ("país", "país", "NOUN"), ("países", "país", "NOUN"),
    ("vez", "vez", "NOUN"), ("veces", "vez", "NOUN"), ("mes", "mes", "NOUN"), ("meses", "mes", "NOUN"),
    ("luz", "luz", "NOUN"), ("luces", "luz", "NOUN"), ("mar", "mar", "NOUN"), ("lugar", "lugar", "NOUN"),
    ("mujer", "mujer", "NOUN"), ("mujeres", "mujer", "NOUN"), ("gran", "grande", "ADJ"), ("buen", "bueno", "ADJ"),
    ("es", "ser", "VERB"), ("son", "ser", "VERB"), ("fue", "ser", "VERB"), ("era", "ser", "VERB"),
    ("eran", "ser", "VERB"), ("ser", "ser", "VERB"), ("será", "ser", "VERB"), ("tiene", "tener", "VERB"),
    ("tuvo", "tener", "VERB"), ("puede", "poder", "VERB"), ("usted", "usted", "PRON"), ("cual", "cual", "PRON"),
    ("según", "según", "ADP"), ("allí", "allí", "ADV"), ("más", "más", "ADV"), ("también", "también", "ADV"),
]


def supported_languages(spark: SparkSession) -> DataFrame:
    """``(lang, model_name)``: 99 rows."""
    rows = [(ENGLISH, ENGLISH_MODEL_NAME)] + [(code, MODEL_NAME.format(code)) for code in SUPPORTED_LANGUAGES]
    return literal_table(spark, ["lang", "model_name"], rows)


def translation_lexicon(spark: SparkSession) -> DataFrame:
    """``(lang, token, es_token)``."""
    rows = [(lang, token, es) for lang, words in TO_SPANISH.items() for token, es in words.items()]
    return literal_table(spark, ["lang", "token", "es_token"], rows)


def spanish_pos_lexicon(spark: SparkSession) -> DataFrame:
    """``(form, lemma, pos)``."""
    return literal_table(spark, ["form", "lemma", "pos"], SPANISH_FORMS)
