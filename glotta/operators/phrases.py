"""Translation by a lexicon of words and phrases, longest match first.

From left to right, the longest entry of the language that begins at a word
replaces its words; a word that begins none stays. The words of a phrase may
have any white space between them in the text, and nothing else. Look-up ignores case.

A lexicon within the bound becomes a trie per language, broadcast once, and texts
are translated where they are. A larger one is joined to the stretches of words
that begin at each place, and only the places where entries match come together
again by document. Both give the same texts.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.functions.text import WORD
from glotta.operators.joins import has_at_most, lookup_join

MAX_TRIE_ROWS = 200_000
PIECE = f"{WORD}+|[^{WORD[1:-1]}]+"


def entries_of(lexicon: DataFrame) -> DataFrame:
    """``lang, phrase, n, es``: entries as lower-cased words with single spaces; of equal ones the least translation."""
    words = F.regexp_extract_all(F.lower("token"), F.lit(f"({WORD}+)"), F.lit(1))
    listed = lexicon.select("lang", words.alias("_w"), F.col("es_token").alias("es")).filter(F.size("_w") > 0)
    keyed = listed.select("lang", F.array_join("_w", " ").alias("phrase"), F.size("_w").alias("n"), "es")
    return keyed.groupBy("lang", "phrase", "n").agg(F.min("es").alias("es")).filter(F.col("es").isNotNull())


def _pieces(text: Column) -> Column:
    """Words and the stretches between them, in turn; joined, they are the text again."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def trie_of(rows: list[tuple[str, str, str]]) -> tuple[list[str], dict]:
    """``(words, {language: node})``; a node is ``[children by the number of the word, translation or None]``."""
    numbers: dict = {}
    out: dict = {}
    for lang, phrase, es in rows:
        node = out.setdefault(lang, [{}, None])
        for word in phrase.split(" "):
            node = node[0].setdefault(numbers.setdefault(word, len(numbers)), [{}, None])
        node[1] = es
    return list(numbers), out


def longest_match(root: list, words: np.ndarray, pieces: pa.Array, at: int, end: int) -> tuple[int, str] | None:
    """``(one past its last piece, translation)`` of the longest entry that begins at a piece; ``words`` numbers pieces."""
    node, best = root[0].get(int(words[at])), None
    while node is not None:
        if node[1] is not None:
            best = at + 1, node[1]
        if at + 2 >= end or not pieces[at + 1].as_py().isspace():
            break
        at += 2
        node = node[0].get(int(words[at]))
    return best


def translate_phrases(df: DataFrame, lexicon: DataFrame, text: str = "cleaned_text", language: str = "language",
                      out: str = "translated_text", max_trie_rows: int = MAX_TRIE_ROWS) -> DataFrame:
    """Replace ``text`` by ``out``; ``lexicon`` is (lang, token, es_token) with tokens of one or more words.

    A text in a language without entries stays as it is, a null text is null, and every row is kept.
    """
    entries = entries_of(lexicon)
    if has_at_most(entries, max_trie_rows):
        return _by_trie(df, entries, text, language, out)
    return _by_join(df, entries, text, language, out)


def _by_trie(df: DataFrame, entries: DataFrame, text: str, language: str, out: str) -> DataFrame:
    """Only texts of languages with entries are cut into pieces, and only pieces that begin an entry are looked at one by one."""
    rows = [tuple(r) for r in entries.select("lang", "phrase", "es").collect()]  # bounded by the caller
    listed, tries = trie_of(rows)
    shared = df.sparkSession.sparkContext.broadcast((listed, tries))

    @F.arrow_udf(returnType="string")
    def translate(pieces: pa.Array, lowered: pa.Array, languages: pa.Array) -> pa.Array:
        listed, tries = shared.value
        own, low, langs = pieces.flatten(), lowered.flatten(), languages.to_pylist()
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pieces.value_lengths(), 0).to_numpy(zero_copy_only=False))])
        words = pc.fill_null(pc.index_in(low, value_set=pa.array(listed, low.type)), -1).to_numpy(zero_copy_only=False)
        begins = np.zeros(len(listed) + 1, dtype=bool)  # the last is for -1, no word of any entry
        begins[[n for root in tries.values() for n in root[0]]] = True
        at = np.flatnonzero(begins[words])
        row = np.searchsorted(ends, at, side="right") - 1
        kept, first, made, done = np.ones(len(own), dtype=bool), np.zeros(len(own), dtype=bool), [], 0
        for i, r in zip(at.tolist(), row.tolist()):
            best = longest_match(tries[langs[r]], words, own, i, int(ends[r + 1])) if i >= done and langs[r] in tries else None
            if best:
                done, es = best
                first[i], kept[i + 1:done] = True, False
                made.append(es)
        replaced = pc.replace_with_mask(own, pa.array(first), pa.array(made, own.type)).filter(pa.array(kept))
        ends = np.concatenate([[0], np.cumsum(kept)])[ends]
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), replaced, mask=pieces.is_null()), "")

    known = F.coalesce(F.col(language).isin([lang for lang in tries if lang is not None]), F.lit(None in tries))
    cut = df.select(*df.columns, known.alias("_known")).withColumn("_pieces", F.when(F.col("_known"), _pieces(F.col(text))))
    made = translate(F.col("_pieces"), F.transform("_pieces", F.lower), F.col(language))
    return cut.select(*[c for c in df.columns if c != text], F.when(F.col("_known"), made).otherwise(F.col(text)).alias(out))


def _by_join(df: DataFrame, entries: DataFrame, text: str, language: str, out: str) -> DataFrame:
    carried = [c for c in df.columns if c != text]
    longest = entries.agg(F.max("n")).first()[0] or 0
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(language).alias("_lang"), _pieces(F.col(text)).alias("_pieces"),
                     F.struct(F.lit(0).alias("_"), *carried).alias("_carried"))
    # A stretch of n words from piece i on has 2n - 1 pieces, every second of them white space.
    at = F.transform("_pieces", lambda p, i: F.struct(i.alias("at"), F.slice("_pieces", i + 1, 2 * longest - 1 if longest else 1).alias("ahead")))
    each = rows.select("_row", "_lang", F.explode(at).alias("_a")).select("_row", "_lang", "_a.at", "_a.ahead")
    each = each.filter(F.get("ahead", F.lit(0)).rlike(WORD))
    stretches = F.transform(F.sequence(F.lit(1), F.lit(max(longest, 1))), lambda n: F.struct(
        n.alias("n"), F.slice("ahead", F.lit(1), 2 * n - 1).alias("own")))
    each = each.select("_row", "_lang", "at", F.explode(stretches).alias("_s")).select("_row", "_lang", "at", "_s.n", "_s.own")
    gaps = F.filter("own", lambda p, i: i % 2 == 1)
    words = F.filter("own", lambda p, i: i % 2 == 0)
    each = each.filter((F.size("own") == 2 * F.col("n") - 1) & F.forall(gaps, lambda g: ~g.rlike(r"[^\p{IsWhite_Space}]")))
    each = each.select("_row", F.col("_lang").alias("lang"), "at", F.lower(F.array_join(words, " ")).alias("phrase"))
    found = lookup_join(each, entries, ["lang", "phrase"], "inner", F.col("_row"))
    matches = found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "es"))).alias("_m"))
    joined = rows.select("_row", "_pieces", "_carried").join(matches, "_row", "left").select("_pieces", "_m", "_carried")

    @F.arrow_udf(returnType="string")
    def replace(pieces: pa.Array, matches: pa.Array) -> pa.Array:
        made = []
        for own, found in zip(pieces, matches):
            if not own.is_valid:
                made.append(None)
                continue
            own, parts, end = own.as_py(), [], 0
            for start, same in groupby(found.as_py() or [], key=lambda m: m["at"]):
                first = next(same)  # the longest
                if start >= end:
                    parts += own[end:start]
                    parts.append(first["es"])
                    end = start - 2 * first["less"] - 1
            made.append("".join(parts + own[end:]))
        return pa.array(made, pa.string())

    return joined.select(*[F.col("_carried")[c].alias(c) for c in carried], replace("_pieces", "_m").alias(out))
