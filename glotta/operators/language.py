"""Language identification with character-trigram profiles.

Scores are whole numbers (log-probabilities in millionths), so the sum over a
document does not depend on the order of its parts, and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.functions.text import char_trigrams, letters_only
from glotta.operators.hashed_language import HashedProfiles, _code_points, _inside, _texts, detect_hashed, detected_language
from glotta.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from glotta.scratch import materialize

UNKNOWN = "unknown"
MIN_KNOWN = 0.6  # share of a text's trigrams that its language must have been seen with
SCALE = 1_000_000
MAX_HELD = 2_000_000  # counts of trigrams that a task holds


@dataclass(frozen=True)
class LanguageProfiles:
    """One row per trigram with one integer score column per language.

    ``unseen`` holds, per language, the score of a trigram no profile contains.
    """

    table: DataFrame
    languages: list[str]
    unseen: dict[str, int]
    size: int

    def as_rows(self) -> DataFrame:
        """The profiles as ``(language, gram, score)``."""
        if not self.languages:
            return self.table.sparkSession.createDataFrame([], "language string, gram string, score bigint")
        cells = [F.struct(F.lit(lang).alias("language"), F.col(_column(i)).alias("score"))
                 for i, lang in enumerate(self.languages)]
        return self.table.select("gram", F.explode(F.array(*cells)).alias("c")).select("c.language", "gram", "c.score")


def _column(i: int) -> str:
    return f"s{i}"


def _codes(points: np.ndarray) -> np.ndarray:
    """A number for each three characters in turn, 21 bits a character."""
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def _gram_of(code: Column) -> Column:
    """The three characters of a number of ``_codes``."""
    parts = [F.shiftright(code, n).bitwiseAND(F.lit((1 << 21) - 1)) for n in (42, 21, 0)]
    # A character as UTF-32, since char() knows only the first 256.
    return F.concat(*(F.decode(F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32") for p in parts))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the trigrams of each language in a task, passed on when they are many."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def combined(name):
        codes, n = (np.concatenate(x) for x in zip(*held[name]))
        codes, at = np.unique(codes, return_inverse=True)
        return codes, np.bincount(at, weights=n, minlength=len(codes)).astype(np.int64)

    def passed():
        for name in held:
            codes, n = combined(name)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                                             names=["_l", "code", "n"])

    for batch in batches:
        for name in batch.column(0).unique().to_pylist():
            own = batch.column(1).filter(pc.equal(batch.column(0), name))
            for _, points, sizes in _texts(own):
                codes = _codes(points)[_inside(sizes)]
                if len(codes):
                    found = np.unique(codes, return_counts=True)
                    held.setdefault(name, []).append(found)
                    size += len(found[0])
                if size > MAX_HELD:
                    held = {k: [combined(k)] for k in held}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > MAX_HELD // 2:
                        yield from passed()
                        held, size = {}, 0
    yield from passed()


def fit_language_profiles(df: DataFrame, text: str = "cleaned_text", language: str = "language") -> LanguageProfiles:
    """Add-one smoothed trigram log-probabilities of each known language.

    One pass over the text; trigrams are counted as numbers in Arrow batches and
    combined per task before the shuffle, so what moves is about (tasks x distinct
    trigrams x languages) rows. The count
    table is written once; its totals (one number per language) reach the driver.
    """
    known = df.filter(F.col(language).isNotNull())
    languages = sorted(r[0] for r in known.select(language).distinct().collect())  # one column each in the table
    if not languages:
        return LanguageProfiles(df.sparkSession.createDataFrame([], "gram string"), [], {}, 0)
    texts = known.select(F.col(language).alias("_l"), letters_only(F.col(text)).alias("letters"))
    per_language = [F.sum(F.when(F.col("_l") == lang, F.col("n")).otherwise(0)).alias(_column(i))
                    for i, lang in enumerate(languages)]
    summed = texts.mapInArrow(_count_grams, "_l string, code long, n long").groupBy("code").agg(*per_language)
    gram = _gram_of(F.col("code"))
    counts = materialize(summed.select(gram.alias("gram"), *[_column(i) for i in range(len(languages))]), "language-profiles")
    totals = counts.agg(F.count(F.lit(1)).alias("v"),
                        *[F.coalesce(F.sum(_column(i)), F.lit(0)).alias(_column(i)) for i in range(len(languages))]
                        ).first()
    size = totals["v"]

    def score(n, i):
        logp = F.log((n + F.lit(1)).cast("double") / F.lit(float(totals[_column(i)] + size)))
        return F.round(logp * F.lit(float(SCALE))).cast("bigint")

    table = counts.select("gram", *[score(F.col(_column(i)), i).alias(_column(i)) for i in range(len(languages))])
    unseen = {}
    if size:
        row = df.sparkSession.range(1).select(
            *[score(F.lit(0), i).alias(_column(i)) for i in range(len(languages))]).first()
        unseen = {lang: row[_column(i)] for i, lang in enumerate(languages)}
    return LanguageProfiles(table, languages, unseen, size)


def detect_language(df: DataFrame, profiles: LanguageProfiles | HashedProfiles, keys: list[str], text: str = "cleaned_text",
                    out: str = "detected_language", max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    min_known: float = MIN_KNOWN) -> DataFrame:
    """``keys`` plus the most likely language; NULL where the text has no letters.

    A trigram that no profile holds counts the same for all languages. A text of
    whose trigrams the likeliest language was seen with less than ``min_known``
    is in none of them: ``unknown``.

    Every row of ``df`` is kept. The trigrams of a document stay in the Arrow batch
    that holds it: they meet the broadcast profiles there and are summed there, so
    one small row per document is all that is shuffled. Ties go to the first language
    in alphabetical order. With hashed profiles nothing is shuffled at all.
    """
    if isinstance(profiles, HashedProfiles):
        return detect_hashed(df, profiles, keys, text, out, min_known)
    if not profiles.unseen:
        return df.select(*keys, F.lit(None).cast("string").alias(out))
    if profiles.size <= max_broadcast_rows:
        summed = _sums_in_place(df, profiles, keys, text)
    else:
        summed = _sums_by_join(df, profiles, keys, text)
    scores = profiles.languages
    best = F.greatest(*[F.col(_column(i)) for i in range(len(scores))]) if len(scores) > 1 else F.col(_column(0))
    label = F.coalesce(*[F.when(F.col(_column(i)) == best, F.lit(lang)) for i, lang in enumerate(profiles.languages)])
    known = F.coalesce(*[F.when(F.col(_column(i)) == best, F.col(f"k{i}")) for i in range(len(scores))])
    named = F.when(known >= F.lit(min_known) * F.col("_grams"), label).when(label.isNotNull(), F.lit(UNKNOWN))
    return summed.select(*keys, named.alias(out))


def _sums_by_join(df: DataFrame, profiles: LanguageProfiles, keys: list[str], text: str) -> DataFrame:
    """``keys``, the score of each language, how many trigrams it knows, ``_grams``."""
    grams = df.select(*keys, F.explode_outer(char_trigrams(F.col(text))).alias("gram"))
    joined = lookup_join(grams, profiles.table, "gram", "left", F.struct(*keys), small=False)
    scores = [
        F.sum(F.when(F.col("gram").isNotNull(), F.coalesce(F.col(_column(i)), F.lit(0)))).alias(_column(i))
        for i, lang in enumerate(profiles.languages)
    ]
    seen = [F.sum((F.coalesce(F.col(_column(i)), F.lit(floor)) > floor).cast("bigint")).alias(f"k{i}")
            for i, floor in enumerate(profiles.unseen[lang] for lang in profiles.languages)]
    return joined.groupBy(*keys).agg(*scores, *seen, F.count("gram").alias("_grams"))


def _sums_in_place(df: DataFrame, profiles: LanguageProfiles, keys: list[str], text: str) -> DataFrame:
    """The same with the profiles broadcast: trigrams are looked up as numbers, a text's in one Arrow batch."""
    k = len(profiles.languages)
    found = profiles.table.select("gram", *[_column(i) for i in range(k)]).toArrow()
    points, sizes = _code_points(found.column(0).combine_chunks())
    if (sizes != 3).any():
        raise ValueError("profiles must be of three characters each")
    known = points.reshape(-1, 3)
    codes = (known[:, 0] << 42) | (known[:, 1] << 21) | known[:, 2]
    order = np.argsort(codes)
    scores = np.stack([found.column(i + 1).to_numpy()[order] for i in range(k)])
    floors = np.array([profiles.unseen[lang] for lang in profiles.languages])
    # One place more, for a trigram that no profile holds.
    table = np.concatenate([np.concatenate([scores, scores > floors[:, None]]), np.zeros((2 * k, 1), dtype=np.int64)], axis=1)
    shared = df.sparkSession.sparkContext.broadcast((codes[order], np.ascontiguousarray(table, dtype=np.int64)))

    @F.arrow_udf(returnType="array<bigint>")
    def sums(letters: pa.Array) -> pa.Array:
        codes, table = shared.value
        out = np.zeros((len(letters), len(table) + 1), dtype=np.int64)
        for row, points, sizes in _texts(letters):
            inside = _inside(sizes)
            own = _codes(points)[inside]
            n = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[:len(inside)][inside], minlength=len(sizes))
            some = np.flatnonzero(n)
            if not len(some):
                continue
            at = np.searchsorted(codes, own)
            at[codes[np.minimum(at, len(codes) - 1)] != own] = len(codes)
            first = np.cumsum(n[some]) - n[some]
            for i, values in enumerate(table):
                out[row + some, i] = np.add.reduceat(values[at], first)
            out[row:row + len(sizes), -1] = n
        ends = pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    each = df.select(*keys, sums(letters_only(F.col(text))).alias("_s"))
    # Without any trigram there are no scores.
    own = [F.sum(F.when(F.get("_s", F.lit(2 * k)) > 0, F.get("_s", F.lit(i)))).alias(_column(i)) for i in range(k)]
    seen = [F.sum(F.get("_s", F.lit(k + i))).alias(f"k{i}") for i in range(k)]
    return each.groupBy(*keys).agg(*own, *seen, F.sum(F.get("_s", F.lit(2 * k))).alias("_grams"))


def add_detected_language(df: DataFrame, profiles: LanguageProfiles | HashedProfiles, keys: list[str],
                          text: str = "cleaned_text", out: str = "detected_language") -> DataFrame:
    """``df`` with its detected language; without hashed profiles the labels are joined back on the keys."""
    if isinstance(profiles, HashedProfiles):
        return df.withColumn(out, detected_language(df, profiles, F.col(text)))
    return df.join(detect_language(df, profiles, keys, text, out), keys, "left")


def language_mismatch_counts(df: DataFrame, language: str = "language",
                             detected: str = "detected_language") -> DataFrame:
    """Counts of matching and mismatching rows; a missing detection is a mismatch."""
    mismatch = ~F.col(language).eqNullSafe(F.col(detected))
    return df.groupBy(mismatch.alias("mismatch")).agg(F.count(F.lit(1)).alias("n"))
