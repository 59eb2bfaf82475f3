"""Language identification with hashed n-grams and back-off.

A text is reduced to its letters, lower-cased, with one space between words.
Every three characters are looked up as a trigram; where no profile holds it, the
last two of them; else the last one. Each n-gram has a place in a table of fixed
size, so profiles of any corpus take ``sum(PLACES)`` numbers per language,
and a text is scored where it is: no row per character, no join, no shuffle.

Scores are whole numbers (log-probabilities in millionths, weighted by length of
the n-gram), so they do not depend on the order of their parts, and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.functions.text import letters_only

UNKNOWN = "unknown"
MIN_KNOWN = 0.6  # share of a text's trigrams that its language must have been seen with
SCALE = 1_000_000
MAX_LANGUAGES = 256
CHUNK = 1 << 20  # characters scored at once

# Places (primes) for n-grams of one, two and three characters, the factors that
# spread them, and the weights of their scores.
PLACES = (16381, 65521, 262139)
FACTORS = (73856093, 19349663, 83492791)
WEIGHTS = (0.2, 0.4, 1.0)
BEGINS = (0, PLACES[0], PLACES[0] + PLACES[1])


@dataclass(frozen=True)
class HashedProfiles:
    """``counts[place, language]`` of the n-grams, and their ``scores``; at most sum(PLACES) x MAX_LANGUAGES numbers."""

    languages: list[str]
    counts: np.ndarray
    scores: np.ndarray


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, end to end, and the number of each text; a null is an empty text."""
    if not len(column):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = b"" if data is None else bytes(data[int(offsets[0]):int(offsets[-1])])
    begins = np.frombuffer(raw, dtype=np.uint8) & 0xC0 != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])[offsets - offsets[0]]
    return np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64), np.diff(before)


def _places(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each three characters in turn the places of the last one, the last two and all three."""
    a, b, c = points[:-2], points[1:-1], points[2:]
    three = (a * FACTORS[0] + b * FACTORS[1] + c * FACTORS[2]) % PLACES[2] + BEGINS[2]
    two = (b * FACTORS[1] + c * FACTORS[2]) % PLACES[1] + BEGINS[1]
    return c % PLACES[0], two, three


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, code points, sizes)`` of runs of whole texts of about CHUNK characters."""
    points, sizes = _code_points(column)
    ends = np.cumsum(sizes)
    row = 0
    while row < len(sizes):
        start = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, start + CHUNK, side="right")))
        yield row, points[start:int(ends[stop - 1])], sizes[row:stop]
        row = stop


def _inside(sizes: np.ndarray) -> np.ndarray:
    """Whether the three characters from each place on are in one text."""
    out = np.ones(max(int(sizes.sum()) - 2, 0), dtype=bool)
    ends = np.cumsum(sizes)
    for back in (1, 2):
        at = ends - back
        out[at[(at >= 0) & (at < len(out))]] = False
    return out


def fit_hashed_profiles(df: DataFrame, text: str = "cleaned_text", language: str = "language") -> HashedProfiles:
    """Count the n-grams of each known language, combined per task before the shuffle.

    What reaches the driver is bounded by the table: its used places times the
    languages. A language without any letters has no profile.
    """
    known = df.filter(F.col(language).isNotNull())
    found = known.select(language).distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r[0] for r in found)
    size = sum(PLACES)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0)
            for name in names.unique().to_pylist():
                own = batch.column(1).filter(pa.compute.equal(names, name))
                total = sums.setdefault(name, np.zeros(size, dtype=np.int64))
                for _, points, sizes in _texts(own):
                    keep = _inside(sizes)
                    if len(keep):
                        for place in _places(points):
                            total += np.bincount(place[keep], minlength=size)
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])],
                                             names=["language", "place", "n"])

    pairs = known.select(F.col(language).alias("language"), letters_only(F.col(text)).alias("letters"))
    summed = pairs.mapInArrow(run, "language string, place long, n long").groupBy("language", "place").agg(F.sum("n").alias("n"))
    counts = np.zeros((size, len(languages)), dtype=np.int64)
    code = {name: i for i, name in enumerate(languages)}
    for r in summed.collect():
        counts[r["place"], code[r["language"]]] = r["n"]
    used = counts.sum(axis=0) > 0
    counts = counts[:, used]
    return HashedProfiles([name for name, u in zip(languages, used) if u], counts, _scores(counts))


def _scores(counts: np.ndarray) -> np.ndarray:
    """Weighted log-probabilities, each length of n-gram for itself, as whole numbers."""
    out = np.zeros(counts.shape, dtype=np.int32)
    for begin, places, weight in zip(BEGINS, PLACES, WEIGHTS):
        own = counts[begin:begin + places]
        seen = int((own.sum(axis=1) > 0).sum())
        if seen:
            p = (own + 1) / (own.sum(axis=0) + seen)
            out[begin:begin + places] = np.rint(np.log(p) * SCALE * weight).astype(np.int32)
    return out


def _detected(column: pa.Array, profiles: HashedProfiles, any_: np.ndarray, min_known: float) -> list[str | None]:
    out: list[str | None] = []
    for _, points, sizes in _texts(column):
        inside = _inside(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)[:len(inside)][inside]
        n = np.bincount(row, minlength=len(sizes))
        found: list[str | None] = [None] * len(sizes)
        if len(row):
            one, two, three = (p[inside] for p in _places(points))
            place = np.where(any_[three], three, np.where(any_[two], two, one))
            some = np.flatnonzero(n)
            first = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            sums = np.stack([np.add.reduceat(profiles.scores[place, i].astype(np.int64), first)
                             for i in range(len(profiles.languages))], axis=1)
            best = sums.argmax(axis=1)  # of equal ones the first language
            known = np.add.reduceat((profiles.counts[three, np.repeat(best, n[some])] > 0).astype(np.int64), first)
            for i, b, k in zip(some.tolist(), best.tolist(), known.tolist()):
                found[i] = profiles.languages[b] if k >= min_known * n[i] else UNKNOWN
        out += found
    return out


def detected_language(df: DataFrame, profiles: HashedProfiles, text: Column, min_known: float = MIN_KNOWN) -> Column:
    """The likeliest language of ``text``: null without letters, UNKNOWN where too few of its trigrams are its language's.

    The profiles are broadcast once; their size is bounded by the table.
    """
    if not profiles.languages:
        return F.lit(None).cast("string")
    # Plain data, since workers may lack this package.
    shared = df.sparkSession.sparkContext.broadcast(
        (profiles.languages, profiles.counts, profiles.scores, profiles.counts.sum(axis=1) > 0))

    @F.arrow_udf(returnType="string")
    def detect(letters: pa.Array) -> pa.Array:
        *own, any_ = shared.value
        return pa.array(_detected(letters, HashedProfiles(*own), any_, min_known), pa.string())

    return detect(letters_only(text))


def detect_hashed(df: DataFrame, profiles: HashedProfiles, keys: list[str], text: str = "cleaned_text",
                  out: str = "detected_language", min_known: float = MIN_KNOWN) -> DataFrame:
    """``keys`` plus the detected language of every row."""
    return df.select(*keys, detected_language(df, profiles, F.col(text), min_known).alias(out))


def accuracy_by_length(df: DataFrame, profiles: HashedProfiles, text: str = "cleaned_text",
                       language: str = "language", bounds: tuple[int, ...] = (100, 300, 1000, 3000)) -> DataFrame:
    """``(least, n, correct, unknown)``: how texts of at least so many letters (and spaces) are named."""
    found = df.select(F.col(language).alias("language"), F.length(letters_only(F.col(text))).alias("size"),
                      detected_language(df, profiles, F.col(text)).alias("found"))
    least = F.lit(0)
    for b in bounds:
        least = F.when(F.col("size") >= b, b).otherwise(least)
    return found.groupBy(least.cast("bigint").alias("least")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("found").eqNullSafe(F.col("language")).cast("bigint")).alias("correct"),
        F.sum(F.coalesce((F.col("found") == UNKNOWN).cast("bigint"), F.lit(0))).alias("unknown"))
