"""Quality rules as robust multivariate outliers.

Every document gets a vector of transformed statistics. Per language and source
the minimum covariance determinant is estimated: the mean and covariance of the
SUPPORT share of documents with the least determinant. As in the deterministic
variant of the method, concentration steps run from three robust starts (scaled
medians, spatial signs, hyperbolic tangents), each step keeping the documents
nearest by Mahalanobis distance, and the start with the least determinant wins;
no random subsets, so every document counts in every step. The estimate is made
consistent at the median, reweighted, and documents far outside are rejected.

A step is two grouped aggregations (a quantile sketch, then sums and products)
over a table of a few numbers per document; both combine before the shuffle, so
a group that holds a third of all rows is no hot spot. Groups of fewer than
LEAST documents use the estimate of their language, and failing that of all.

In the final distance each statistic also gets a variance FLOOR and the sampling
variance of a text of its length, so that short clean texts and statistics that
hardly vary do not stand out.

Defined results: a null text is empty, a text of fewer than MIN_WORDS words
fails the base rules, null languages and sources are groups of their own,
repeated rows count as often as they come, a document without any estimate is
kept if the base rules keep it, other columns are carried by ``keep_good`` and
not read by ``judge``, an empty table gives no rows.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, materialize, pieces, table
from glotta.llm.words import code_points_before, mix, span_hashes, split

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SUPPORT = 0.75
STEPS = 5
LEAST = 200
TAIL = 1e-9  # chi-square tail beyond which a document is rejected
FEATURES = ["f_length", "f_symbols", "f_repeats", "f_lines", "f_upper", "f_marks", "f_digits"]
FLOOR = np.array([0.05, 0.05, 0.1, 0.1, 0.05, 0.05, 0.05])
NOISE = np.array([0.5, 0.25, 0.5, 0.25, 0.25, 0.25, 0.25])  # variance of a statistic, times the number of words
P = len(FEATURES)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_marks", "n_digits"]

# The symbol characters, the other ASCII marks, upper-case letters and digits, as bytes.
_SYMBOL, _MARK, _UPPER, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK[list(b"!\"'()+,-./:;=?@[\\]^_`{}~")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text."""
    words = split(texts)
    n, buf, base = words.n_docs, words.buf, words.base

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[base[1:]] - total[base[:-1]]

    before = code_points_before(buf)
    out = {"n_words": words.counts(),
           "word_chars": np.bincount(words.doc, before[words.ends] - before[words.starts], n).astype(np.int64),
           "n_symbols": per_text(_SYMBOL[buf]), "n_upper": per_text(_UPPER[buf]), "n_marks": per_text(_MARK[buf]),
           "n_digits": per_text(_DIGIT[buf])}
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(base, starts, side="right") - 1
    key = mix(span_hashes(buf, starts, ends) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(key, return_index=True)[1]
    out["n_lines"] = np.bincount(doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[first], minlength=n)
    h, at = words.shingles(WINDOW)
    key = mix(h + words.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words.doc) + 1, dtype=np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(words.doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    return out


def statistics(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The ``carry`` columns with the counts of each text."""
    chosen = docs.select(*carry, F.col(text_col).alias("__text"))
    schema = chosen.drop("__text").schema
    for name in COUNTS + EXTRA:
        schema = schema.add(name, "long")
    names = schema.names

    def run(batch: pa.RecordBatch):
        for first, texts in pieces(batch, "__text"):
            made = text_counts(texts)
            own = batch.slice(first, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*own.columns[:-1], *[pa.array(made[c].astype(np.int64)) for c in COUNTS + EXTRA]], names=names)

    return map_batches(chosen, run, schema)


def _with_features(df: DataFrame) -> DataFrame:
    def rate(count: str, of: str) -> Column:
        return F.sqrt(F.col(count) / F.greatest(F.col(of), F.lit(1)))

    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    made = [F.log(F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1))), rate("n_symbols", "n_words"),
            rate("n_repeat_words", "n_words"), rate("n_dup_lines", "n_lines"), rate("n_upper", "word_chars"),
            rate("n_marks", "word_chars"), rate("n_digits", "word_chars")]
    return df.select("*", base_failed.alias("base_failed"), *[c.alias(f) for c, f in zip(made, FEATURES)])


def chi_square(share: float, p: int = P) -> float:
    """The quantile of the chi-square distribution, by the cube-root approximation."""
    z = NormalDist().inv_cdf(share)
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _moments(df: DataFrame, values: list[Column], keys: list[str]) -> DataFrame:
    """``n``, sums and sums of products of ``values`` per group."""
    named = df.select(*keys, *[v.alias(f"v{i}") for i, v in enumerate(values)])
    return named.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"v{i}") for i in range(P)]).alias("s"),
        F.array(*[F.sum(F.col(f"v{i}") * F.col(f"v{j}")) for i, j in _PAIRS]).alias("ss"))


def _covariance(n: float, s, ss) -> tuple[np.ndarray, np.ndarray]:
    mean = np.asarray(s) / n
    second = np.zeros((P, P))
    for (i, j), v in zip(_PAIRS, ss):
        second[i, j] = second[j, i] = v / n
    return mean, second - np.outer(mean, mean)


def _row(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], list[float], float]:
    """Mean, covariance, precision (off-diagonal terms doubled) and log determinant, with the least variance added."""
    full = cov + np.diag(FLOOR**2 / 25)
    inverse = np.linalg.inv(full)
    precision = [inverse[i, j] * (1 if i == j else 2) for i, j in _PAIRS]
    return mean.tolist(), cov.ravel().tolist(), precision, float(np.linalg.slogdet(full)[1])


_ESTIMATE = "g string, start int, mean array<double>, cov array<double>, precision array<double>, logdet double"


def _estimates(moments: DataFrame, build) -> DataFrame:
    """One small row per group and start; ``build(row) -> [(start, mean, covariance)]``."""

    def run(batch: pa.RecordBatch):
        out = [(row["g"], start, *_row(mean, cov)) for row in batch.to_pylist() for start, mean, cov in build(row)]
        names = [c.split()[0] for c in _ESTIMATE.split(", ")]
        types = [pa.string(), pa.int32(), *[pa.list_(pa.float64())] * 3, pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return map_batches(moments, run, _ESTIMATE)


def _distance() -> Column:
    gap = [F.col(f) - F.col("mean")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(_PAIRS):
        total = total + gap[i] * gap[j] * F.col("precision")[k]
    return total


def _starts(rows: DataFrame) -> DataFrame:
    """The three robust starts of every group."""
    middle = rows.groupBy("g").agg(*[F.percentile_approx(f, 0.5, 1000).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    off = rows.join(middle, "g")
    spread = off.groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}")
                                    for i, f in enumerate(FEATURES)])
    scales = materialize(middle.join(spread, "g"), "mcd-scales")
    z = [(F.col(f) - F.col(f"m{i}")) / F.greatest(1.4826 * F.col(f"d{i}"), F.lit(float(FLOOR[i] / 5)))
         for i, f in enumerate(FEATURES)]
    scaled = rows.join(scales, "g").select("g", *[c.alias(f"z{i}") for i, c in enumerate(z)])
    norm = F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(P)), F.lit(0.0))), F.lit(1e-9))
    signs = _moments(scaled, [F.col(f"z{i}") / norm for i in range(P)], ["g"])
    tanhs = _moments(scaled, [F.tanh(f"z{i}") for i in range(P)], ["g"])
    both = signs.withColumnsRenamed({"s": "s_sign", "ss": "ss_sign"}).join(tanhs.drop("n"), "g").join(scales, "g")

    def build(row):
        centre = np.array([row[f"m{i}"] for i in range(P)])
        scale = np.maximum(1.4826 * np.array([row[f"d{i}"] for i in range(P)]), FLOOR / 5)
        yield 0, centre, np.diag(scale**2)
        for start, name in ((1, "_sign"), (2, "")):
            _, cov = _covariance(row["n"], row[f"s{name}"], row[f"ss{name}"])
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
            correlation = cov / np.outer(sd, sd) * 0.99 + 0.01 * np.eye(P)
            yield start, centre, correlation * np.outer(scale, scale)

    return _estimates(both, build)


def _plain(row):
    yield row.get("start", 0), *_covariance(row["n"], row["s"], row["ss"])


def fit(rows: DataFrame) -> DataFrame:
    """``(g, mean, cov)``: the reweighted estimate of each group ``g`` from the FEATURES columns."""
    values = [F.col(f) for f in FEATURES]
    now = materialize(_starts(rows), "mcd-start")
    for _ in range(STEPS):
        seen = rows.join(now, "g").withColumn("d2", _distance())
        cut = seen.groupBy("g", "start").agg(F.percentile_approx("d2", SUPPORT, 1000).alias("cut"))
        near = seen.join(cut, ["g", "start"]).filter("d2 <= cut")
        now = materialize(_estimates(_moments(near, values, ["g", "start"]), _plain), "mcd-step")
    best = now.groupBy("g").agg(F.min_by(F.struct("mean", "cov", "precision"), F.struct("logdet", "start")).alias("e"))
    best = materialize(best.select("g", "e.*"), "mcd-best")
    seen = rows.join(best, "g").withColumn("d2", _distance())
    factor = seen.groupBy("g").agg((F.percentile_approx("d2", 0.5, 1000) / chi_square(0.5)).alias("factor"))
    near = seen.join(factor, "g").filter(F.col("d2") <= chi_square(0.975) * F.greatest("factor", F.lit(0.1)))
    return materialize(_estimates(_moments(near, values, ["g"]), _plain).select("g", "mean", "cov"), "mcd-final")


def _group_name(*columns: str) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])


def _with_groups(stats: DataFrame, lang_col: str, source_col: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Each row with the group ``g`` that judges it, and the rows that each group is fitted on."""
    good = stats.filter("not base_failed")
    fine, coarse = _group_name(lang_col, source_col), _group_name(lang_col)
    per_fine = good.groupBy(fine.alias("fine"), coarse.alias("coarse")).agg(F.count(F.lit(1)).alias("n"))
    per_coarse = per_fine.groupBy("coarse").agg(F.sum("n").alias("n_coarse"))
    level = (F.when(F.col("n") >= least, F.concat(F.lit("s "), F.col("fine")))
             .when(F.col("n_coarse") >= least, F.concat(F.lit("l "), F.col("coarse"))).otherwise("all"))
    groups = materialize(per_fine.join(per_coarse, "coarse").select("fine", level.alias("g")), "mcd-groups")
    named = stats.withColumn("fine", fine).join(groups, "fine", "left").drop("fine")
    fit_columns = good.select(fine.alias("fine"), F.concat(F.lit("l "), coarse).alias("coarse"), *FEATURES)
    used = groups.select("g").distinct()
    by_source = fit_columns.join(groups.filter("g like 's %'"), "fine").select("g", *FEATURES)
    by_language = fit_columns.join(used, F.col("coarse") == F.col("g")).select("g", *FEATURES)
    everything = fit_columns.withColumn("a", F.lit("all")).join(used, F.col("a") == F.col("g")).select("g", *FEATURES)
    return named, by_source.unionByName(by_language).unionByName(everything)


def judge(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", least: int = LEAST) -> DataFrame:
    """The ``carry`` columns, the counts, ``base_failed``, ``distance`` (squared, null without an estimate), ``kept``."""
    own = docs.select(*[F.col(c).alias(f"c_{c}") for c in carry], F.col(lang_col).alias("lang"),
                      F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    names = tuple(f"c_{c}" for c in carry)
    stats = materialize(_with_features(statistics(own, "text", (*names, "lang", "source"))), "quality-statistics")
    named, rows = _with_groups(stats, "lang", "source", least)
    found = fit(rows)
    scored = named.join(found, "g", "left").select(*names, *COUNTS, "base_failed", *FEATURES, "mean", "cov")
    schema = scored.drop(*FEATURES, "mean", "cov").schema.add("distance", "double")
    n_out = len(schema.names) - 1

    def run(batch: pa.RecordBatch):
        x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
        known = np.flatnonzero(batch.column("mean").is_valid().to_numpy(zero_copy_only=False))
        distance = np.full(batch.num_rows, np.nan)
        for part in np.array_split(known, -(-len(known) // 4096) or 1):
            if len(part):
                own_rows = pa.array(part)
                mean = batch.column("mean").take(own_rows).flatten().to_numpy().reshape(-1, P)
                cov = batch.column("cov").take(own_rows).flatten().to_numpy().reshape(-1, P, P)
                words = np.maximum(1, batch.column("n_words").to_numpy()[part])
                cov = cov + np.eye(P) * (FLOOR**2 + NOISE / words[:, None])[:, None, :]
                gap = x[part] - mean
                distance[part] = (gap * np.linalg.solve(cov, gap[..., None])[..., 0]).sum(axis=1)
        made = pa.array(distance, mask=np.isnan(distance))
        yield pa.RecordBatch.from_arrays([*batch.columns[:n_out], made], names=schema.names)

    judged = map_batches(scored, run, schema)
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= chi_square(1 - TAIL)))
    return judged.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], *COUNTS, "base_failed", "distance",
                         kept.alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source", least: int = LEAST) -> DataFrame:
    """The documents, with all their columns, that the rules keep."""
    key = F.xxhash64(id_col, text_col, lang_col, source_col)
    judged = judge(docs.withColumn("__key", key), ("__key",), text_col, lang_col, source_col, least)
    gone = judged.filter("not kept").select("__key").distinct()
    return docs.withColumn("__key", key).join(gone, "__key", "left_anti").drop("__key")


def op3_robust_quality_outliers(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
