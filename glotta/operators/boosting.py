"""Multi-class gradient boosting with one joint softmax.

Every round adds one tree per class, all fitted to the gradients and Hessians of
the same softmax. A level of a round's trees is one aggregation: each task sums
the gradients of its rows by (class, node, feature, bin), Spark adds these sums
up, and the driver picks the splits from them. What reaches the driver are
``classes * nodes * features * bins`` numbers, whatever the number of rows.

Features are binned once, and a row keeps its bins and its running scores, one
per class. Scores go on from the stored ones by the trees grown since; they are
written anew every SCORES_EVERY rounds, which also cuts the lineage. Losses of
training and test rows come with the same passes.

All sums are of whole numbers (multiples of 1 / FIXED), so the model does not
depend on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotta.scratch import delete_path, new_path

# The training settings.
DEPTH = 2
STEP = 1.0
ROUNDS = 20
PENALTY = 1.0  # on the square of a leaf's value
LEAST_HESSIAN = 1.0  # on either side of a split

BINS = 64
CELLS = 512  # of equal width, from whose counts the bins of a feature are made
FIXED = 1 << 28
SCORES_EVERY = 5
LEAST_GAIN = 1e-6
CHUNK = 4096
STATE = "label int, test boolean, bins binary, scores array<double>"


@dataclass(frozen=True)
class Trees:
    """Complete trees by (round, class, node) in heap order. ``feature`` -1: all rows go left."""

    feature: np.ndarray
    cut: np.ndarray  # rows go left whose bin is at most this
    threshold: np.ndarray  # the same in values: rows go left below it
    value: np.ndarray  # of the leaves

    @property
    def rounds(self) -> int:
        return self.feature.shape[0]

    def part(self, start: int, end: int | None = None) -> Trees:
        return Trees(*(x[start:end] for x in (self.feature, self.cut, self.threshold, self.value)))

    def margins(self, rows: np.ndarray, binned: bool = False) -> np.ndarray:
        """The summed values of every class for each row of features (or bins)."""
        rounds, classes, inner = self.feature.shape
        out = np.zeros((len(rows), classes))
        at = np.arange(len(rows))
        for r in range(rounds):
            for k in range(classes):
                node = np.zeros(len(rows), dtype=np.int64)
                while node.size and node[0] < inner:
                    f = self.feature[r, k, node]
                    x = rows[at, f]
                    # Not a number is above every threshold.
                    right = x > self.cut[r, k, node] if binned else ~(x < self.threshold[r, k, node])
                    node = 2 * node + 1 + (right & (f >= 0))
                if node.size:
                    out[:, k] += self.value[r, k, node - inner]
        return out


@dataclass(frozen=True)
class BoostedClassifier:
    """Trees with their class labels in code order; ``losses`` holds (round, dataset, loss) of the training."""

    trees: Trees
    labels: list[str]
    dims: int
    losses: list[tuple[int, str, float]] = field(default_factory=list)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Equally long arrays of numbers as rows; a missing number is not a number."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    if len(values) != width * len(column):
        raise ValueError(f"vectors must have {width} numbers each")
    return values.reshape(len(column), width)


def _bytes_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


# --- bins ---------------------------------------------------------------------------------------------

def _ranges(vectors: DataFrame, dims: int) -> np.ndarray:
    """Least and greatest finite value of each feature: ``(2, dims)``."""

    def run(batches):
        low, high = np.full(dims, np.inf), np.full(dims, -np.inf)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            if len(x):
                ok = np.isfinite(x)
                low = np.minimum(low, np.where(ok, x, np.inf).min(axis=0))
                high = np.maximum(high, np.where(ok, x, -np.inf).max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high)],
                                         names=["feature", "low", "high"])

    rows = vectors.mapInArrow(run, "feature int, low double, high double").groupBy("feature").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out = np.zeros((2, dims))
    for r in rows:
        if r["low"] <= r["high"]:
            out[:, r["feature"]] = r["low"], r["high"]
    return out


def _cells(x: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """The number of the cell of equal width that each finite value is in."""
    width = (ranges[1] - ranges[0]) / CELLS
    with np.errstate(divide="ignore", invalid="ignore"):
        cell = np.floor((x - ranges[0]) / width)
    return np.clip(np.nan_to_num(cell, nan=0.0), 0, CELLS - 1).astype(np.int64)


def bin_edges(vectors: DataFrame, dims: int) -> list[np.ndarray]:
    """For each feature at most BINS - 1 ascending edges that deal its values into about equal parts.

    The edges lie between cells of equal width; the counts of all rows by cell
    decide which of them are taken.
    """
    ranges = _ranges(vectors, dims)

    def run(batches):
        counts = np.zeros(dims * CELLS, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for i in range(0, len(x), CHUNK):
                part = x[i:i + CHUNK]
                flat = (_cells(part, ranges) + np.arange(dims) * CELLS)[np.isfinite(part)]
                counts += np.bincount(flat, minlength=dims * CELLS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], names=["cell", "n"])

    rows = vectors.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(dims * CELLS, dtype=np.int64)
    for r in rows:
        counts[r["cell"]] = r["n"]
    counts = counts.reshape(dims, CELLS)
    edges = []
    for j in range(dims):
        filled = np.cumsum(counts[j])
        wanted = np.arange(1, BINS) * (int(filled[-1]) / BINS)
        cut = np.unique(np.searchsorted(filled, wanted, side="left")) + 1
        cut = cut[(cut < CELLS) & (filled[np.minimum(cut, CELLS) - 1] < filled[-1])]
        low, high = ranges[:, j]
        edges.append(low + (high - low) / CELLS * cut if high > low else np.empty(0))
    return edges


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of edges at or below each value; not a number comes last."""
    return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


# --- training -----------------------------------------------------------------------------------------

def _initial_state(train: DataFrame, test: DataFrame | None, code: Column, vectors: str, edges: list[np.ndarray],
                   classes: int) -> DataFrame:
    dims = len(edges)
    rows = train.select(code.alias("label"), F.lit(False).alias("test"), F.col(vectors).alias("v"))
    if test is not None:
        rows = rows.unionByName(test.select(code.alias("label"), F.lit(True).alias("test"), F.col(vectors).alias("v")))
    rows = rows.filter("label is not null and v is not null")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bins = to_bins(_matrix(batch.column(2), dims), edges)
                scores = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * classes, pa.int32()),
                                                  pa.array(np.zeros(batch.num_rows * classes)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in bins], pa.binary()), scores],
                    names=["label", "test", "bins", "scores"])

    return rows.mapInArrow(run, STATE)


def _advanced(state: DataFrame, trees: Trees, dims: int, classes: int) -> DataFrame:
    """The state with the scores that ``trees`` add."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                scores = _matrix(batch.column(3), classes) + trees.margins(_bytes_matrix(batch.column(2), dims), True)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.ListArray.from_arrays(
                        pa.array(np.arange(batch.num_rows + 1) * classes, pa.int32()), pa.array(scores.ravel()))],
                    names=["label", "test", "bins", "scores"])

    return state.mapInArrow(run, STATE)


def _places(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """The node of each row on a level of one class's tree, numbered from 0 within the level."""
    node = np.zeros(len(bins), dtype=np.int64)
    at = np.arange(len(bins))
    for _ in range(level):
        f = feature[node]
        node = 2 * node + 1 + ((f >= 0) & (bins[at, f] > cut[node]))
    return node - (2**level - 1)


def _level_sums(state: DataFrame, since: Trees, feature: np.ndarray, cut: np.ndarray, level: int, dims: int,
                classes: int) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """Sums of gradients and Hessians, ``(class, node, feature, bin)`` each, and ``{test: (loss, rows)}``, all times FIXED."""
    nodes = 2**level
    size = nodes * dims * BINS

    def run(batches: Iterator[pa.RecordBatch]):
        sums = np.zeros((2, classes, size), dtype=np.int64)
        losses = np.zeros((2, 2), dtype=np.int64)
        offset = np.arange(dims) * BINS
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                label = part.column(0).to_numpy()
                test = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                bins = _bytes_matrix(part.column(2), dims)
                p = softmax(_matrix(part.column(3), classes) + since.margins(bins, True))
                loss = np.rint(-np.log(np.maximum(p[np.arange(len(p)), label], 1e-16)) * FIXED).astype(np.int64)
                for t in (0, 1):
                    losses[t] += loss[test == t].sum(), (test == t).sum()
                label, bins, p = label[~test], bins[~test], p[~test]
                cells = bins.astype(np.int64) + offset
                for k in range(classes):
                    where = (cells + (_places(bins, feature[k], cut[k], level) * dims * BINS)[:, None]).ravel()
                    g = np.rint((p[:, k] - (label == k)) * FIXED)
                    h = np.rint(np.maximum(2 * p[:, k] * (1 - p[:, k]), 1e-16) * FIXED)
                    for s, x in ((0, g), (1, h)):
                        # Whole numbers below 2^53: these float sums are exact.
                        sums[s, k] += np.bincount(where, np.repeat(x, dims), minlength=size).astype(np.int64)
        rows = np.flatnonzero(sums.reshape(2, -1, BINS).any(axis=(0, 2)))
        kept = sums.reshape(2, -1, BINS)[:, rows]
        kept = np.concatenate([kept, np.pad(losses.T, ((0, 0), (0, BINS - 2)))[:, None]], axis=1)
        ends = pa.array(np.arange(len(rows) + 2) * BINS, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(rows, -1), pa.int64()), *(pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in kept)],
            names=["place", "g", "h"])

    partial = state.mapInArrow(run, "place long, g array<long>, h array<long>")
    total = partial.groupBy("place").agg(*(F.array(*(F.sum(F.col(c)[i]) for i in range(BINS))).alias(c) for c in "gh"))
    out = np.zeros((2, classes * nodes * dims, BINS), dtype=np.int64)
    losses = {}
    for place, g, h in total.collect():
        if place < 0:
            losses = {t: (g[t], h[t]) for t in (0, 1)}
        else:
            out[0, place], out[1, place] = g, h
    shape = (classes, nodes, dims, BINS)
    return out[0].reshape(shape), out[1].reshape(shape), losses


def _best_splits(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(feature, cut)`` of each (class, node), -1 where no split gains, and the sums ``(left, right)`` of both parts.

    Of equal gains the first feature, then the lowest cut counts.
    """
    left_g, left_h = np.cumsum(g, axis=3) / FIXED, np.cumsum(h, axis=3) / FIXED
    all_g, all_h = left_g[..., :1, -1:], left_h[..., :1, -1:]  # the same for every feature
    right_g, right_h = all_g - left_g, all_h - left_h
    score = lambda a, b: a * a / (b + PENALTY)
    gain = score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)
    gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = -np.inf
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(axis=2)
    ok = np.take_along_axis(flat, best[..., None], axis=2)[..., 0] > LEAST_GAIN
    pick = lambda x: np.take_along_axis(x.reshape(*flat.shape), best[..., None], axis=2)[..., 0]
    whole = [np.where(ok, pick(x), all_[..., 0, 0]) for x, all_ in ((left_g, all_g), (left_h, all_h))]
    rest = [np.where(ok, pick(x), 0.0) for x in (right_g, right_h)]
    return np.where(ok, best // BINS, -1), np.where(ok, best % BINS, 0), np.stack(whole), np.stack(rest)


def _grown(state: DataFrame, since: Trees, edges: list[np.ndarray], classes: int, depth: int, step: float):
    """One tree per class, and the losses before this round."""
    dims, inner = len(edges), 2**depth - 1
    feature = np.full((classes, inner), -1, dtype=np.int64)
    cut = np.zeros((classes, inner), dtype=np.int64)
    value = np.zeros((classes, inner + 1))
    losses = {}
    for level in range(depth):
        g, h, found = _level_sums(state, since, feature, cut, level, dims, classes)
        losses = losses or found
        first = 2**level - 1
        chosen, at, left, right = _best_splits(g, h)
        feature[:, first:2 * first + 1], cut[:, first:2 * first + 1] = chosen, at
        if level == depth - 1:
            value[:, 0::2] = -left[0] / (left[1] + PENALTY) * step
            value[:, 1::2] = -right[0] / (right[1] + PENALTY) * step
    threshold = np.zeros(feature.shape)
    for k, n in zip(*np.nonzero(feature >= 0)):
        threshold[k, n] = edges[feature[k, n]][cut[k, n]]
    return Trees(feature[None], cut[None], threshold[None], value[None]), losses


def _joined(parts: list[Trees], classes: int, depth: int) -> Trees:
    if not parts:
        inner = 2**depth - 1
        whole = np.zeros((0, classes, inner), dtype=np.int64)
        return Trees(whole, whole, whole.astype(float), np.zeros((0, classes, inner + 1)))
    return Trees(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("feature", "cut", "threshold", "value")))


def train_boosted(train: DataFrame, labels: list[str], label: str = "context", vectors: str = "document_embeddings",
                  test: DataFrame | None = None, rounds: int = ROUNDS, depth: int = DEPTH,
                  step: float = STEP) -> BoostedClassifier:
    """Fit ``rounds`` trees per class of ``labels``; rows of another or no label and rows without a vector do not count.

    With ``test`` the losses of those rows after each round are kept as well.
    """
    spark = train.sparkSession
    code = F.array_position(F.lit(labels), F.col(label).cast("string"))
    code = F.when(code > 0, code - 1).cast("int")
    used = train.filter(F.col(vectors).isNotNull() & code.isNotNull())
    first = used.select(F.size(vectors).alias("d")).first()
    if first is None or not labels:
        raise ValueError("there is no labelled vector to train on")
    dims, classes = first["d"], len(labels)
    edges = bin_edges(used.select(vectors), dims)
    path = new_path(spark, "boosting")
    _initial_state(train, test, code, vectors, edges, classes).write.parquet(path)
    done: list[Trees] = []
    losses: list[tuple[int, str, float]] = []
    written = 0

    def note(found: dict[int, tuple[int, int]]) -> None:
        losses.extend((len(done), name, found[t][0] / FIXED / found[t][1])
                      for t, name in ((0, "train"), (1, "test")) if done and found.get(t, (0, 0))[1])

    for r in range(rounds):
        if r - written == SCORES_EVERY:
            newer = new_path(spark, "boosting")
            _advanced(spark.read.schema(STATE).parquet(path), _joined(done[written:], classes, depth), dims, classes
                      ).write.parquet(newer)
            delete_path(spark, path)
            path, written = newer, r
        state = spark.read.schema(STATE).parquet(path)
        trees, found = _grown(state, _joined(done[written:], classes, depth), edges, classes, depth, step)
        note(found)
        done.append(trees)
    state = spark.read.schema(STATE).parquet(path)
    none = np.zeros((classes, 0), dtype=np.int64)
    note(_level_sums(state, _joined(done[written:], classes, depth), none, none, 0, dims, classes)[2])
    delete_path(spark, path)
    return BoostedClassifier(_joined(done, classes, depth), list(labels), dims, losses)


# --- use ----------------------------------------------------------------------------------------------

def class_probabilities(model: BoostedClassifier, vectors: Column | str) -> Column:
    """The probability of every class in code order, in Arrow batches; null for a null vector."""
    trees, dims, classes = model.trees, model.dims, len(model.labels)

    @F.arrow_udf(returnType="array<double>")
    def probabilities(column: pa.Array) -> pa.Array:
        known = column.is_valid()
        p = softmax(trees.margins(_matrix(column.drop_null(), dims))) if known.true_count else np.empty((0, classes))
        ends = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False).astype(np.int64))]) * classes
        mask = pa.array(~known.to_numpy(zero_copy_only=False).astype(bool))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(p.ravel()), mask=mask)

    return probabilities(vectors)


def feature_use(model: BoostedClassifier) -> list[tuple[str, int, int, int, float]]:
    """``(class, round, node, feature, threshold)`` of every split, rounds and nodes from 1."""
    trees = model.trees
    return [(model.labels[k], int(r) + 1, int(n) + 1, int(trees.feature[r, k, n]), float(trees.threshold[r, k, n]))
            for r, k, n in zip(*np.nonzero(trees.feature >= 0))]
