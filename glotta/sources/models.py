"""Saving and restoring trained models, with the hold-out rows beside them.

A model's parts go to a folder of their own under ``versions``. Last of all the
manifest is written beside its place and renamed onto it: it names the class, the
version, the parameters and what belongs to the model, and a model is loaded only
by its manifest. A save that breaks off leaves the model before it as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.clustering import DistributedLDAModel, KMeansModel, LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession

from glotta.operators.boosting import BoostedClassifier, Trees
from glotta.operators.calibration import CalibratedClassifier
from glotta.operators.classification import TrainedClassifier
from glotta.operators.topics import TrainedLda
from glotta.operators.word_topics import STORED, WordTopics

MANIFEST = "manifest.json"
FORMAT = 1
TREES = ("round int, class int, feature array<int>, cut array<int>, threshold array<double>, value array<double>")


@dataclass(frozen=True)
class Kind:
    """How a class of models is stored: ``save(model, folder)`` gives what the manifest must keep for ``load``."""

    of: type
    save: Callable[[Any, str], dict]
    load: Callable[[SparkSession, str, dict], Any]


# --- parts --------------------------------------------------------------------------------------------

def _save_ml(name: str) -> Callable[[Any, str], dict]:
    def save(model, folder):
        model.write().overwrite().save(f"{folder}/{name}")
        return {}

    return save


def _save_classifier(model: TrainedClassifier, folder: str) -> dict:
    model.pipeline.write().overwrite().save(f"{folder}/pipeline")
    first = model.pipeline.stages[0]
    settings = {p.name: v for p, v in first.extractParamMap().items() if isinstance(v, int | float | str | bool)}
    trees = [len(m.trees) for m in first.models] if isinstance(first, OneVsRestModel) else []
    return {"labels": model.labels, "parameters": settings | ({"trees": trees} if trees else {})}


def _save_boosted(model: BoostedClassifier, folder: str) -> dict:
    """One row per tree."""
    t = model.trees
    rows = [(r, k, *(x[r, k].tolist() for x in (t.feature, t.cut, t.threshold, t.value)))
            for r in range(t.rounds) for k in range(len(model.labels))]
    spark = SparkSession.active()
    spark.createDataFrame(rows, TREES).coalesce(1).write.parquet(f"{folder}/trees")
    return {"labels": model.labels, "losses": model.losses,
            "parameters": {"dims": model.dims, "rounds": t.rounds, "inner": t.feature.shape[2]}}


def _load_boosted(spark: SparkSession, folder: str, kept: dict) -> BoostedClassifier:
    settings = kept["parameters"]
    shape = (settings["rounds"], len(kept["labels"]), settings["inner"])
    trees = Trees(np.full(shape, -1), np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros((*shape[:2], shape[2] + 1)))
    rows = spark.read.schema(TREES).parquet(f"{folder}/trees").collect()
    if len(rows) != shape[0] * shape[1]:
        raise ValueError(f"{folder} does not hold all trees")
    for r in rows:
        for name in ("feature", "cut", "threshold", "value"):
            getattr(trees, name)[r["round"], r["class"]] = r[name]
    return BoostedClassifier(trees, kept["labels"], settings["dims"], [tuple(x) for x in kept["losses"]])


def _save_lda(model: TrainedLda, folder: str) -> dict:
    model.vectorizer.write().overwrite().save(f"{folder}/vocabulary")
    model.model.write().overwrite().save(f"{folder}/lda")
    return {"vocabulary": "vocabulary", "parameters": {"k": model.model.getK(), "words": len(model.vectorizer.vocabulary),
                                                       "distributed": model.model.isDistributed()}}


def _load_lda(spark: SparkSession, folder: str, kept: dict) -> TrainedLda:
    kind = DistributedLDAModel if kept["parameters"]["distributed"] else LocalLDAModel
    return TrainedLda(CountVectorizerModel.load(f"{folder}/{kept['vocabulary']}"), kind.load(f"{folder}/lda"))


def _word_topic_settings(kept: dict) -> dict:
    return {"totals": kept["parameters"]["totals"], "alpha": kept["parameters"]["alpha"]}


def _save_calibrated(model: CalibratedClassifier, folder: str) -> dict:
    inner = _kind_of(model.model)
    return {"labels": model.labels, "curves": model.curves,
            "model": {"class": inner.of.__name__, **inner.save(model.model, f"{folder}/model")}}


def _load_calibrated(spark: SparkSession, folder: str, kept: dict) -> CalibratedClassifier:
    inner = KINDS[kept["model"]["class"]].load(spark, f"{folder}/model", kept["model"])
    return CalibratedClassifier(inner, kept["labels"], [[tuple(p) for p in c] for c in kept["curves"]])


def _save_word_topics(model: WordTopics, folder: str) -> dict:
    model.words.write.parquet(f"{folder}/words")
    return {"vocabulary": "words", "parameters": {"alpha": model.alpha, "totals": model.totals}}


KINDS = {k.of.__name__: k for k in [
    Kind(PipelineModel, _save_ml("pipeline"), lambda spark, folder, kept: PipelineModel.load(f"{folder}/pipeline")),
    Kind(TrainedClassifier, _save_classifier,
         lambda spark, folder, kept: TrainedClassifier(PipelineModel.load(f"{folder}/pipeline"), kept["labels"])),
    Kind(BoostedClassifier, _save_boosted, _load_boosted),
    Kind(KMeansModel, _save_ml("kmeans"), lambda spark, folder, kept: KMeansModel.load(f"{folder}/kmeans")),
    Kind(TrainedLda, _save_lda, _load_lda),
    Kind(WordTopics, _save_word_topics, lambda spark, folder, kept: WordTopics(
        spark.read.schema(STORED).parquet(f"{folder}/{kept['vocabulary']}"), **_word_topic_settings(kept))),
    Kind(CalibratedClassifier, _save_calibrated, _load_calibrated),
]}


def _kind_of(model: Any) -> Kind:
    for kind in KINDS.values():
        if isinstance(model, kind.of):
            return kind
    raise TypeError(f"{type(model).__name__} has no stored form")


# --- the manifest -------------------------------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, text: str, path: str, version: str) -> None:
    """Write beside the place of the manifest, then rename onto it."""
    target = f"{path}/{MANIFEST}"
    beside, fs = _file_system(spark, f"{path}/.{version}.{MANIFEST}")
    out = fs.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), options)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of the stored model; an error where none was completed."""
    place, fs = _file_system(spark, f"{path}/{MANIFEST}")
    if not fs.exists(place):
        raise FileNotFoundError(f"{path} holds no whole model")
    stream = fs.open(place)
    try:
        kept = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if kept["format"] != FORMAT or kept["class"] not in KINDS:
        raise ValueError(f"{path} was stored as {kept['class']}, format {kept['format']}")
    return kept


def save_model(model: Any, path: str, holdout: DataFrame | None = None) -> str:
    """Store a classifier (with or without calibration), K-means or LDA model and its hold-out; returns the version."""
    spark = SparkSession.active()
    kind = _kind_of(model)
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    kept = kind.save(model, folder)
    if holdout is not None:
        holdout.write.parquet(f"{folder}/holdout")
    manifest = {"format": FORMAT, "class": kind.of.__name__, "version": version,
                "holdout": None if holdout is None else "holdout", **kept}
    _publish(spark, json.dumps(manifest, indent=1), path, version)
    return version


def load_model(path: str) -> Any:
    """The model that the manifest names, as an object of the class that was saved."""
    spark = SparkSession.active()
    kept = read_manifest(spark, path)
    return KINDS[kept["class"]].load(spark, f"{path}/versions/{kept['version']}", kept)


def load_holdout(spark: SparkSession, path: str) -> DataFrame:
    kept = read_manifest(spark, path)
    if kept["holdout"] is None:
        raise FileNotFoundError(f"{path} was stored without a hold-out")
    return spark.read.parquet(f"{path}/versions/{kept['version']}/{kept['holdout']}")
