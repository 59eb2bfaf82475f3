"""The translation store: one record per (context, language, docname)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.sources.corpus import KEYS

STORE_SCHEMA = "docname string, translated_text string, context string, language string"


def write_translations(df: DataFrame, path: str, max_records: int = 1_000_000) -> None:
    """Write the store partitioned by context and language.

    Rows are rebalanced by folder: small folders share a task, and one that holds
    a third of the corpus is split into as many as its size asks for. A failed
    write fails the job.
    """
    (df.select(*KEYS, "translated_text").hint("rebalance", "context", "language")
       .write.mode("overwrite").option("maxRecordsPerFile", max_records)
       .partitionBy("context", "language").parquet(path))


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path).select(*KEYS, "translated_text")


def translation_lookup(corpus: DataFrame, store: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Append ``translated_text``, NULL for a document the store does not hold."""
    keys = keys or KEYS
    return corpus.join(store.select(*keys, "translated_text"), keys, "left")


def translated_only(df: DataFrame, translated: str = "translated_text") -> DataFrame:
    """Keep documents that have a translation."""
    return df.filter(F.col(translated).isNotNull())
