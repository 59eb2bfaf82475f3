"""Word-vector files in word2vec text format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.scratch import new_path


def scan_word_vectors(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """``(word, embedding array<float>)`` from a ``.vec`` or ``.vec.gz`` file.

    A gzip file is one split, so it is parsed once, written as Parquet (to
    ``table``, or to the shared scratch folder) and read from there.
    """
    # The header line has two fields: number of words, number of dimensions.
    fields = spark.read.text(path).select(F.split(F.rtrim("value"), " ").alias("f")).filter(F.size("f") > 2)
    vectors = fields.select(F.col("f")[0].alias("word"),
                            F.slice("f", F.lit(2), F.size("f") - 1).cast("array<float>").alias("embedding"))
    table = table or new_path(spark, "word-vectors")
    vectors.repartition(max(1, spark.sparkContext.defaultParallelism)).write.parquet(table)
    return spark.read.parquet(table)


def write_word_vectors(vectors: DataFrame, path: str) -> None:
    """Write ``word v1 v2 ...`` lines, gzip-compressed, without a header line."""
    values = F.concat_ws(" ", F.col("word"), F.array_join(F.col("embedding").cast("array<string>"), " "))
    vectors.select(values.alias("value")).write.option("compression", "gzip").text(path)
