"""Helpers that several operators share: tables, batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.scratch import materialize, new_path, write_table

__all__ = ["materialize", "new_path"]

BATCH_BYTES = 2 << 20
SMALL_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch as bytes, in runs of about ``limit`` bytes: ``(first row, texts)``.

    A null is an empty text. A text is never cut: one that is longer than
    ``limit`` makes a run of its own.
    """
    column_ = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_binary(column_.type) and not pa.types.is_large_binary(column_.type):
        column_ = column_.cast(pa.large_binary())
    first, run, size = 0, [], 0
    for i, value in enumerate(column_):
        text = value.as_py() or b""
        if run and size + len(text) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def semi_join(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Rows of ``big`` whose ``on`` is in the written table ``small``, which has that one column of longs.

    Up to SMALL_ROWS rows (some 20 MB) are broadcast; beyond that a shuffled join does the same.
    """
    return big.join(F.broadcast(small) if small.count() <= SMALL_ROWS else small, on, "left_semi")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table once what was made from it has been written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession, name)
    return write_table(df, path), path


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an undirected graph; the root is the smallest node of its component.

    Alternating large-star and small-star steps: each rewires every node to the
    least node it knows of, until nothing changes. All steps are joins with
    pre-aggregated minima, so a node with very many links is split by the
    adaptive skew join, and every round is written to the shared folder.
    """
    both = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    links, path = _written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                           "components")
    spark, seen = edges.sparkSession, None
    while True:
        mirrored = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = mirrored.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = mirrored.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        links, newer = _written(small.filter("u <> v").distinct(), "components")
        # The number of links, their order-free hash: unchanged twice over means that every node points at its root.
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        delete_path(spark, path)
        path = newer
        if state == seen:
            break
        seen = state
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
