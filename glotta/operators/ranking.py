"""Exact global ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glotta.scratch import materialize

BUCKET_HEX_DIGITS = 4  # 16^4 = 65,536 hash ranges


def key_hash(keys: list[str], seed: int) -> Column:
    """A seeded hash of the key columns, the same on every run and engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def hash_rank(df: DataFrame, keys: list[str], seed: int, within: list[str] | None = None,
              out: str = "rank") -> DataFrame:
    """Number the rows 1..n in the order of ``(hash(keys), keys)``, per ``within`` group.

    Equal to ``row_number() over (partition by within order by hash, keys)``, but
    a group that holds most of the table is not sorted by one task: rows are
    ranked inside one of 65,536 hash ranges, and the sizes of the preceding
    ranges (at most 65,536 numbers per group) are added. ``keys`` must be unique,
    which keeps the ranges even whatever the group sizes are.
    """
    within = within or []
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn("_range", F.substring("_h", 1, BUCKET_HEX_DIGITS))
    bucket = within + ["_range"]
    before = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # Null-safe so that rows with a null group are numbered too.
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in bucket], "_offset")
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in within]
    same.append(F.col("_range") == F.col("_o__range"))
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    inside = Window.partitionBy(*bucket).orderBy("_h", *keys)
    ranked = hashed.withColumn("_local", F.row_number().over(inside)).join(offsets, condition, "inner")
    return ranked.withColumn(out, (F.col("_local") + F.col("_offset")).cast("bigint")).select(*df.columns, out)


def order_rank(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """Number the rows 1..n in the given order, which must have no ties.

    Rows are dealt into ranges of the order and ranked inside each; the sizes of
    the preceding ranges are added. The ranges are written, as a second run of
    their sampling could deal them otherwise.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "order-ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order)
    ranked = ranged.withColumn("_local", F.row_number().over(inside)).join(F.broadcast(offsets), "_range")
    return ranked.withColumn(out, (F.col("_local") + F.col("_offset")).cast("bigint")).select(*df.columns, out)


def at_least_first(df: DataFrame, count: int, number: str = "n") -> DataFrame:
    """The rows that can be among the first ``count`` by descending ``number``, all of equal numbers included.

    Numbers below 2^62 are counted by their length in bits and their next four, a thousand groups at most.
    """
    shift = F.greatest(F.lit(0), F.length(F.bin(number)) - 5)
    group = F.expr(f"shiftright({number}, cast(greatest(0, length(bin({number})) - 5) as int))")
    sizes = df.filter(F.col(number) > 0).groupBy(shift.alias("_shift"), group.alias("_group")).agg(
        F.count(F.lit(1)).alias("_n")).collect()
    least, seen = 0, 0
    for r in sorted(sizes, key=lambda r: -(r["_group"] << r["_shift"])):
        if seen >= count:
            break
        least, seen = r["_group"] << r["_shift"], seen + r["_n"]
    return df.filter(F.col(number) >= least) if seen >= count else df


def first_by_hash(df: DataFrame, keys: list[str], seed: int, count: Column) -> DataFrame:
    """Flag exactly the first ``count`` rows in hash order in a column ``selected``.

    ``count`` is an expression over ``n``, the number of rows. Only the one hash
    range that contains the cut needs its rows ranked, about n / 65,536 of them;
    every other row is decided by comparing its range with the cut.
    """
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn("_range", F.substring("_h", 1, BUCKET_HEX_DIGITS))
    sizes = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        sizes.withColumn("n", F.sum("_n").over(everything))
        .withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_want", count.cast("bigint"))
        .withColumn("_take", F.greatest(F.lit(0), F.least("_n", F.col("_want") - F.col("_upto") + F.col("_n"))))
        .select("_range", "_take", "_n")
    )
    # At most 65,536 rows of (range, two counts): bounded by the digit count above.
    decided = hashed.join(F.broadcast(ranges), "_range")
    whole = decided.filter((F.col("_take") == 0) | (F.col("_take") == F.col("_n"))).withColumn(
        "selected", F.col("_take") > 0)
    inside = Window.partitionBy("_range").orderBy("_h", *keys)
    cut = decided.filter((F.col("_take") > 0) & (F.col("_take") < F.col("_n"))).withColumn(
        "selected", F.row_number().over(inside) <= F.col("_take"))
    return whole.unionByName(cut).select(*df.columns, "selected")
