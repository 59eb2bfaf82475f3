"""Per-token work on array columns: inline for tiny lookups, joined otherwise.

A lookup of at most ``INLINE_ROWS`` rows is written into the expression as a
literal map, and each document is processed in place: no explode, no shuffle.
A larger one that can be broadcast is looked up in Arrow batches, again in place.
Beyond that the lookup is joined to the exploded tokens, and the tokens are
collected again per document in their old order, which sorts every token.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

INLINE_ROWS = 256


def inline_rows(lookup: DataFrame, bound: int = INLINE_ROWS) -> list[Row] | None:
    """The rows of a lookup of at most ``bound`` rows, else None. Reads no more than ``bound + 1``."""
    rows = lookup.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def token_values(tokens: Column, table: DataFrame) -> Column:
    """The values of the tokens in ``table(token, value)``, in their order, NULL for a token it does not hold.

    ``table`` has distinct tokens and is broadcast: its size is bounded by the
    caller. A NULL array stays NULL.
    """
    kind = table.schema[1].dataType.simpleString()
    found = table.toArrow()
    return _values(tokens, kind, table, [c.combine_chunks() for c in found.columns])


def _values(tokens: Column, kind: str, table: DataFrame, columns: list[pa.Array]) -> Column:
    shared = table.sparkSession.sparkContext.broadcast(columns)

    @F.arrow_udf(returnType=f"array<{kind}>")
    def look_up(lists: pa.Array) -> pa.Array:
        words, values = shared.value
        flat = lists.flatten()
        own = values.take(pc.index_in(flat, value_set=words.cast(flat.type)))
        sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(ends, own, mask=lists.is_null())

    return look_up(tokens)


def distinct_values(tokens: Column, kind: str, of: Callable[[pa.Array], pa.Array]) -> Column:
    """``of`` of each token, in their order; it gets the distinct tokens of an Arrow batch. A NULL array stays NULL."""

    @F.arrow_udf(returnType=f"array<{kind}>")
    def look_up(lists: pa.Array) -> pa.Array:
        own = lists.flatten().dictionary_encode()
        return _lists(of(own.dictionary.cast(pa.string())).take(own.indices), lists)

    return look_up(tokens)


def filtered_values(tokens: Column, kind: str, of: Callable[[pa.Array], tuple[pa.Array, pa.Array]]) -> Column:
    """As ``distinct_values``, where ``of`` also tells which tokens stay: ``(values, stays)``."""

    @F.arrow_udf(returnType=f"array<{kind}>")
    def look_up(lists: pa.Array) -> pa.Array:
        own = lists.flatten().dictionary_encode("encode")  # a NULL token is a word as well
        values, stays = of(own.dictionary.cast(pa.string()))
        kept = stays.take(own.indices)
        return _lists(values.take(own.indices).filter(kept), lists, kept.to_numpy(zero_copy_only=False))

    return look_up(tokens)


def _lists(values: pa.Array, like: pa.Array, kept: np.ndarray | None = None) -> pa.Array:
    """The values as lists: those of ``like``, or what is ``kept`` of them."""
    sizes = pc.fill_null(like.value_lengths(), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if kept is not None:
        ends = np.concatenate([[0], np.cumsum(kept)]).astype(np.int64)[ends]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=like.is_null())


def rejoin_tokens(df: DataFrame, carried: list[str], tokens: Column,
                  lookup: Callable[[DataFrame], DataFrame], value: Column) -> DataFrame:
    """Look tokens up as rows and collect them again: ``carried`` plus ``_values``.

    ``tokens`` is exploded to ``(_row, _carried, _pos, token)``, ``lookup`` joins its
    table to those rows (keeping them all), and the non-NULL ``value``s of a row
    are collected in token order. ``_row`` numbers the rows of ``df``, so rows with
    equal columns stay apart, and the carried columns travel in one struct, so
    they may be of any type and name. Every row of ``df`` has one row in the
    result; a NULL array stays NULL. With a broadcast look-up the tokens of a row
    are still together, so they are collected before the shuffle.
    """
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), tokens.alias("_tokens"),
                         F.struct(F.lit(0).alias("_"), *carried).alias("_carried"))
    exploded = numbered.select("_row", "_carried", F.col("_tokens").isNull().alias("_no_tokens"),
                               F.posexplode_outer("_tokens").alias("_pos", "token"))
    kept = F.when(value.isNotNull(), F.struct("_pos", value.alias("v")))
    grouped = lookup(exploded).groupBy("_row").agg(
        F.sort_array(F.collect_list(kept)).alias("_s"), F.max("_no_tokens").alias("_no_tokens"),
        F.first("_carried").alias("_carried"))
    return grouped.select(*[F.col("_carried")[c].alias(c) for c in carried],
                          F.when(~F.col("_no_tokens"), F.col("_s.v")).alias("_values"))
