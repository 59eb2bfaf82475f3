"""Lookup joins whose strategy depends on the checked size of the lookup side.

A token column is joined to a lookup table (word vectors, vocabulary, lexicon,
n-gram profile). Token frequencies are heavily skewed, so a plain shuffle join
on the token puts the hottest word into one task. Two strategies:

* lookup side within the bound: broadcast, the token side does not move;
* beyond it: the lookup side is replicated over ``salts`` and both sides are
  shuffled on ``(token, salt)``, so one hot token is spread over ``salts`` tasks.

Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row bounds for broadcasting. A lookup row is a word plus a few short fields;
# a vector row is a word plus `dim` floats and is bounded by bytes instead.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 1_500_000_000
DEFAULT_SALTS = 64


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows, reading at most ``rows + 1``."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(left: DataFrame, lookup: DataFrame, on: str | list[str], how: str, spread_by: Column,
                max_broadcast_rows: int = MAX_BROADCAST_ROWS, salts: int = DEFAULT_SALTS,
                small: bool | None = None) -> DataFrame:
    """Join ``left`` to ``lookup`` (``inner``, ``left`` or ``left_semi``).

    ``spread_by`` is a left-side expression (normally the document key) whose
    hash picks the salt. ``small`` skips the size check when the caller knows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small is None:
        small = has_at_most(lookup, max_broadcast_rows)
    if small:
        return left.join(F.broadcast(lookup), keys, how)
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_lookup.hint("shuffle_hash"), keys + ["_salt"], how).drop("_salt")
