"""SimHash near-duplicates by covering locality-sensitive hashing.

Each text gets a 64-bit fingerprint of its word shingles. Bit i is given a
vector phi(i) of RADIUS + 1 bits; table v (a non-zero vector) keeps the bits
with odd phi(i).v and so masks the others. At most RADIUS differing bits span a
space that some v is orthogonal to, hence in table v none of them is kept:
every pair within the radius meets in one of the 2^(RADIUS+1) - 1 tables.

Defined results: a null text is empty, a text without words has fingerprint 0
and links like any other, equal fingerprints always link, a null id stays in
its group but never names it (a group of null ids only has a null component),
repeated rows are returned as often as they come, other columns are not read,
an empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glotta.llm.common import connected_components, map_batches, materialize, pieces

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
BUCKET = 1024  # fingerprints compared in one place; larger buckets are split by more bits


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text (UTF-8), as an unsigned number."""
    words = text.lower().split()  # bytes: only A-Z, and the separators \x20 \x09-\x0D
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:n].tolist(), (ends[SHINGLE - 1:] if len(words) >= SHINGLE else ends[-1:]).tolist()
    hashed = map(xxhash.xxh64_intdigest, map(flat.__getitem__, map(slice, starts, ends)), repeat(SEED))
    h = np.fromiter(hashed, np.uint64, n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 15):
        block = h[i:i + (1 << 15)]
        ones += np.unpackbits(block.view(np.uint8).reshape(len(block), 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, fp)``: key tells rows of one id with different texts apart; fp is the fingerprint as a signed long."""
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"),
                         F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch):
        made = [fingerprint(t) for _, texts in pieces(batch, "text") for t in texts]
        fp = pa.array(np.array(made, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], names=["id", "key", "fp"])

    return map_batches(chosen, run, "id long, key long, fp long")


def covering_masks() -> list[int]:
    """The kept bits of each table."""
    vectors = [1 + i % (2 ** (RADIUS + 1) - 1) for i in range(BITS)]
    return [sum(1 << i for i, phi in enumerate(vectors) if (phi & v).bit_count() % 2)
            for v in range(1, 2 ** (RADIUS + 1))]


def _parts(level: int) -> list[int]:
    """The 64 bits dealt into RADIUS + 1 parts, another way at each level; RADIUS differing bits miss one part."""
    order = np.random.default_rng(level).permutation(BITS)
    return [sum(1 << int(b) for b in order[j::RADIUS + 1]) for j in range(RADIUS + 1)]


def _linked(batch: pa.RecordBatch):
    """Links within buckets of at most BUCKET fingerprints."""
    lists = batch.column(0)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    left, right = [], []
    for size in np.unique(sizes[sizes <= 8]):
        rows = values[offsets[:-1][sizes == size][:, None] + np.arange(size)]
        for i in range(size):
            for j in range(i + 1, size):
                near = np.bitwise_count(rows[:, i] ^ rows[:, j]) <= RADIUS
                left.append(rows[near, i])
                right.append(rows[near, j])
    for k in np.flatnonzero(sizes > 8):
        v = values[offsets[k]:offsets[k + 1]]
        open_ = np.ones(len(v), dtype=bool)  # breadth first: each member is linked once, to one that reached it
        while open_.any():
            front = [int(np.flatnonzero(open_)[0])]
            open_[front] = False
            while front:
                i = front.pop()
                rest = np.flatnonzero(open_)
                near = rest[np.bitwise_count(v[rest] ^ v[i]) <= RADIUS]
                open_[near] = False
                front.extend(near.tolist())
                left.append(np.full(len(near), v[i]))
                right.append(v[near])
    a = np.concatenate(left).view(np.int64) if left else np.empty(0, np.int64)
    b = np.concatenate(right).view(np.int64) if right else np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links between different fingerprints (column ``fp``) that join all pairs within the radius.

    Within a bucket only as many links are made as connect its members. Buckets
    of more than ``bucket`` fingerprints are split anew by requiring one more
    part of the bits to agree, which again covers every pair, until all are small.
    """
    tables = F.array(*[F.lit(_signed(m)) for m in covering_masks()])
    rows = distinct.select("fp", F.explode(tables).alias("mask"))
    found, level = None, 0
    while True:
        keyed = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
        hot = materialize(keyed.groupBy("mask", "part").count().filter(F.col("count") > bucket).drop("count"), "hot")
        any_hot = not hot.isEmpty()
        fine = keyed.join(hot, ["mask", "part"], "left_anti") if any_hot else keyed
        lists = fine.groupBy("mask", "part").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
        made = map_batches(lists.select("fps"), _linked, "a long, b long")
        found = made if found is None else found.unionByName(made)
        if not any_hot:
            return found.distinct()
        masks = F.array(*[F.col("mask").bitwiseOR(F.lit(_signed(p))) for p in _parts(level)])
        split_again = keyed.join(hot, ["mask", "part"], "left_semi").select("fp", F.explode(masks).alias("mask"))
        rows = materialize(split_again.distinct(), "split")
        level += 1


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``(id, key, fp, component_id)`` for every row: the smallest id reachable over links, itself included."""
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(links(distinct.select("fp"), bucket)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Ties of one id are broken by a hash of id and text; of equal rows one stays.
    """
    rows = group(docs, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    kept = rows.groupBy("root").agg(first).select(F.col("first.key").alias("__key"))
    keyed = docs.withColumn("__key", F.xxhash64(id_col, text_col))
    once = Window.partitionBy("__key").orderBy("__key")
    return (keyed.join(kept, "__key", "left_semi").withColumn("__row", F.row_number().over(once))
            .filter("__row = 1").select(*docs.columns))


def op9_covering_simhash(spark, sf_dir: str) -> DataFrame:
    from glotta.llm.common import table

    rows = group(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")
