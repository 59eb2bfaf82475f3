"""Exact substring dedup: suffix buckets sorted one at a time, ties resolved by ranks of sampled suffixes.

Every byte covered by a LENGTH-byte string that also starts anywhere else goes.

The sample. A difference cover lets any two suffixes be compared by a short
prefix and the ranks of two sampled suffixes at one distance. Here the sampled
positions are chosen by content instead of by arithmetic: of the KEY-byte
strings in each LENGTH-byte window the one with the least hash is sampled, the
first of equals. Equal windows so sample the same position, which is all that
finding repeats needs, with about 2% of all positions instead of the 10 to 20%
of an arithmetic cover (see the README).

The buckets. All suffixes that might agree for LENGTH bytes reach the same
KEY-byte string, so it names the bucket. Keys that occur once drop out by a
count that is combined before the shuffle; texts without a repeated key are
never moved. A bucket holds one context per different surrounding of its key.
It is sorted twice, by what follows the sampled position and by what precedes it
read backwards, and common prefixes of neighbours give ranks at every depth: two
suffixes that start d bytes before the key agree for LENGTH bytes if they have
one rank at depth LENGTH - d of the first order and at depth d of the second.
Memory is bounded by BUCKET contexts; a larger bucket is split by the hash of
each window, counted in a distributed way.

Defined results: a null text is empty, texts under LENGTH bytes keep all, of
equal texts (of LENGTH bytes) all goes, null ids are carried, repeated rows give
a row each, other columns are not read, an empty table gives no rows. Texts,
keys, surroundings and the windows of split buckets are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, materialize, pieces, semi_join, table
from glotta.llm.words import _BASE_INVERSE, mix, powers

LENGTH = 200
KEY = 100
BEFORE = LENGTH - KEY  # a window starts at most so far before its key
BUCKET = 4096
BLOCK = 1 << 20
_POSITION_BITS = 22


class _Hashed:
    """Prefix sums over bytes, for the hash of any part."""

    def __init__(self, data: bytes):
        self.buf = np.frombuffer(data, dtype=np.uint8)
        self.prefix = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * powers(len(self.buf)), out=self.prefix[1:])
        self.back = powers(len(self.buf) + 1, _BASE_INVERSE)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start] + (end - start).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:n], from_left[width - 1:width - 1 + n])


def samples(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, position, key, surrounding)`` of all sampled positions of the texts."""
    out: list[tuple[np.ndarray, ...]] = []
    for first, run, origin, whole in _runs(texts):
        data = b"".join(run)
        if len(data) < LENGTH:
            continue
        hashed = _Hashed(data)
        at = np.arange(len(data) - KEY + 1)
        keys = hashed.part(at, at + KEY)
        order = (mix(keys, 3) >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | at.astype(np.uint64)
        least = _least(order, BEFORE + 1)
        ends = np.cumsum([len(t) for t in run])
        starts_of = np.concatenate([[0], ends[:-1]])
        inside = np.zeros(len(data) + 1, dtype=np.int32)
        long = ends - starts_of >= LENGTH
        np.add.at(inside, starts_of[long], 1)
        np.add.at(inside, ends[long] - LENGTH + 1, -1)
        valid = np.cumsum(inside)[: len(least)] > 0
        position = np.unique(least[valid] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        owner = np.searchsorted(ends, position, side="right")
        if whole:
            lo = np.maximum(starts_of[owner], position - BEFORE)
            hi = np.minimum(ends[owner], position + LENGTH)
            around = mix(hashed.part(lo, hi) + (position - lo).astype(np.uint64) * np.uint64(1 << 20))
        else:  # part of a very long text: the surrounding is read from the whole of it
            around = np.array([_surrounding(texts[first], origin + int(p)) for p in position], dtype=np.uint64)
        out.append((owner + first, position - starts_of[owner] + origin, keys[position], around))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    text, position, key, around = (np.concatenate(c) for c in zip(*out))
    once = np.unique(np.stack([text, position]), axis=1, return_index=True)[1]  # blocks of a long text overlap
    return text[once], position[once], key[once], around[once]


def _surrounding(text: bytes, position: int) -> int:
    lo, hi = max(0, position - BEFORE), min(len(text), position + LENGTH)
    made = _Hashed(text[lo:hi]).part(np.array([0]), np.array([hi - lo]))
    return int(mix(made + np.uint64(position - lo) * np.uint64(1 << 20))[0])


def _runs(texts: list[bytes]):
    """``(first text, texts, offset, whole)``: short texts together, long ones in overlapping blocks."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        if len(text) > BLOCK:
            if run:
                yield first, run, 0, True
            for at in range(0, len(text) - LENGTH + 1, BLOCK):
                yield i, [text[at:at + BLOCK + LENGTH - 1]], at, False
            first, run, size = i + 1, [], 0
            continue
        if size + len(text) > BLOCK:
            yield first, run, 0, True
            first, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run, 0, True


def _sample_rows(texts: DataFrame, positions: bool) -> DataFrame:
    """Sampled positions of ``(tk, text)`` rows: ``tk, key, n`` per text and key, or one row each with ``pos, around``."""
    schema = "tk long, key long, pos long, around long" if positions else "tk long, key long, n long"

    def run(batches):
        seen: set[int] = set()  # equal texts of one task are taken once
        for batch in batches:
            for first, own in pieces(batch, "text"):
                tk = batch.column(0).slice(first, len(own)).to_numpy()
                fresh = []
                for i, t in enumerate(tk.tolist()):
                    if t not in seen:
                        seen.add(t)
                        fresh.append(i)
                text, pos, key, around = samples([own[i] for i in fresh])
                tk = tk[np.array(fresh, dtype=np.int64)][text] if len(text) else tk[:0]
                if positions:
                    columns = [tk, key.view(np.int64), pos, around.view(np.int64)]
                else:
                    pairs, n = np.unique(np.stack([tk, key.view(np.int64)]), axis=1, return_counts=True)
                    columns = [pairs[0], pairs[1], n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                 names=[c.split()[0] for c in schema.split(", ")])

    return texts.select("tk", "text").mapInArrow(run, schema)


def _contexts(joined: DataFrame) -> DataFrame:
    """``key, around, before, context`` of the listed positions (column ``spots``) of each text."""

    def run(batch: pa.RecordBatch):
        for text, spots in zip(batch.column(0), batch.column(1)):
            data, rows = text.as_py(), []
            for s in spots.as_py():
                lo = max(0, s["pos"] - BEFORE)
                rows.append((s["key"], s["around"], s["pos"] - lo, data[lo:s["pos"] + LENGTH]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.binary()])],
                names=["key", "around", "before", "context"])

    chosen = joined.select(F.col("text").cast("binary").alias("text"), "spots")
    return map_batches(chosen, run, "key long, around long, before int, context binary")


def _order(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows within their groups, and the common prefix with the row before (-1: another group)."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.lexsort([*(words[:, j] for j in range(words.shape[1] - 1, -1, -1)), group])
    differs = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    common[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate([[-1], common])


def repeated_offsets(group: np.ndarray, before: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For each context, by offset d: whether the window that starts d bytes before the key occurs twice in its group."""
    m = len(contexts)
    after = np.zeros((m, LENGTH), dtype=np.uint8)
    ahead = np.zeros((m, -(-BEFORE // 8) * 8), dtype=np.uint8)
    n_after = np.array([len(c) for c in contexts]) - before
    for i, c in enumerate(contexts):
        data = np.frombuffer(c, dtype=np.uint8)
        b = int(before[i])
        after[i, : len(data) - b] = data[b:]
        ahead[i, :b] = data[:b][::-1]
    (order_a, common_a), (order_b, common_b) = _order(group, after), _order(group, ahead)
    flags = np.zeros((m, BEFORE + 1), dtype=bool)
    rank_a, rank_b = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for d in range(BEFORE + 1):
        valid = np.flatnonzero((before >= d) & (n_after >= LENGTH - d))
        if len(valid) < 2:
            continue
        rank_a[order_a] = np.cumsum(common_a < LENGTH - d)
        rank_b[order_b] = np.cumsum(common_b < d)
        both = rank_a[valid] * (m + 1) + rank_b[valid]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        flags[valid[order[1:][same]], d] = True
        flags[valid[order[:-1][same]], d] = True
    return flags


def _masks_of_buckets(contexts: DataFrame) -> DataFrame:
    """``key, around, mask`` for buckets of a bounded size; bit d of the mask is offset d."""

    def solve(rows: pa.Table):
        key = rows.column("key").to_numpy()
        group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        flags = repeated_offsets(group, rows.column("before").to_numpy().astype(np.int64),
                                 rows.column("context").to_pylist())
        hit = np.flatnonzero(flags.any(axis=1))
        masks = [np.packbits(flags[i], bitorder="little").tobytes() for i in hit]
        return pa.RecordBatch.from_arrays(
            [pa.array(key[hit]), pa.array(rows.column("around").to_numpy()[hit]), pa.array(masks, pa.binary())],
            names=["key", "around", "mask"])

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows come sorted by key; the last bucket may go on in the next batch
        for batch in batches:
            for at in range(0, batch.num_rows, 2 * BUCKET):
                held.append(batch.slice(at, 2 * BUCKET))
                rows = pa.Table.from_batches(held).combine_chunks()
                key = rows.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut and rows.num_rows >= BUCKET:
                    yield solve(rows.slice(0, cut))
                    rows = rows.slice(cut).combine_chunks()
                held = rows.to_batches()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    spread = contexts.repartition("key").sortWithinPartitions("key")
    return spread.mapInArrow(run, "key long, around long, mask binary")


def _masks_by_windows(contexts: DataFrame) -> DataFrame:
    """The same for larger buckets: every window as a hash, counted in a distributed way."""

    def windows(batch: pa.RecordBatch):
        for key, around, before, context in zip(*(c.to_pylist() for c in batch.columns)):
            start = np.arange(max(0, len(context) - LENGTH + 1))
            start = start[(before - start >= 0) & (before - start <= BEFORE)]
            h = _Hashed(context).part(start, start + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(start), key)), pa.array(np.full(len(start), around)),
                 pa.array((before - start).astype(np.int32)), pa.array(h.view(np.int64))],
                names=["key", "around", "d", "h"])

    rows = map_batches(contexts.select("key", "around", "before", "context"), windows,
                       "key long, around long, d int, h long")
    again = rows.groupBy("key", "d", "h").count().filter("count > 1").drop("count")
    found = rows.join(again, ["key", "d", "h"], "left_semi").groupBy("key", "around").agg(F.collect_set("d").alias("ds"))

    def pack(batch: pa.RecordBatch):
        out = []
        for ds in batch.column(2).to_pylist():
            flags = np.zeros(BEFORE + 1, dtype=bool)
            flags[ds] = True
            out.append(np.packbits(flags, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                         names=["key", "around", "mask"])

    return map_batches(found, pack, "key long, around long, mask binary")


def _cut(joined: DataFrame) -> DataFrame:
    """``tk, n_removed, n_spans, kept_sha256`` of texts with the repeated windows listed in ``spots``."""

    def run(batch: pa.RecordBatch):
        out = []
        for tk, text, spots in zip(*(batch.column(i) for i in range(3))):
            data = np.frombuffer(text.as_py(), dtype=np.uint8)
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            for s in spots.as_py():
                flags = np.ones(BEFORE + 1, bool) if s["mask"] is None else np.unpackbits(
                    np.frombuffer(s["mask"], np.uint8), bitorder="little")[: BEFORE + 1].astype(bool)
                start = s["pos"] - np.flatnonzero(flags)
                start = start[(start >= 0) & (start + LENGTH <= len(data))]
                edge[start] += 1
                edge[start + LENGTH] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1))
            out.append((tk.as_py(), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                         names=["tk", "n_removed", "n_spans", "kept_sha256"])

    chosen = joined.select("tk", F.col("text").cast("binary").alias("text"), "spots")
    return map_batches(chosen, run, "tk long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text"))
    long = named.filter(F.octet_length("text") >= LENGTH).select("tk", "text")

    # Keys that occur again, and the texts that hold one.
    keys = _sample_rows(long, positions=False)
    again = keys.groupBy("key").agg(F.min("tk").alias("lo"), F.max("tk").alias("hi"), F.max("n").alias("n"))
    again = materialize(again.filter("lo <> hi or n > 1").select("key"), "repeated-keys")
    holders = materialize(semi_join(keys, again, "key").select("tk").distinct(), "texts-with-repeats")
    texts = materialize(semi_join(long, holders, "tk").groupBy("tk").agg(F.first("text").alias("text")), "repeated-texts")

    # Their sampled positions, the different surroundings of each key.
    hits = materialize(semi_join(_sample_rows(texts, positions=True), again, "key"), "sampled-suffixes")
    arounds = hits.groupBy("key", "around").agg(F.count(F.lit(1)).alias("n"))
    sizes = arounds.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    arounds = materialize(arounds.join(sizes, "key"), "surroundings")
    first = hits.join(arounds.filter("m > 1"), ["key", "around"])
    # One occurrence of each surrounding stands for all of them.
    stands = first.groupBy("key", "around").agg(F.min(F.struct("tk", "pos")).alias("at")).select(
        "at.tk", F.struct("key", "around", "at.pos").alias("spot"))
    lists = stands.groupBy("tk").agg(F.collect_list("spot").alias("spots"))
    contexts = materialize(_contexts(texts.join(lists, "tk")).join(arounds.select("key", "around", "m"),
                                                                   ["key", "around"]), "contexts")
    masks = _masks_of_buckets(contexts.filter(F.col("m") <= bucket).drop("m"))
    if not (large := contexts.filter(F.col("m") > bucket)).isEmpty():
        masks = masks.unionByName(_masks_by_windows(large.drop("m")))
    masks = materialize(masks, "repeated-windows")

    # All windows of a surrounding that occurs twice are repeated; the others as their bucket says.
    judged = hits.join(arounds, ["key", "around"]).join(masks, ["key", "around"], "left").filter(
        "n > 1 or mask is not null")
    spots = judged.groupBy("tk").agg(F.collect_list(F.struct(
        "pos", F.when(F.col("n") == 1, F.col("mask")).alias("mask"))).alias("spots"))
    cut = _cut(texts.join(spots, "tk"))

    rows = materialize(named.select("doc_id", "tk", F.octet_length("text").cast("long").alias("n_bytes"),
                                    F.sha2("text", 256).alias("sha")), "text-sizes")
    copies = rows.groupBy("tk").agg(F.count(F.lit(1)).alias("c"), F.first("n_bytes").alias("n"), F.first("sha").alias("s"))
    whole = (F.col("c") > 1) & (F.col("n") >= LENGTH)
    per_text = copies.join(cut, "tk", "left").select(
        "tk", F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "s")).alias("kept_sha256"))
    return rows.join(per_text, "tk").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_blockwise_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
