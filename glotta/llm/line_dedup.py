"""Line dedup by a segment-partition edit join.

Lines are compared as UTF-8 bytes without white space at either end. Two lines
of at least MIN_BYTES are linked if their edit distance is at most TAU; shorter
ones only if they are equal. The join follows Pass-Join: a line is split into
TAU + 1 segments, of which TAU edits leave at least one whole, so one of the two
lines (the shorter) is indexed by (length, segment number, segment) and the
other probes, for each length it may match, only the substrings that the
multi-match-aware bounds leave. Candidates are verified with the banded
bit-parallel edit distance, many pairs at once.

What is shuffled for the search is a hash of the segment and a 64-bit sketch of
the line, the parities of its hashed bigrams. An edit changes at most four
bigrams, so sketches of linked lines differ in at most 4 * TAU bits; the join
tests that at once, and within a segment shared by very many lines next to
nothing else comes out. Texts are read again for the candidates alone.

Linked lines form classes. The first line of a class, by id and place, stays,
the others go.

Defined results: null and empty texts have no lines, lines without a word are
kept and belong to no class, a null id comes after all others, rows equal in id
and text stand for each other and keep the same lines, other columns are
carried by ``drop_repeated_lines``, an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import connected_components, map_batches, materialize, pieces, semi_join, table
from glotta.llm.words import _BASE_INVERSE, mix, powers

TAU = 2
MIN_BYTES = 20
BLANK = b" \t\r\x0b\x0c"


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, line_no, line)`` of every line with a word; key tells texts of one id apart."""
    # The key is made below the generator, so once per text and not once per line.
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"),
                         F.col(text_col).alias("text"))
    lines = chosen.select("id", "key", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.withColumn("line", F.trim("line", F.lit(BLANK.decode()))).filter("line <> ''")


class _Lines:
    """Lines laid end to end, with prefix sums for the hash of any part."""

    def __init__(self, lines: list[bytes]):
        self.n = np.fromiter(map(len, lines), np.int64, len(lines))
        self.at = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64)
        self.buf = np.frombuffer(b"".join(lines), dtype=np.uint8)
        self.prefix = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * powers(len(self.buf)), out=self.prefix[1:])
        self.back = powers(len(self.buf) + 1, _BASE_INVERSE)

    def part(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.back[start]

    def sketches(self) -> np.ndarray:
        """Bit b is the parity of the number of bigrams that hash to b."""
        last = np.zeros(len(self.buf), dtype=bool)
        last[self.at + self.n - 1] = True
        first = np.flatnonzero(~last)
        bigram = self.buf[first].astype(np.uint32) << np.uint32(8) | self.buf[first + 1]
        bits = np.uint64(1) << _BIGRAM_BIT[bigram].astype(np.uint64)
        running = np.zeros(len(first) + 1, dtype=np.uint64)
        np.bitwise_xor.accumulate(bits, out=running[1:])
        ends = np.searchsorted(first, self.at + self.n - 1)
        starts = np.searchsorted(first, self.at)
        return running[ends] ^ running[starts]


_BIGRAM_BIT = (mix(np.arange(1 << 16, dtype=np.uint64), 5) >> np.uint64(58)).astype(np.uint8)


def _segments(n: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of each of the tau + 1 segments of lines of n bytes; the longer ones come last."""
    short, longer = n // (tau + 1), n % (tau + 1)
    out, at = [], np.zeros_like(n)
    for i in range(tau + 1):
        size = short + (i > tau - longer)
        out.append((at, size))
        at = at + size
    return out


def _signature(part: np.ndarray, length: np.ndarray, segment: int) -> np.ndarray:
    return mix(part + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), segment + 1)


def index_signatures(lines: _Lines, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line, signature)`` of the segments of each line."""
    found = [_signature(lines.part(lines.at + start, size), lines.n, i)
             for i, (start, size) in enumerate(_segments(lines.n, tau))]
    return np.tile(np.arange(len(lines.n)), len(found)), np.concatenate(found)


def probe_signatures(lines: _Lines, tau: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line, signature)`` of the substrings of each line that may equal a segment of a line up to tau shorter."""
    owners, found = [], []
    for delta in range(tau + 1):
        length = lines.n - delta
        for i, (start, size) in enumerate(_segments(length, tau)):
            low = np.maximum(start - i, start + delta - (tau - i))
            high = np.minimum(start + i, start + delta + (tau - i))
            for shift in range(-tau, tau + delta + 1):
                at = start + shift
                ok = np.flatnonzero((at >= low) & (at <= high) & (at >= 0) & (at + size <= lines.n)
                                    & (length >= shortest))
                owners.append(ok)
                found.append(_signature(lines.part(lines.at[ok] + at[ok], size[ok]), length[ok], i))
    return np.concatenate(owners), np.concatenate(found)


def _signature_rows(docs: DataFrame, text_col: str, probe: bool, tau: int, shortest: int) -> DataFrame:
    """``(signature, sketch)`` rows; a line is taken once per batch of texts."""

    def run(batch: pa.RecordBatch):
        for _, texts in pieces(batch, "text"):
            own = {line.strip(BLANK) for t in texts for line in t.split(b"\n")}
            own = [line for line in own if len(line) >= shortest]
            if own:
                lines = _Lines(own)
                owner, signature = (probe_signatures(lines, tau, shortest) if probe
                                    else index_signatures(lines, tau))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature.view(np.int64)), pa.array(lines.sketches()[owner].view(np.int64))],
                    names=["signature", "sketch"])

    return map_batches(docs.select(F.col(text_col).alias("text")), run, "signature long, sketch long")


def within(pairs: list[tuple[bytes, bytes]], tau: int) -> np.ndarray:
    """Whether each pair is within ``tau`` edits, by the banded bit-parallel method, for all pairs side by side."""
    if not pairs:
        return np.empty(0, dtype=bool)
    longer = [max(p, key=len) for p in pairs]
    shorter = [p[1] if long is p[0] else p[0] for p, long in zip(pairs, longer)]
    n1, n2 = (np.fromiter(map(len, x), np.int64, len(pairs)) for x in (longer, shorter))
    pad = b"\0" * (tau + 1)
    # Positions outside a line compare as different: numbers above a byte mark the padding.
    flat1 = np.frombuffer(b"".join(pad + x + pad for x in longer), np.uint8).astype(np.int16)
    at1 = np.concatenate([[0], np.cumsum(n1 + 2 * tau + 2)[:-1]]) + tau + 1
    flat2 = np.frombuffer(b"".join(shorter) + b"\0", np.uint8).astype(np.int16)
    at2 = np.concatenate([[0], np.cumsum(n2)[:-1]])
    one = np.uint64(1)
    # The top tau + 1 bits are the part of the band below the first diagonal.
    vp = np.full(len(pairs), (2**64 - 1) << (63 - tau) & (2**64 - 1), dtype=np.uint64)
    vn = np.zeros(len(pairs), dtype=np.uint64)
    distance = np.full(len(pairs), tau, dtype=np.int64)
    column = np.full(len(pairs), 62, dtype=np.uint64)
    live = np.flatnonzero(n1 - n2 <= tau)
    distance[n1 - n2 > tau] = tau + 1
    for i in range(int(n2.max(initial=0))):
        live = live[n2[live] > i]
        if not len(live):
            break
        p, char = live, flat2[at2[live] + i]
        equal = np.zeros(len(p), dtype=np.uint64)
        for d in range(-tau, tau + 1):
            inside = (i + d >= 0) & (i + d < n1[p])
            # Far behind the end of a line the index is held at its padding.
            here = flat1[at1[p] + np.minimum(i + d, n1[p])]
            equal |= ((here == char) & inside).astype(np.uint64) << np.uint64(63 - tau + d)
        v, m = vp[p], vn[p]
        d0 = (((equal & v) + v) ^ v) | equal | m
        hp, hn = m | ~(d0 | v), d0 & v
        diagonal = i < n1[p] - tau
        across = column[p]
        step = np.where(diagonal, 1 - (d0 >> np.uint64(63)).astype(np.int64),
                        (hp >> across & one).astype(np.int64) - (hn >> across & one).astype(np.int64))
        distance[p] += step
        column[p] = np.where(diagonal, across, across - one)
        vp[p], vn[p] = hn | ~(d0 >> one | hp), d0 >> one & hp
    return distance <= tau


def line_links(docs: DataFrame, text_col: str = "text", tau: int = TAU, shortest: int = MIN_BYTES) -> DataFrame:
    """``(a, b)``: hashes of all pairs of different lines within ``tau`` edits, the smaller first."""
    index = _signature_rows(docs, text_col, False, tau, shortest).withColumnRenamed("sketch", "other")
    probe = _signature_rows(docs, text_col, True, tau, shortest)
    near = F.bit_count(F.col("sketch").bitwiseXOR(F.col("other"))) <= 4 * tau
    # Spread by signature first: each side then drops its repeats and is joined without a further shuffle.
    met = (index.repartition("signature").dropDuplicates(["signature", "other"])
           .join(probe.repartition("signature").dropDuplicates(["signature", "sketch"]), "signature")
           .filter(near & (F.col("sketch") != F.col("other"))))
    met = met.select(F.least("sketch", "other").alias("s1"), F.greatest("sketch", "other").alias("s2")).distinct()

    def sketched(batch: pa.RecordBatch):
        for _, texts in pieces(batch, "text"):
            own = {line.strip(BLANK) for t in texts for line in t.split(b"\n")}
            own = [line for line in own if len(line) >= shortest]
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_Lines(own).sketches().view(np.int64)), pa.array(own, pa.binary()).cast(pa.string())],
                    names=["sketch", "line"])

    lines = map_batches(docs.select(F.col(text_col).alias("text")), sketched, "sketch long, line string")
    hashed = lines.select("sketch", F.xxhash64("line").alias("h"))
    # Different lines of one sketch are candidates too.
    shared = hashed.groupBy("sketch").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo < hi")
    met = materialize(met.unionByName(shared.select(F.col("sketch").alias("s1"), F.col("sketch").alias("s2"))), "met")
    wanted = met.select(F.col("s1").alias("sketch")).unionByName(met.select(F.col("s2").alias("sketch"))).distinct()
    texts = semi_join(lines, materialize(wanted, "met-sketches"), "sketch").select("sketch", F.xxhash64("line").alias("h"), "line")
    texts = materialize(texts.dropDuplicates(["sketch", "h"]), "candidate-lines")
    one = texts.select(F.col("sketch").alias("s1"), F.col("h").alias("h1"), F.col("line").alias("l1"))
    two = texts.select(F.col("sketch").alias("s2"), F.col("h").alias("h2"), F.col("line").alias("l2"))
    pairs = met.join(one, "s1").join(two, "s2").filter(
        ((F.col("s1") != F.col("s2")) | (F.col("h1") < F.col("h2")))
        & (F.abs(F.octet_length("l1") - F.octet_length("l2")) <= tau))

    def verify(batch: pa.RecordBatch):
        size = pa.compute.binary_length(batch.column(2).cast(pa.binary())).to_numpy(zero_copy_only=False)
        order = np.argsort(size, kind="stable")
        keep = np.zeros(batch.num_rows, dtype=bool)
        for own in np.array_split(order, -(-len(order) // 2048)):
            rows = batch.take(pa.array(own))
            keep[own] = within(list(zip(rows.column(2).cast(pa.binary()).to_pylist(),
                                        rows.column(3).cast(pa.binary()).to_pylist())), tau)
        yield batch.select([0, 1]).filter(pa.array(keep))

    found = map_batches(pairs.select("h1", "h2", "l1", "l2"), verify, "h1 long, h2 long")
    return found.select(F.least("h1", "h2").alias("a"), F.greatest("h1", "h2").alias("b")).distinct()


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
                 shortest: int = MIN_BYTES) -> DataFrame:
    """``(id, key, line_no, class_id, class_line_no, n_links, kept)`` of every line with a word.

    The class is named by the id and place of its first line; ``n_links`` counts
    the different lines within ``tau`` edits of this one.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialize(lines_of(own).select("id", "key", "line_no", F.xxhash64("line").alias("h")), "lines")
    edges = materialize(line_links(own, "text", tau, shortest), "line-links")
    roots = connected_components(edges).withColumnRenamed("node", "h")
    ends = edges.select(F.col("a").alias("h")).unionByName(edges.select(F.col("b").alias("h")))
    degree = ends.groupBy("h").agg(F.count(F.lit(1)).alias("n_links"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "line_no")
    firsts = rows.groupBy("h").agg(F.min(place).alias("first"))
    placed = firsts.join(roots, "h", "left").select("h", "first", F.coalesce("root", "h").alias("root"))
    classes = placed.groupBy("root").agg(F.min("first").alias("first"))
    named = (placed.drop("first").join(classes, "root").join(degree, "h", "left")
             .select("h", "first", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    return rows.join(named, "h").select(
        "id", "key", "line_no", F.col("first.id").alias("class_id"), F.col("first.line_no").alias("class_line_no"),
        "n_links", (F.struct(F.col("id").isNull().alias("none"), "id", "key", "line_no") == F.col("first"))
        .alias("kept"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
                        shortest: int = MIN_BYTES) -> DataFrame:
    """The documents, with all their columns, without lines that repeat an earlier one.

    A document of which every line with a word goes, goes itself: it holds
    nothing that is not elsewhere.
    """
    rows = line_classes(docs, id_col, text_col, tau, shortest)
    gone = (rows.filter("not kept").groupBy(F.col("key").alias("__key"))
            .agg(F.collect_set("line_no").alias("__gone")))
    keyed = docs.withColumn("__key", F.xxhash64(id_col, text_col)).join(gone, "__key", "left").drop("__key")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batch: pa.RecordBatch):
        drops, texts, whole = batch.column(batch.num_columns - 1), batch.column(at), np.ones(batch.num_rows, dtype=bool)
        out = []
        for i, drop in enumerate(drops):
            text = texts[i].as_py()
            if drop.is_valid:
                out_of = set(drop.as_py())
                left = [x for n, x in enumerate(text.split("\n")) if n not in out_of]
                text = "\n".join(left)
                whole[i] = bool(text.strip(BLANK.decode() + "\n"))
            out.append(text)
        columns = [batch.column(j) if j != at else pa.array(out, pa.string()) for j in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(whole))

    return map_batches(keyed, run, docs.schema)


def op10_segment_line_join(spark, sf_dir: str) -> DataFrame:
    rows = line_classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "line_no", F.col("class_id").alias("class_doc_id"),
                       "class_line_no", "n_links", "kept")
