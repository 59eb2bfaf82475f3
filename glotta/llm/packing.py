"""Best-fit packing with Martello-Toth dominance reduction.

Token lengths are whole numbers up to the capacity, so a packing is decided on
the histogram of lengths alone: at most CAPACITY counts reach the driver,
whatever the number of documents. There

1. the reduction fixes bins that provably dominate all others with their largest
   item: an item nothing fits beside; an exact pair; where at most one more item
   fits, the largest that does; where at most two fit, the best pair or triple,
2. what is left is packed best-fit decreasing, many equal items at a time.

Both give patterns (runs of equal lengths) with a number of sequences each. The
pieces of one length are numbered 0, 1, 2 ... without gaps, and each number has
its place in some pattern. Only piece rows are shuffled, never texts or ids.

Defined results: a null text is empty and is packed as the separator alone, a
text of more than CAPACITY ids (separator included) is cut into CAPACITY-id
pieces and a shorter last one, repeated rows are packed as often as they come,
null ids are carried, other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, materialize, pieces, table

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS, CACHED_PARTS = 1_000_000, 800_000  # whose ids a worker keeps, some 360 MB
BLOCK_BYTES = 1 << 20

# How the vocabulary's pre-tokenizer cuts lower-cased text, and white space between words.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LOOSE = re.compile(rb"(?<=[a-z])([.,])(?=[\x20\n])")
LAST_LATIN = "\u024f"


class _Ids:
    """Ids of words, as little-endian unsigned 32-bit numbers.

    Pre-tokens never reach across ASCII white space, so the ids of a text are
    those of its words in turn. Printable Latin words are cut into pre-tokens
    here, since far fewer of those are new; what is new in a block is encoded in
    one call. All other words go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        made = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        owner = np.array(made.word_ids, dtype=np.int64)
        if not len(owner) or owner[-1] + 1 != len(parts):  # not one pre-token each: ask for each
            self.parts.update((part, self._encode(part)) for part in parts)
            return
        data = np.array(made.ids, dtype="<u4").tobytes()
        ends = np.searchsorted(owner, np.arange(len(parts)), side="right") * 4
        start = 0
        for part, end in zip(parts, ends.tolist()):
            self.parts[part] = data[start:end]
            start = end

    def learn(self, words: set[bytes]) -> None:
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        whole: dict[bytes, str] = {}
        cut: dict[bytes, list[str]] = {}
        for word in words.difference(self.words):
            text = word.decode("utf-8", "replace").lower()
            if text.isalpha() and max(text) <= LAST_LATIN:
                whole[word] = text
            elif b"<|" in word or not text.isprintable() or max(text) > LAST_LATIN:
                self.words[word] = self._encode(word.decode("utf-8", "replace"))
            else:
                cut[word] = PRE_TOKEN.findall(text)
        unknown = {part for parts in cut.values() for part in parts}
        unknown.update(whole.values())
        unknown.difference_update(self.parts)
        if unknown:
            self._learn_parts(list(unknown))
        for word, part in whole.items():
            self.words[word] = self.parts[part]
        for word, parts in cut.items():
            self.words[word] = b"".join(map(self.parts.__getitem__, parts))

    def of(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.words.__getitem__, words))


def _plain(text: bytes) -> bytes:
    """A text of the same ids with fewer different words.

    The vocabulary is lower-case, and a full stop or comma between a letter and
    white space is a pre-token of its own. Texts that might spell a special
    token stay as they are.
    """
    return text if b"<|" in text else LOOSE.sub(rb" \1", text.lower())


def _blocks(text: bytes) -> list[bytes]:
    """A long text in blocks that end at white space."""
    out, start = [], 0
    while len(text) - start > BLOCK_BYTES:
        found = SPACE.search(text, start + BLOCK_BYTES)
        end = found.end() if found else len(text)
        out.append(text[start:end])
        start = end
    return out + [text[start:]]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 vocabulary: str | None = None) -> DataFrame:
    """One row per piece; ``local`` numbers the pieces of one length within the partition ``part``."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Empty when sent; a worker keeps its tokenizer and the ids of words there from task to task.
    kept = docs.sparkSession.sparkContext.broadcast({})
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, local long"

    def run(batches):
        import public_tokenizers

        path = vocabulary or public_tokenizers.path(VOCABULARY)
        if path not in kept.value:
            kept.value[path] = _Ids(path)
        ids = kept.value[path]
        end = np.array([SEPARATOR], dtype="<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for first, texts in pieces(batch, "text", BLOCK_BYTES):
                split = [[block.split() for block in _blocks(_plain(text))] for text in texts]
                if len(texts) > 1:
                    ids.learn({word for blocks in split for words in blocks for word in words})
                for i, blocks in enumerate(split, first):
                    data, k = b"", 0
                    for words in blocks:
                        if len(texts) == 1:
                            ids.learn(set(words))
                        data += ids.of(words)
                        while len(data) >= 4 * capacity:  # the separator is still to come
                            rows.append((i, k, k * capacity, capacity, zlib.crc32(data[:4 * capacity]), seen[capacity]))
                            seen[capacity] += 1
                            data, k = data[4 * capacity:], k + 1
                    data += end
                    rows.append((i, k, k * capacity, len(data) // 4, zlib.crc32(data), seen[len(data) // 4]))
                    seen[len(data) // 4] += 1
            if rows:
                i, k, start, n, crc, local = (np.array(c, dtype=np.int64) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(i)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(n),
                     pa.array(crc), pa.array(np.full(len(n), part)), pa.array(local)],
                    names=[c.split()[0] for c in schema.split(", ")])

    return chosen.mapInArrow(run, schema)


class _Counts:
    """A multiset of lengths."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v}
        self.keys = sorted(self.n)

    def take(self, length: int, k: int = 1) -> None:
        self.n[length] -= k
        if not self.n[length]:
            del self.n[length]
            self.keys.pop(bisect_left(self.keys, length))

    def put(self, length: int, k: int = 1) -> None:
        if length not in self.n:
            insort(self.keys, length)
        self.n[length] = self.n.get(length, 0) + k

    def smallest(self, k: int, above: int = 0) -> list[int]:
        out: list[int] = []
        for length in self.keys[bisect_right(self.keys, above):]:
            out += [length] * min(k - len(out), self.n[length])
            if len(out) == k:
                break
        return out

    def largest_up_to(self, room: int) -> int | None:
        i = bisect_right(self.keys, room)
        return self.keys[i - 1] if i else None


def _best_pair(left: _Counts, room: int) -> tuple[int, int] | None:
    """Two lengths of the largest sum up to ``room``, the larger first."""
    best = None
    for a in reversed(left.keys[: bisect_right(left.keys, room)]):
        if 2 * a < (sum(best) if best else 0):
            break
        b = left.largest_up_to(min(a, room - a))
        if b == a and left.n[a] < 2:
            i = bisect_left(left.keys, a)
            b = left.keys[i - 1] if i else None
        if b is not None and (best is None or a + b > sum(best)):
            best = a, b
    return best


def _dominating(length: int, left: _Counts, capacity: int) -> list[int] | None:
    """Companions that dominate all others for an item of ``length``, already taken from ``left``; None: undecided."""
    room = capacity - length
    fit, total = 0, 0
    for small in left.smallest(3):
        total += small
        if total > room:
            break
        fit += 1
    if fit == 0:
        return []
    one = left.largest_up_to(room)
    if fit == 1 or one == room:
        return [one]
    if fit == 2:
        a, b = _best_pair(left, room)
        if one >= a + b:
            return [one]
        # No single companion beats a; of two, the smaller is at most b unless two items above b fit together.
        above = left.smallest(2, above=b)
        if one == a and (len(above) < 2 or sum(above) > room):
            return [a, b]
    return None


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, how many), ...], sequences)`` that use up ``counts``."""
    left = _Counts(counts)
    patterns: list[tuple[list[tuple[int, int]], int]] = []
    for length in sorted(left.n, reverse=True):  # the reduction, from the largest down
        while length in left.n:
            left.take(length)
            found = _dominating(length, left, capacity)
            left.put(length)
            if found is None:
                break
            bin_ = sorted([length, *found], reverse=True)
            runs = [(x, bin_.count(x)) for x in dict.fromkeys(bin_)]
            # A repeat is as good as the first while the lengths it rests on are there; small sets are taken singly.
            exact = sum(bin_) == capacity or not found
            times = min(left.n[x] // k for x, k in runs) if exact else 1
            for x, k in runs:
                left.take(x, times * k)
            patterns.append((runs, times))
    bins: dict[int, list] = {}  # free room -> patterns with a number of sequences
    rooms: list[int] = []

    def keep(room: int, runs: list, times: int) -> None:
        if room not in bins:
            insort(rooms, room)
        bins.setdefault(room, []).append((runs, times))

    for length in reversed(left.keys):
        n = left.n[length]
        while n:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                runs, times = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(i)
            else:
                room, runs, times = capacity, [], -(-n // (capacity // length))
            each = room // length
            full = min(times, n // each)
            if full:
                keep(room - each * length, runs + [(length, each)], full)
            n -= full * each
            if full < times and n:
                keep(room - n * length, runs + [(length, n)], 1)
                full, n = full + 1, 0
            if full < times and runs:
                keep(room, runs, times - full)
    return _merged(patterns + [p for found in bins.values() for p in found])


def _merged(patterns: list) -> list:
    total: dict[tuple, int] = {}
    for runs, times in patterns:
        total[tuple(runs)] = total.get(tuple(runs), 0) + times
    return [(list(runs), times) for runs, times in total.items()]


def _places(patterns: list) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: the first number of each run of places, its first sequence, places a sequence, first offset."""
    out: dict[int, list] = {}
    base = 0
    for runs, times in patterns:
        offset = 0
        for length, each in runs:
            rows = out.setdefault(length, [])
            first = rows[-1][0] + rows[-1][4] if rows else 0
            rows.append((first, base, each, offset, each * times))
            offset += length * each
        base += times
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for k, rows in out.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    rows = materialize(token_pieces(docs, id_col, text_col, capacity, vocabulary), "pieces")
    # The table is written, so numbers within a partition stay what they are.
    by_part = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(pack_counts(counts, capacity))

    def run(batch: pa.RecordBatch):
        length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            first, base, each, start, _ = places[int(length[own[0]])]
            at = np.searchsorted(first, number[own], side="right") - 1
            local = number[own] - first[at]
            sequence[own] = base[at] + local // each[at]
            offset[own] = start[at] + local % each[at] * length[own]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                         names=[*batch.schema.names[:5], "sequence_id", "offset"])

    numbered = rows.join(by_part, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("number"))
    return map_batches(numbered, run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                      "sequence_id long, offset long")


def op8_reduced_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
