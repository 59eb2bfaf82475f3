"""Personal data: candidate spans scored by gradient-boosted trees.

Four kinds have base rules, whose spans always stay. High-recall generators
propose further, overlapping spans: all runs of digit groups with loose
separators, addresses spelled with "at" and "dot" or without a last label,
colon-separated hexadecimal groups. Each candidate is described by its format
and its context. Boosted trees are trained on all candidates that the base rules
decide, in tasks of TASK_ROWS: matches of a rule are positive, the look-alikes
that fail its check are negative; a class weighs TRAIN_ROWS / 2 at most. Every positive is also shown with the sign
that its rule rests on hidden (the plus of a phone number, the at-sign), so that
the trees learn the rest of its format and its context. On a held-out part,
its positives without their signs, the threshold of each kind is set at the
least score, in steps of 1 / STEPS, with a precision of PRECISION. What passes and overlaps neither a base span nor a better
candidate is added.

Defined results: a null text is empty, null ids are carried, repeated rows give
a row each, other columns are carried by ``redact`` and not read by ``find``,
without examples of both classes only base spans are returned, an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, materialize, table

TRAIN_ROWS = 20_000
TASK_ROWS = 100_000
STEPS = 10_000
TREES, DEPTH = 15, 3
PRECISION = 0.98
LEAST_HELD_OUT = 20
MOST_DIGITS = 19
CHUNK = 4096  # candidates in a row of the scan
SEED = 7

# The kinds in their order, and the patterns of their base rules.
KINDS = ["email", "ip", "card", "phone"]
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGITS = re.compile(r"[0-9]+")
GAP = re.compile(r"[\x20().+/-]{1,3}")
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]? ?\b(?:at|AT)\b ?[\])]? ?[A-Za-z0-9-]{1,63}"
                     r"(?: ?[\[(]? ?\b(?:dot|DOT)\b ?[\])]? ?[A-Za-z0-9-]{1,63}){1,4}")
BARE = re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}")
HEX = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
CUE = re.compile(r"(?i)\b(mail|e-mail|email|contact|write|tel|phone|call|fax|mobile|ip|host|server|address|card|visa|pay)"
                 r"\W{0,3}$")

FEATURES = ["kind_email", "kind_ip", "kind_card", "kind_phone", "length", "digits", "groups", "longest_group",
            "shortest_group", "separators", "distinct_separators", "plus", "parenthesis", "dots", "hyphens", "spaces",
            "colons", "letters", "at_sign", "spelled_at", "luhn", "octets", "joined_before", "joined_after",
            "cue_before", "line_digit_share", "sentence_end_after"]
_HIDE = {"email": ["at_sign"], "ip": [], "card": [], "phone": ["plus"]}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: at each at-sign the longest local part and host."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at) if start < at else None
        if host:
            found.append((start, host.end()))
            end = host.end()
        at = text.find("@", max(at + 1, end))
    return found


def _chains(text: str, runs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Digit groups with short gaps of separators between them."""
    out: list[list[tuple[int, int]]] = []
    for run in runs:
        if out and GAP.fullmatch(text, out[-1][-1][1], run[0]):
            out[-1].append(run)
        else:
            out.append([run])
    return out


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all base spans, sorted."""
    runs = [m.span() for m in DIGITS.finditer(text)] if runs is None else runs
    found = [(s, 0, e) for s, e in _emails(text)]
    i = 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            if all(_octet(text[s:e]) for s, e in four):
                found.append((four[0][0], 1, four[3][1]))
            i += 4
        else:
            i += 1
    if runs:
        for m in CARD.finditer(text):
            digits = re.sub("[ -]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdecimal() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _octet(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _meets(starts: list[int], furthest: list[int], start: int, end: int) -> bool:
    """Whether a span overlaps start..end: one that starts before its end and ends after its start."""
    n = bisect_left(starts, end)
    return n > 0 and furthest[n - 1] > start


def candidates(text: str, runs: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base spans and of everything else that might be personal, sorted."""
    return sorted(proposed(text, runs, base))


def proposed(text: str, runs: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """The candidates one by one, each once: a long table of digits has many more than characters."""
    known = set(base)
    yield from known
    starts, furthest = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    for chain in _chains(text, runs):
        yield from (span for span in _of_chain(text, chain, starts, furthest) if span not in known)
    further = set()
    if "@" in text:
        further.update((m.start(), 0, m.end()) for m in BARE.finditer(text) if not _within(starts, furthest, *m.span()))
    if "dot" in text or "DOT" in text:
        further.update((m.start(), 0, m.end()) for m in SPELLED.finditer(text))
    if text.count(":") > 2:
        further.update((m.start(), 1, m.end()) for m in HEX.finditer(text))
    yield from further - known


def _within(starts: list[int], furthest: list[int], start: int, end: int) -> bool:
    """Whether one base span covers start..end: one that starts no later and ends no earlier."""
    n = bisect_right(starts, start)
    return n > 0 and furthest[n - 1] >= end


def _of_chain(text: str, chain: list[tuple[int, int]], starts: list[int],
              furthest: list[int]) -> Iterator[tuple[int, int, int]]:
    """Every run of groups, at most MOST_DIGITS from each; parts of a base span could never be added."""
    whole = chain[0][0], chain[-1][1]
    for i, (start, _) in enumerate(chain):
        n = 0
        plus = start > 0 and text[start - 1] == "+"
        opened = start > 0 and text[start - 1] == "("
        for s, end in chain[i:i + MOST_DIGITS]:
            n += end - s
            if n > MOST_DIGITS:
                break
            if n < 7 or (start, end) != whole and _meets(starts, furthest, start, end):
                continue
            if n <= 15:
                yield start - (plus or opened), 3, end
            if n >= 12:
                yield start, 2, end
    if len(chain) == 4 and all(text[a[1]:b[0]] == "." for a, b in zip(chain, chain[1:])):
        yield (whole[0], 1, whole[1])


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    start, kind, end = span
    own = text[start:end]
    groups = [len(g) for g in DIGITS.findall(own)]
    digits = "".join(DIGITS.findall(own))
    separators = [c for c in own if not c.isalnum()]
    line_start = max(text.rfind("\n", max(0, start - 200), start) + 1, start - 200)
    line_end = text.find("\n", end, end + 200)
    line = text[line_start:line_end if line_end >= 0 else end + 200]
    octets = [g for g in own.split(".")]
    value = {
        "kind_email": kind == 0, "kind_ip": kind == 1, "kind_card": kind == 2, "kind_phone": kind == 3,
        "length": len(own), "digits": len(digits), "groups": len(groups), "longest_group": max(groups, default=0),
        "shortest_group": min(groups, default=0), "separators": len(separators),
        "distinct_separators": len(set(separators)), "plus": own.startswith("+"), "parenthesis": "(" in own,
        "dots": own.count("."), "hyphens": own.count("-"), "spaces": own.count(" "), "colons": own.count(":"),
        "letters": sum(c.isalpha() for c in own), "at_sign": "@" in own, "spelled_at": " at" in own.lower(),
        "luhn": len(digits) > 1 and luhn(digits),
        "octets": len(octets) == 4 and all(o.isdecimal() and _octet(o) for o in octets),
        "joined_before": start > 0 and text[start - 1].isalnum(),
        "joined_after": end < len(text) and text[end].isalnum(),
        "cue_before": bool(CUE.search(text, max(0, start - 24), start)),
        "line_digit_share": sum(c.isdecimal() for c in line) / max(1, len(line)),
        "sentence_end_after": end >= len(text) or text[end] in ".\n",
    }
    return [float(value[f]) for f in FEATURES]


def label(text: str, span: tuple[int, int, int], base: set[tuple[int, int, int]]) -> int:
    """1: a base span; 0: a look-alike that fails its kind's check; -1: the rules do not say."""
    start, kind, end = span
    if span in base:
        return 1
    own = text[start:end]
    digits = len(re.sub("[^0-9]", "", own))
    if kind == 0:
        return 0 if "@" in own and "." not in own else -1
    if kind == 1:
        return -1 if ":" in own else 0
    if kind == 2:
        return 0
    plain = own.isdecimal()
    taken = any(s <= start and end <= e for s, k, e in base if k != 3)
    return 0 if taken or plain and digits not in (10, 11) or not own.startswith("+") and digits < 9 else -1


def text_of(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


_CANDIDATE = "struct<start:int,kind:int,end:int,label:int,x:array<double>>"
_FOUND = ("row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          f"base array<struct<start:int,kind:int,end:int>>, candidates array<{_CANDIDATE}>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its base spans, and rows with the described candidates, CHUNK at most in each.

    ``row`` tells documents apart; rows of candidates have no base columns.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    span_type = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    candidate_type = pa.struct([*span_type, ("label", pa.int32()), ("x", pa.list_(pa.float64()))])
    types = [pa.int64()] * 6 + [pa.string(), pa.list_(span_type), pa.list_(candidate_type)]
    names = [re.match(r"\w+", c).group() for c in re.split(r", (?=\w+ )", _FOUND)]

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        out, held = [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            for id_, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py() or ""
                runs = [m.span() for m in DIGITS.finditer(text)]
                base = base_spans(text, runs)
                known = set(base)
                n = [sum(b[1] == k for b in base) for k in range(4)]
                out.append((row, id_.as_py(), *n, hashlib.sha256(text_of(base).encode()).hexdigest(),
                            [dict(start=s, kind=k, end=e) for s, k, e in base], None))
                spans = proposed(text, runs, base)
                while chunk := [dict(start=s, kind=k, end=e, label=label(text, (s, k, e), known), x=features(text, (s, k, e)))
                                for s, k, e in islice(spans, CHUNK)]:
                    out.append((row, *[None] * 7, chunk))
                    held += len(chunk)
                    if held >= CHUNK:
                        yield made()
                        out, held = [], 0
                row += 1
                if len(out) >= 1024:
                    yield made()
                    out, held = [], 0
        if out:
            yield made()

    return chosen.mapInArrow(run, _FOUND)


def train(scanned: DataFrame, rows: int = TRAIN_ROWS):
    """The boosted trees and the threshold of each kind, or None if one class is missing.

    From all candidates that the rules decide; a class of more than ``rows / 2`` weighs as much as so many.
    """
    order = F.xxhash64("row", "c.start", "c.kind", "c.end")
    named = scanned.select("row", F.explode("candidates").alias("c")).filter("c.label >= 0")
    labelled = materialize(named.select("c.kind", F.col("c.label").cast("double").alias("label"), "c.x",
                                        (F.pmod(order, F.lit(4)) == 0).alias("held_out")), "pii-labelled")
    known = {int(r.label): r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    hidden = F.transform("x", lambda v, i: F.when(F.array_contains(
        F.element_at(F.array(*[F.array(*[F.lit(FEATURES.index(f)) for f in _HIDE[k]]).cast("array<int>")
                               for k in KINDS]), F.col("kind") + 1), i), 0.0)
                         # Without its plus a phone number is shorter by one separator.
                         .when((F.col("kind") == KINDS.index("phone")) & i.isin(
                             *[FEATURES.index(f) for f in ("length", "separators", "distinct_separators")]), v - 1)
                         .otherwise(v))
    shown = labelled.filter("label = 1 and not held_out").withColumn("x", hidden)
    weights = [min(1.0, rows / 2 / max(1, known.get(c, 0))) for c in (0, 1)]
    weight = F.when(F.col("label") == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
    data = labelled.filter("not held_out").unionByName(shown).withColumn("features", array_to_vector("x"))
    # What is added has no sign: held-out positives are scored without theirs.
    unseen = labelled.filter("held_out").withColumn("x", F.when(F.col("label") == 1, hidden).otherwise(F.col("x")))
    classes = {r.label for r in data.select("label").distinct().collect()}
    if len(classes) < 2:
        return None
    tasks = -(-sum(known.values()) // TASK_ROWS)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False, weightCol="weight").fit(
        data.select("features", "label", weight.alias("weight")).coalesce(tasks))
    # At most STEPS rows of each kind.
    counts = score(unseen, model).groupBy("kind", F.floor(F.col("p") * STEPS).alias("step")).agg(
        F.min("p").alias("p"), F.sum("label").alias("right"), F.sum(1 - F.col("label")).alias("wrong"))
    held = sorted(counts.collect(), key=lambda r: -r.p)
    thresholds = []
    for kind in range(len(KINDS)):
        own = [r for r in held if r.kind == kind]
        best, right, wrong = 0.9, 0.0, 0.0
        if sum(r.right + r.wrong for r in own) >= LEAST_HELD_OUT:
            best = 1.1
            for r in own:
                right += r.right
                wrong += r.wrong
                if right >= PRECISION * (right + wrong):
                    best = r.p
        thresholds.append(max(best, 0.5))
    return model, thresholds


def score(rows: DataFrame, model) -> DataFrame:
    made = model.transform(rows.withColumn("features", array_to_vector("x")))
    return made.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability",
                                                                         "prediction")


def _chosen(base: list[dict], scored: list[dict]) -> list[tuple[int, int, int]]:
    spans = sorted((b["start"], b["kind"], b["end"]) for b in base)
    starts, furthest = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
    added: list[tuple[int, int, int]] = []  # disjoint, sorted
    for c in sorted(scored, key=lambda c: (-c["p"], c["start"], c["kind"], -c["end"])):
        start, end = c["start"], c["end"]
        n = bisect_left(added, (end,))
        if not _meets(starts, furthest, start, end) and not (n and added[n - 1][2] > start):
            insort(added, (start, c["kind"], end))
    return sorted(spans + added)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, the base columns and ``spans`` (all spans) for every document."""
    scanned = materialize(scan(docs, id_col, text_col), "pii-scan")
    trained = train(scanned, rows)
    if trained is None:
        extra = scanned.select("row", F.array().cast("array<struct<p:double,start:int,kind:int,end:int>>")
                               .alias("extra")).limit(0)
    else:
        model, thresholds = trained
        open_ = scanned.select("row", F.explode("candidates").alias("c")).filter("c.label < 1").select("row", "c.*")
        least = F.element_at(F.array(*map(F.lit, thresholds)), F.col("kind") + 1)
        passed = score(open_, model).filter(F.col("p") >= least)
        extra = passed.groupBy("row").agg(F.collect_list(F.struct("p", "start", "kind", "end")).alias("extra"))
    joined = scanned.filter("base is not null").drop("candidates").join(extra, "row", "left")
    schema = joined.drop("row", "base", "extra").schema.add("spans", "string")

    def run(batch: pa.RecordBatch):
        base, more = (batch.column(batch.schema.get_field_index(c)) for c in ("base", "extra"))
        spans = [text_of(_chosen(b.as_py(), m.as_py() or [])) for b, m in zip(base, more)]
        kept = [batch.column(batch.schema.get_field_index(c)) for c in schema.names[:-1]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, pa.string())], names=schema.names)

    return map_batches(joined, run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents, with all their columns, each span replaced by its kind in angle brackets."""
    key = F.xxhash64(text_col)
    found = find(docs.withColumn("__key", key), "__key", text_col, rows)
    spans = found.filter("spans <> ''").groupBy(F.col("doc_id").alias("__key")).agg(F.first("spans").alias("__spans"))
    joined = docs.withColumn("__key", key).join(spans, "__key", "left").drop("__key")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batch: pa.RecordBatch):
        out = []
        for text, spans in zip(batch.column(at), batch.column(len(names))):
            text = text.as_py()
            if spans.is_valid:
                parts, end = [], 0
                for kind, start, stop in (s.split(":") for s in spans.as_py().split(",")):
                    if int(start) >= end:
                        parts += [text[end:int(start)], f"<{kind}>"]
                    end = max(end, int(stop))
                text = "".join(parts) + text[end:]
            out.append(text)
        columns = [batch.column(j) if j != at else pa.array(out, pa.string()) for j in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, run, docs.schema)


def op2_boosted_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
