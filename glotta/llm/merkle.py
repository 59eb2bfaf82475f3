"""A Merkle manifest of a table: content-addressed records, proofs by descent from the root.

Rows are leaves. Within a group (source) they ascend by id, and every ARITY
consecutive nodes become one, up to the group's subroot; the subroots, in the
order of their groups, become the root in the same way. Each inner node is
stored once as a record ``digest -> children``, whatever positions it stands in.

A proof is found by descent: requests begin at the root, the digits of a leaf's
rank say which child comes next, the children not selected are collected, and
the path so gathered is reversed. Requests whose ranks share their first digits
go down together, so a level moves as many rows as it has requested nodes, and
each joins records of its own level on the digest alone.

Everything is DataFrame expressions. Ranks are taken in ranges of the order, so
a group that holds most rows is spread over many tasks.

Defined results: nulls in any column are part of the leaf (``-``); a null id
stands before all others and is never tampered with; a null group is a group of
its own, the first; rows of one id follow each other by leaf digest, equal rows
are leaves of their own; other columns are not read; an empty table has neither
root nor rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta.llm.common import SMALL_ROWS, materialize, table
from glotta.operators.ranking import order_rank

ARITY = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SEGMENT = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the inputs, concatenated; digests enter as text."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(*map(encoded, fields))


@dataclass(frozen=True)
class Trees:
    """Trees over ``(tree, rank)``, ranks from 0: ``records`` (level, digest, children) and ``tops`` (tree, depth, digest)."""

    records: DataFrame
    tops: DataFrame
    depth: int


def grow(nodes: DataFrame) -> Trees:
    """Build the trees of ``nodes`` (tree, n, rank, digest), where n is the number of leaves of the tree.

    Every level is written once: it is read for the level above and for the records.
    """
    spark = nodes.sparkSession
    largest = nodes.agg(F.max("n")).first()[0] or 0
    depth, widths = 0, []
    while ARITY**depth < largest:
        widths.append(F.when(F.col("n") > ARITY**depth, 1).otherwise(0))
        depth += 1
    level = nodes.select("tree", sum(widths, F.lit(0)).alias("depth"), "rank", "digest")
    tops, records = [level.filter("depth = 0")], []
    for k in range(1, depth + 1):
        run = F.expr(f"rank div {ARITY}").alias("rank")
        level = level.filter(F.col("depth") >= k).groupBy("tree", "depth", run).agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest")))["digest"].alias("children"))
        level = materialize(level.withColumn("digest", digest(F.array_join("children", ""))), f"merkle-{k}")
        records.append(level.select(F.lit(k).alias("level"), "digest", "children"))
        level = level.drop("children")
        tops.append(level.filter(F.col("depth") == k))
    empty = spark.createDataFrame([], "level int, digest string, children array<string>")
    stored = _union(records or [empty]).groupBy("level", "digest").agg(F.first("children").alias("children"))
    return Trees(materialize(stored, "merkle-records"),
                 materialize(_union(tops).select("tree", "depth", "digest"), "merkle-tops"), depth)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def descend(trees: Trees, starts: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """``(tree, rank, digest, path)`` of the requested leaves, all by default.

    ``starts`` (tree, depth, digest, path) are roots of trees with the path that
    led to them. ``path`` has one segment per level, from the root down: the
    children left and right of the selected one, joined. ``requests`` is (tree, rank).
    """
    state = None
    columns = ["tree", "rank", "digest", "path"]
    for k in range(trees.depth, -1, -1):
        entering = starts.filter(F.col("depth") == k).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")
        state = entering if state is None else state.unionByName(entering)
        if requests is not None:  # the digits that requests share so far
            wanted = requests.select("tree", F.expr(f"rank div {ARITY**k}").alias("rank")).distinct()
            state = state.join(wanted, ["tree", "rank"], "left_semi").select(*columns)
        if not k:
            return state
        level = trees.records.filter(F.col("level") == k).select("digest", "children")
        state = state.join(level, "digest").select("tree", "rank", "path", "children", F.posexplode("children"))
        left = F.array_join(F.slice("children", F.lit(1), F.col("pos")), "")
        right = F.array_join(F.slice("children", F.col("pos") + 2, F.lit(ARITY)), "")
        state = state.select("tree", (F.col("rank") * ARITY + F.col("pos")).alias("rank"), F.col("col").alias("digest"),
                             F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right")))).alias("path"))
    return state


def proof_digest(path: Column) -> Column:
    """The digest of all siblings from the leaf up to the root, left to right on each level."""
    siblings = F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"]))
    return digest(F.array_join(siblings, ""))


def folded(leaf_: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(F.reverse(path), leaf_, lambda node, s: digest(s["left"], node, s["right"]))


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, rank, leaf and what was carried), a tree per group, and the tree of the subroots.

    ``groups`` is (tree, depth, ordinal, digest): the subroot of each group. ``root`` is null for an empty table.
    """

    leaves: DataFrame
    trees: Trees
    groups: DataFrame
    upper: Trees
    root: str | None


def manifest(rows: DataFrame, order: list[str], group: str, leaf_: str = "leaf") -> Manifest:
    """Build both levels of trees. ``order`` (of the rows of one group) must tell apart all but equal rows.

    The names of the columns of places (tree, n, rank, digest) are taken.
    """
    if taken := {"tree", "n", "rank", "digest", "rank_", "group_"}.intersection(c.lower() for c in rows.columns):
        raise ValueError(f"rename the columns {sorted(taken)}")
    rows = materialize(rows, "merkle-leaves")
    ranked = order_rank(rows, [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)], "rank_")
    ranked = materialize(ranked, "merkle-ranked")
    # One row per group; its first rank names its tree, in the order of the groups.
    groups = ranked.groupBy(group).agg(F.min("rank_").alias("tree"), F.count(F.lit(1)).alias("n"))
    groups = materialize(order_rank(groups, [F.col("tree")], "ordinal").withColumnRenamed(group, "group_"), "merkle-groups")
    joined = F.broadcast(groups) if groups.count() <= SMALL_ROWS else groups
    leaves = ranked.join(joined, F.col(group).eqNullSafe(F.col("group_"))).select(
        "tree", "n", (F.col("rank_") - F.col("tree")).alias("rank"), F.col(leaf_).alias("digest"), *rows.columns)
    leaves = materialize(leaves, "merkle-places")
    trees = grow(leaves.select("tree", "n", "rank", "digest"))
    tops = trees.tops.join(groups.select("tree", "ordinal"), "tree")
    tops = materialize(tops.select("tree", "depth", "ordinal", "digest"), "merkle-subroots")
    count = tops.count()
    upper = grow(tops.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
                             (F.col("ordinal") - 1).alias("rank"), "digest"))
    root = upper.tops.first()
    return Manifest(leaves, trees, tops, upper, root and root["digest"])


def prove(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``(tree, rank, path, subroot)`` of the requested leaves (tree, rank), all by default; paths lead down from the root."""
    here = made.upper.tops.withColumn("path", F.array().cast(f"array<{SEGMENT}>"))
    upper = descend(made.upper, here).select((F.col("rank") + 1).alias("ordinal"), "path")
    starts = materialize(made.groups.join(upper, "ordinal"), "merkle-starts")
    paths = descend(made.trees, starts, requests)
    return paths.join(made.groups.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "tree", "rank", "path", "subroot")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, and whether a copy without line breaks still verifies."""
    return verified_documents(table(spark, sf_dir, "documents"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every document, folded from a copy of which every other document has lost its line breaks."""
    fields = {c: F.col(c) for c in FIELDS}
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    tampered = leaf([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else v for c, v in fields.items()])
    rows = docs.select("doc_id", "source", leaf(list(fields.values())).alias("leaf"),
                       F.when(hit, tampered).alias("tampered"))
    made = manifest(rows, ["doc_id", "leaf"], "source")
    root = F.lit(made.root).cast("string")
    out = made.leaves.select("tree", "rank", "doc_id", "leaf", "tampered").join(prove(made), ["tree", "rank"])
    out = out.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                     folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
