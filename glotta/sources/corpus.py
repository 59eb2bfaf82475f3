"""Reading a corpus: a directory tree of text files, or a table with the same columns."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glotta import SEED
from glotta.functions.text import strip_ends
from glotta.operators.ranking import key_hash

# The columns of the corpus and its key.
CORPUS_COLUMNS = ["context", "language", "docname", "text"]
KEYS = ["context", "language", "docname"]

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder of a NULL or empty key
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _path_part(path: Column, position: int) -> Column:
    # The path is URI-encoded, and `+` in a name is not an encoded space.
    part = F.element_at(F.split(path, "/"), position)
    name = F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    # A tree that Spark wrote names its folders `column=value`.
    return F.regexp_replace(name, "^(context|language|docname)=", "")


def scan_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``<root>/<context>/<language>/<docname>`` files as one row each, text stripped at both ends.

    Spark's readers leave out files of zero bytes; their names are listed apart
    (names only, nothing is read) and added with an empty text.
    """
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    found = files.select(F.col("_metadata.file_path").alias("_path"), F.col("value").alias("_value"))
    if empty := list(_empty_files(spark, root)):
        found = found.unionByName(spark.createDataFrame([(p, "") for p in empty], found.schema))
    return found.select(*[_path_part(F.col("_path"), n).alias(c) for n, c in zip((-3, -2, -1), KEYS)],
                        strip_ends(F.col("_value")).alias("text"))


def _empty_files(spark: SparkSession, root: str) -> Iterator[str]:
    """The URIs of the files of zero bytes under ``root``, without marker and hidden files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            yield status.getPath().toUri().toString()


def write_hive_corpus(df: DataFrame, root: str) -> None:
    """The tree that ``partitionBy(context, language, docname).text`` writes, for ``scan_hive_corpus``.

    On a local (or mounted) file system without Hadoop's native library Spark's
    writer starts a process for each file, to set its mode. There the tasks write
    the files themselves: one per key and task, in place once it is whole, so
    that a task that runs again writes the same file again.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        return df.write.partitionBy(*KEYS).text(root)
    fs.mkdirs(path)  # a tree without documents is a folder as well
    local = spark._jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(path).toString()

    def write(batches):
        task = TaskContext.get()
        name, n = f"part-{task.partitionId():05d}.txt", 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for key, same in groupby(rows, lambda row: row[:len(KEYS)]):
            folder = os.path.join(local, *(f"{c}={_folder_name(v)}" for c, v in zip(KEYS, key)))
            os.makedirs(folder, exist_ok=True)
            beside = f"{folder}/.{name}.{task.taskAttemptId()}"
            with open(beside, "wb") as out:
                for row in same:
                    out.write((row[-1] or "").encode() + b"\n")
            os.replace(beside, f"{folder}/{name}")
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    ordered = df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in KEYS], "text").sortWithinPartitions(*KEYS)
    ordered.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")).close()


def _folder_name(value: str | None) -> str:
    """A key as Spark names its folder: what is not a plain character is its code."""
    if value is None:
        return NO_VALUE
    return re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def scan_hive_corpus(spark: SparkSession, root: str) -> DataFrame:
    """A tree written with ``partitionBy(context, language, docname).text``: the folders are the key.

    On a local (or mounted) file system the tasks list the folders, level by
    level, and read the files, so that the driver holds neither names nor sizes
    of files. Elsewhere Spark discovers the folders as partition columns; they are
    then listed by as many tasks as there are cores, not by one for each folder.
    Either way a filter on the key leaves out files before they are read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file" and fs.exists(path):
        local = spark._jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(path).toString()
        files = _listed(spark, local)
        return files.select(*KEYS, strip_ends(_file_of(F.col("_path")).cast("string")).alias("text"))
    schema = "value string, context string, language string, docname string"
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        files = spark.read.schema(schema).text(root, wholetext=True)
    finally:
        spark.conf.set(LISTING, before)
    return files.select(*KEYS, strip_ends(F.col("value")).alias("text"))


def _visible(folder: str) -> Iterator[os.DirEntry]:
    """What Spark's readers see of a folder."""
    with os.scandir(folder) as entries:
        yield from (e for e in entries if not e.name.startswith(".") and ("=" in e.name or not e.name.startswith("_"))
                    and not e.name.endswith("._COPYING_"))


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """``context, language, docname, _path`` of the files of a local tree, without those of zero bytes."""

    def inner(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                names = []
                for e in _visible(folder):
                    if not e.is_dir():
                        raise ValueError(f"{e.path}: a file beside the folders of keys")
                    names.append(e.path)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["_path"])

    def files(batches):
        for batch in batches:
            rows = []
            for folder in batch.column(0).to_pylist():
                parts = dict(part.split("=", 1) for part in folder[len(root):].strip("/").split("/"))
                key = [_folder_value(parts[c]) for c in KEYS]
                for e in _visible(folder):
                    if e.is_dir():
                        raise ValueError(f"{e.path}: a folder below the folders of keys")
                    if e.stat().st_size:
                        rows.append((*key, e.path))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (list(zip(*rows)) or [[]] * 4)],
                                             names=[*KEYS, "_path"])

    n = 8 * spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(root,)], "_path string")
    for level in KEYS:
        # The folders of a level are few, those of documents are dealt out once more.
        folders = folders.mapInArrow(inner, "_path string").repartition(n, "_path")
    return folders.mapInArrow(files, ", ".join(f"{c} string" for c in [*KEYS, "_path"]))


def _folder_value(name: str) -> str | None:
    """The key that ``_folder_name`` was made of."""
    return None if name == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


#: Of files that Spark's readers unpack by their name.
UNPACK = {".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress}


def _file_of(path: Column) -> Column:
    """The bytes of a local file."""

    def read(path: str) -> bytes:
        ending = os.path.splitext(path)[1]
        if ending in (".zst", ".lz4", ".snappy"):
            raise ValueError(f"{path}: a packing that is not read here")
        with open(path, "rb") as file:
            return UNPACK.get(ending, bytes)(file.read())

    @F.arrow_udf(returnType="binary")
    def files(paths: pa.Array) -> pa.Array:
        return pa.array([read(p) for p in paths.to_pylist()], pa.binary())

    return files(path)


def corpus_from_table(df: DataFrame, context: str, language: str, docname: str, text: str) -> DataFrame:
    """Bind the columns of any table to the corpus columns."""
    return df.select(F.col(context).cast("string").alias("context"), F.col(language).alias("language"),
                     F.col(docname).cast("string").alias("docname"), F.col(text).alias("text"))


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """``n`` random rows, the same for a given seed: the first in hash order (a distributed top-n)."""
    hashed = df.withColumn("_h", key_hash(keys, seed))
    return hashed.orderBy("_h", *keys).limit(n).drop("_h")


def peek(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(n)


def row_at(df: DataFrame, keys: list[str], position: int) -> DataFrame:
    """The row at a 0-based position in key order; empty past the end."""
    return df.orderBy(*keys).offset(position).limit(1)
