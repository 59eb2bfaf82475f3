"""Document vectors: the mean of the vectors of a document's known words."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.operators.joins import MAX_BROADCAST_BYTES, has_at_most, lookup_join
from glotta.operators.normalization import keep_in_vocabulary
from glotta.operators.once import explode_tokens


def _dims(word_vectors: DataFrame) -> int:
    """The length of the vectors, 0 if there are none."""
    first = word_vectors.select(F.size("embedding").alias("d")).filter("d >= 0").first()
    return first["d"] if first else 0


def broadcastable(word_vectors: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the vector table fits the broadcast bound, by rows times width."""
    width = 4 * _dims(word_vectors) + 64
    return has_at_most(word_vectors.select("word"), max_bytes // width)


def words_in_model(df: DataFrame, word_vectors: DataFrame, keys: list[str],
                   tokens: str = "normalized_text") -> DataFrame:
    """Keep the tokens whose lower-cased form has a vector."""
    return keep_in_vocabulary(df, word_vectors.select("word"), keys, tokens)


def document_to_vector(df: DataFrame, word_vectors: DataFrame, keys: list[str], tokens: str = "normalized_text",
                       out: str = "document_embeddings", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``keys`` plus the mean vector; a document without a known word has no row.

    With a broadcast vector table the tokens of a document are averaged in the
    task that read it and only one partial mean per document is shuffled. A
    larger table is joined on ``(word, salt)``. Each dimension is summed by
    itself: such sums stay in a hash table of one row per document, where an
    aggregate over whole vectors would sort every token with its vector.
    """
    exploded = explode_tokens(df, keys, tokens, "_token").select(*keys, F.lower("_token").alias("word"))
    dims = _dims(word_vectors)
    sized = F.when(F.size("embedding") == dims, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"vectors must have {dims} numbers each")).cast("array<double>"))
    vectors = word_vectors.select("word", sized.cast(word_vectors.schema["embedding"].dataType).alias("_v"))
    joined = lookup_join(exploded, vectors, "word", "inner", F.struct(*keys),
                         small=broadcastable(word_vectors, max_broadcast_bytes))
    sums = [F.sum(F.get("_v", F.lit(i)).cast("double")).alias(f"_{i}") for i in range(dims)]
    mean = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums)
    return mean.select(*keys, F.array(*[F.col(f"_{i}") / F.col("_n") for i in range(dims)]).cast("array<double>").alias(out))


def embeddable_counts(df: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """How many documents have a vector and how many are dropped: ``(embedded, n)``."""
    flagged = df.select(*keys).join(vectors.select(*keys, F.lit(True).alias("_has")), keys, "left")
    return flagged.groupBy(F.coalesce("_has", F.lit(False)).alias("embedded")).agg(F.count(F.lit(1)).alias("n"))


def to_features(df: DataFrame, vectors: str = "document_embeddings", out: str = "features") -> DataFrame:
    """Append the MLlib vector column."""
    return df.withColumn(out, array_to_vector(F.col(vectors)))
