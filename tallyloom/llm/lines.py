"""Line dedup: lines that many documents share are dropped from all of them but one.

Lines are exploded without their text: a row holds a hash of the line's key, the document and the line's position. Hashes
are counted over distinct documents, the positions of shared lines are gathered for each document, and the document is
put together again from the positions that are left. A hot line is summed on the map side and costs one row for each
document that has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that is stripped, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The text split at line feeds; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def shared_lines(docs: DataFrame, min_length: int, min_docs: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``position`` of every line that goes: its key has ``min_length`` code points and is in ``min_docs`` documents."""
    line = docs.select(F.col(doc_id).alias("doc"), F.posexplode(lines_of(F.col(text))).alias("position", "line"))
    key = key_of(F.col("line"))
    hashed = line.where(F.length(key) >= min_length).select(
        "doc", "position", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), F.reverse(key)).alias("h2")
    )
    many = (
        hashed.groupBy("h1", "h2", "doc")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("docs"), F.max("doc").alias("kept_in"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "kept_in")
    )
    return hashed.join(many, ["h1", "h2"]).where(F.col("doc") != F.col("kept_in")).select("doc", "position")


def dedup_lines(
    docs: DataFrame, min_length: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` replaced by the lines that stay, and ``n_lines`` and ``n_dropped`` added.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of ``min_length`` code points and more
    that are found in ``min_docs`` distinct documents and more lose all their lines except in the largest ``doc_id`` that
    holds them. A null or empty text is one empty line and stays as it is (null becomes empty). A text may become empty.
    Rows that share a ``doc_id`` are one document for the count, and each loses the positions that any of them loses; a row
    with a null ``doc_id`` loses nothing. Keys are compared by 128 bits of hash. Clashing names ``n_lines``, ``n_dropped``
    are replaced.
    """
    gone = (
        shared_lines(docs.where(F.col(doc_id).isNotNull()), min_length, min_docs, doc_id, text)
        .groupBy("doc")
        .agg(F.collect_set("position").alias("__gone"))
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.select(names).join(gone.withColumnRenamed("doc", "__doc"), F.col(doc_id) == F.col("__doc"), "left")
    lines = lines_of(F.col(text))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    # A copy of a row may be longer than the one whose positions were found, so the lines that stay are counted.
    kept = F.when(F.col("__gone").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    )
    dropped = F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(left))
    return joined.withColumn("__lines", lines).select(
        *[kept.alias(text) if c == text else F.col(c) for c in names],
        F.size("__lines").cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )
