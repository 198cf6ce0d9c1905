"""Intermediate tables in the folder that all executors share, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import run_folder


def stored(frame: DataFrame) -> DataFrame:
    """The rows, written once as Parquet to the shared folder and read from there, so that no executor's loss undoes the work."""
    path = run_folder(frame.sparkSession, "tallyloom-llm")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node of ``links``, whose two columns are the ends of a link.

    Large-star and small-star steps in turn (Kiveris et al., 2014), until nothing changes. Each step groups by node with sums
    on the map side and joins; a node with very many links is split in the join.
    """
    a, b = links.columns
    edges = stored(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct())
        now = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
