"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import remove_folder, scratch_folder


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links(a, b)``.

    Large-star and small-star steps in turn: every node hangs its larger neighbours, then
    its smaller ones, on its least neighbour. Both are a minimum by node and a join with it, so no
    neighbourhood is gathered; a round is written to the shared folder and replaces the one before.
    It ends when a round changes nothing, after about the logarithm of the longest path.
    """
    spark = links.sparkSession
    edges, path = _stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct()
    )
    state = _state(edges)
    while True:
        large, between = _stored(_large_star(edges))
        remove_folder(spark, path)
        edges, path = _stored(_small_star(large))
        remove_folder(spark, between)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _stored(edges: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_folder(edges.sparkSession, "links")
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), path


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    hung = least.select("u", F.col("m").alias("v"))
    return (
        others.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .unionByName(hung).filter("u <> v").distinct()
    )
