"""Helpers that several operators share: stored intermediate tables and connected groups."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.session import work_folder

__all__ = ["components", "discard", "has_word", "settle", "table", "work_folder"]

WHITE = "\\x20\\x09-\\x0D"
#: The end of a folder's name by work_folder().
SETTLED = re.compile(r"-[0-9a-f]{32}$")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder, small, and go on from its files."""
    path = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that settle() wrote, once all that was made from them is written itself.

    Only folders named as work_folder() names them go; other files that a table reads stay.
    """
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if SETTLED.search(folder):
                path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
                path.getFileSystem(conf).delete(path, True)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def has_word(text: Column) -> Column:
    return text.rlike(f"[^{WHITE}]")


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (
        both.join(least, "u")
        .where("v > u AND v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        large.join(small, "u")
        .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .where("u > v")
        .distinct()
    )


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected groups of an edge list (u long, v long): rows (id, component).

    Alternating large-star and small-star steps until the edges are stars around the
    smallest id of each group. Every step is written to the shared folder, so lineage
    stays short; a node with very many neighbours meets only its own minimum, found with
    map-side combining, in a join that adaptive execution can split. Ids without an
    edge are not returned: such a row is its own component. Null ids and self links are left out.
    """
    now = settle(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        f"{purpose}-edges",
    )
    mark = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (state.n, state.x) == mark or not state.n:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        mark = (state.n, state.x)
        before, now = now, settle(_stars(now), f"{purpose}-edges")
        discard(before)
