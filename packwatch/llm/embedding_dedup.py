"""Near-duplicate vectors by p-stable hashing for Euclidean distance, with exact cosine checks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.llm.blocks import bucket_sizes, each_block, in_blocks, pair_mask, summed_links
from packwatch.llm.common import components, settle, table

SEED = 11
#: Width of a hash cell, in units of the distance between unit vectors.
WIDTH = 2.0
#: Share of the pairs just at the threshold that some table must bring together.
RECALL = 0.98
BLOCK = 512
#: Expected members of a bucket that are there by chance.
BY_CHANCE = 16


def collision(distance: float, width: float) -> float:
    """Probability that one projection puts two points of a distance into the same cell."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, threshold: float, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """Projections per table and tables: few chance members per bucket, then enough tables."""
    near = collision(math.sqrt(2 - 2 * threshold), width)
    far = collision(math.sqrt(2), width)
    projections = max(4, math.ceil(math.log(max(rows, 2) / BY_CHANCE) / -math.log(far)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - near**projections))
    return projections, tables


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def buckets_of(units: np.ndarray, projections: int, tables: int, seed: int) -> np.ndarray:
    """Bucket numbers, a column per table; the same for every task, by seed and dimension."""
    dim = units.shape[1]
    rng = np.random.default_rng([seed, dim])
    directions = rng.standard_normal((dim, tables * projections))
    shifts = rng.uniform(0, WIDTH, tables * projections)
    mix = rng.integers(1, 2**63, (tables, projections), dtype=np.int64) | 1
    cells = np.floor((units @ directions + shifts) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        return (cells.reshape(-1, tables, projections) * mix).sum(axis=2) + dim


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """Rows (id, n_links, component_id, kept) of vectors linked by cosine >= threshold.

    A vector that is null, empty, all zero or has a null or non-finite component links with
    nothing, and so does one with a null id; vectors of different lengths never link. Equal vectors make
    one class, found with map-side combining, and count as links of one another. Rows that
    repeat are vectors of their own under one id. An empty table gives no rows; other columns play no part.

    Classes meet in the buckets of several hash tables. Buckets are worked on in pairs of
    blocks of bounded size, by matrix products in double precision; a pair is counted
    in the first table whose bucket it shares and never becomes a row. Only links that span
    the connected members of a block leave it.
    """
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("v"))
    rows = rows.withColumn("hash", F.xxhash64("v"))
    broken = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", broken) & F.exists("v", lambda x: x != 0)
    classes = settle(
        rows.where(usable).groupBy("hash", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vector-classes"
    )
    projections, tables = plan(classes.count(), threshold)

    def hashed(batches):
        for batch in batches:
            lists = batch.column("v")
            sizes = pa.compute.list_value_length(lists).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                keys = buckets_of(unit(flat.reshape(-1, size)), projections, tables, SEED)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(keys), pa.list_(pa.int64()))], [*part.schema.names, "buckets"]
                )

    kind = rows.schema["v"].dataType.simpleString()
    keyed = settle(
        classes.mapInArrow(hashed, f"hash long, v {kind}, id long, copies long, buckets array<long>"), "vector-buckets"
    )
    large = bucket_sizes(keyed.select(F.posexplode("buckets").alias("t", "bucket")), "vector-large", BLOCK + 1)
    members = keyed.select("*", F.posexplode("buckets").alias("t", "bucket"))

    def compare(block: pa.Table):
        block = block.combine_chunks()
        ids, tags, copies, part = (block[c].to_numpy() for c in ("id", "hash", "copies", "part"))
        t, low, high = (block[c][0].as_py() for c in ("t", "low", "high"))
        flat = block["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        units = unit(flat.reshape(len(ids), -1))
        first, second = np.nonzero((units @ units.T >= threshold) & pair_mask(low, high, part))
        keys = block["buckets"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :t]
        counted = ~(keys[first] == keys[second]).any(axis=1)
        return summed_links(ids, tags, copies, first, second, counted)

    found = settle(each_block(in_blocks(members, large, BLOCK, "left"), compare), "vector-links")
    links = found.groupBy("id", "tag").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("u"), F.col("other").alias("v")), "vector")
    result = (
        classes.join(links.withColumnRenamed("tag", "hash"), ["id", "hash"], "left")
        .join(groups, "id", "left")
        .select(
            "hash",
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    return (
        rows.withColumn("usable", usable)
        .join(result, ["hash", "v"], "left")
        .select(
            "id",
            F.when(F.col("usable"), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(F.col("usable"), F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    )


def linked_embeddings(spark, folder: str) -> DataFrame:
    """op1: links and groups of all embeddings."""
    return near_vectors(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


#: All pairs, for comparing on small tables: exact, where hashing finds RECALL of the links at the threshold.
LINKS_SQL = """
SELECT a.vec_id AS u, b.vec_id AS v
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9
"""
