"""Work on pairs within buckets, in blocks of bounded size, without making a row per pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.llm.common import settle

RESULT = "id long, tag long, links long, other long"


def bucket_sizes(rows: DataFrame, purpose: str, least: int = 2) -> DataFrame:
    """Rows (t, bucket, n) of the buckets with at least ``least`` members, stored."""
    return settle(rows.groupBy("t", "bucket").agg(F.count("*").alias("n")).where(F.col("n") >= least), purpose)


def in_blocks(rows: DataFrame, buckets: DataFrame, block: int, how: str) -> DataFrame:
    """Deal the rows (t, bucket, id, ...) of each bucket into pairs of blocks.

    A bucket of n members has ceil(n / block) parts, a row falls into one of them by a hash of its
    id and goes to every pair of parts that has its own, so each pair of rows meets in exactly one
    pair of parts. ``buckets`` has (t, bucket, n) of those that need it; ``how`` is inner to leave out
    the rows of other buckets, left to give those a single part.
    """
    parts = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(block)).cast("int")
    return (
        rows.join(buckets, ["t", "bucket"], how)
        .withColumn("parts", parts)
        .drop("n")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("part", "with"))
        .withColumn("high", F.greatest("part", "with"))
        .drop("with", "parts")
    )


def each_block(dealt: DataFrame, work: Callable[[pa.Table], Iterator[tuple]]) -> DataFrame:
    """Run ``work`` on the rows of every pair of parts; its results are rows of RESULT.

    Rows are brought together by hash and sorted, and a task streams through its blocks, so it holds a
    few batches and one block at a time.
    """
    names = ["t", "bucket", "low", "high"]

    def run(batches):
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not table.num_rows:
                return
            keys = [table[n].to_numpy() for n in names]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = [0, *change.tolist(), table.num_rows]
            out: list[tuple] = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > 1:
                    out += work(table.slice(a, b - a))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "tag", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(n)[-1].as_py() for n in names]
            same = np.all([batch.column(n).to_numpy() == v for n, v in zip(names, last, strict=True)], axis=0)
            start = len(same) if same.all() else int(len(same) - np.argmin(same[::-1]))
            if same.all():
                # the block may go on, unless it began with this batch
                if held and [held[-1].column(n)[-1].as_py() for n in names] != last:
                    yield from done(pa.Table.from_batches(held))
                    held = []
                held.append(batch)
                continue
            held.append(batch.slice(0, start))
            yield from done(pa.Table.from_batches(held))
            held = [batch.slice(start)]
        if held:
            yield from done(pa.Table.from_batches(held))

    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, RESULT)


def pair_mask(low: int, high: int, part: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of a block's rows are its own, each pair in one direction only."""
    mask = np.triu(np.ones((len(part), len(part)), dtype=bool), 1)
    if low != high:
        mask &= part[:, None] != part[None, :]
    return mask


def summed_links(
    ids: np.ndarray, tags: np.ndarray, copies: np.ndarray, first: np.ndarray, second: np.ndarray, counted: np.ndarray
) -> Iterator[tuple]:
    """For linked pairs of rows: each row's links, and links that span the connected rows.

    A pair that another bucket counts joins its rows but adds to no sum.
    """
    if not len(first):
        return
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, first[counted], copies[second[counted]])
    np.add.at(links, second[counted], copies[first[counted]])
    label = ids.copy()
    while True:
        least = np.minimum(label[first], label[second])
        new = label.copy()
        np.minimum.at(new, first, least)
        np.minimum.at(new, second, least)
        if (new == label).all():
            break
        label = new
    for i in np.unique(np.concatenate([first, second])).tolist():
        yield int(ids[i]), int(tags[i]), int(links[i]), int(label[i])
