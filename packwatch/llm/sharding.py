"""Two-pass external shuffle into shards of equal row counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwatch.llm.common import settle, table, work_folder

SEED = 20_240_607
BUCKET_BYTES = 16 << 20
#: Rows that share a scatter cell on average; at most MOST_CELLS cells are made.
CELL_ROWS = 256
MOST_CELLS = 1 << 20


def record_size(text) -> F.Column:
    """UTF-8 bytes of a text, none for null, and 8 for its id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _fisher_yates(seed: int):
    def shuffled(group: pa.Table) -> pa.Table:
        """The rows of a bucket, put in a fixed order first, then in a seeded random one."""
        bucket = group["bucket"][0].as_py()
        order = np.lexsort((group["tie"].to_numpy(), group["cell"].to_numpy()))
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
        return pa.table(
            {
                "place": pa.compute.add(group["base"].take(pa.array(order)), pa.array(np.arange(len(order)))),
                "record": group["record"].take(pa.array(order)),
            }
        )

    return shuffled


def external_shuffle(
    docs: DataFrame,
    path: str,
    n_shards: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Shuffle all rows and write them to ``path`` in ``n_shards`` folders; reads them back.

    Pass 1 scatters rows by a seeded hash of id and text into small cells and adds up their
    rows and bytes; neighbouring cells make a bucket of about ``bucket_bytes``. Pass 2
    moves each bucket to one task, shuffles it there (Fisher-Yates, seeded by bucket) and
    writes it. Buckets laid end to end are one random order of the corpus, which is cut into
    shards whose row counts differ by one at most. Columns: shard int, slot long (gapless from 0
    in each shard) and record, a struct of the input's columns, whose names may thus be any.

    The cell table has at most MOST_CELLS rows, so its broadcast is bounded. Null ids and texts
    are hashed like values; rows that repeat are kept, each in a slot of its own; an
    empty table gives no rows. A text longer than a bucket makes a bucket alone.
    """
    spark = docs.sparkSession
    ident, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    rows = docs.count()
    cells = int(min(MOST_CELLS, max(1, rows // CELL_ROWS)))
    hashed = F.xxhash64(F.lit(seed), ident, text)
    dealt = docs.select(
        F.pmod(hashed, F.lit(cells)).cast("int").alias("cell"),
        F.xxhash64(F.lit(seed + 1), ident, text).alias("tie"),
        record_size(text).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
    )
    sizes = dealt.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = sizes.select(
        "cell",
        F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(bucket_bytes)).cast("int").alias("bucket"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long").alias("start"),
    )
    plan = settle(plan.withColumn("base", F.min("start").over(Window.partitionBy("bucket"))).drop("start"), "shard-cells")
    into = T.StructType([T.StructField("place", T.LongType()), T.StructField("record", dealt.schema["record"].dataType)])
    shuffled = (
        dealt.drop("size")
        .join(F.broadcast(plan), "cell")
        .groupBy("bucket")
        .applyInArrow(_fisher_yates(seed), into)
    )
    small, longer = divmod(rows, n_shards)
    edge = longer * (small + 1)
    place = F.col("place")
    late = F.lit(longer) + F.floor((place - edge) / F.lit(max(small, 1)))
    shard = F.when(place < edge, F.floor(place / F.lit(small + 1))).otherwise(late)
    first = shard * small + F.least(shard, F.lit(longer))
    (
        shuffled.select(shard.cast("int").alias("shard"), (place - first).cast("long").alias("slot"), "record")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
    schema = T.StructType(
        [
            T.StructField("slot", T.LongType()),
            T.StructField("record", dealt.schema["record"].dataType),
            T.StructField("shard", T.IntegerType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)


def sharded_documents(spark, folder: str, n_shards: int = 24) -> DataFrame:
    """op5: every document with its shard and slot, read from the shards written."""
    shards = external_shuffle(table(spark, folder, "documents"), work_folder(spark, "shards"), n_shards)
    text = F.col("record.text")
    return shards.select(
        F.col("record.doc_id").alias("doc_id"),
        record_size(text).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard"),
        F.col("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
