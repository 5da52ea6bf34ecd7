"""Sinks: partitioned tables, documents and per-session model runs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from packwatch.session import work_folder
from packwatch.sources.fields import DOCUMENTS, TIMES


def with_time_text(df: DataFrame) -> DataFrame:
    """``start_us`` and ``end_us``, where present, as the texts ``start_time``, ``end_time``.

    A fraction of a second is written only where there is one.
    """
    for name in TIMES:
        if f"{name}_us" in df.columns:
            text = F.timestamp_micros(f"{name}_us").cast("string")
            df = df.withColumn(f"{name}_time", text).drop(f"{name}_us")
    return df


def as_documents(df: DataFrame, index: str) -> DataFrame:
    """The columns under the field names of the index, session times as text."""
    return with_time_text(df).withColumnsRenamed(DOCUMENTS[index])


def write_documents(
    df: DataFrame, path: str, index: str, format: str = "json", mode: str = "append", **options: str
) -> None:
    as_documents(df, index).write.format(format).mode(mode).options(**options).save(path)


def overwrite_table(df: DataFrame, path: str, reads_itself: bool = False) -> None:
    """Replace a table. ``reads_itself`` first stages the rows, as ``df`` reads ``path``."""
    if reads_itself:
        stage = work_folder(df.sparkSession, "stage")
        df.write.parquet(stage)
        df = df.sparkSession.read.schema(df.schema).parquet(stage)
    df.write.mode("overwrite").parquet(path)


def append_partition(df: DataFrame, path: str, **partition: str) -> None:
    """Add the rows to one fixed partition, such as ``dt="2024-01-16"``."""
    fixed = df.withColumns({name: F.lit(value) for name, value in partition.items()})
    fixed.write.mode("append").partitionBy(*partition).parquet(path)


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], fixed: Mapping[str, str] | None = None
) -> None:
    """Replace just the partitions that occur in ``df``, so that a rerun gives the same table.

    Rows of a partition are spread over as many files as their size asks for.
    """
    fixed = fixed or {}
    ready = df.withColumns({name: F.lit(value) for name, value in fixed.items()})
    (
        ready.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_period(df: DataFrame, path: str, period: Mapping[str, str]) -> None:
    """Replace one partition as a whole by the rows of ``df``, also by none at all.

    ``period`` names the partition, outermost column first; those columns of ``df`` are left out of its
    files. All rows must belong there.
    """
    for name, value in period.items():
        if not re.fullmatch(r"[\w .+-]+", value):
            raise ValueError(f"{name}={value!r} is no plain partition value")
    folder = "/".join([path, *(f"{name}={value}" for name, value in period.items())])
    df.drop(*period).hint("rebalance").write.mode("overwrite").parquet(folder)


def on_each_batch(
    stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """Run a set-based job for every micro-batch, such as a model over its sessions."""
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def to_console(stream: DataFrame) -> DataStreamWriter:
    return stream.writeStream.format("console").outputMode("append")
