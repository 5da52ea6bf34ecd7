"""Model runs triggered by a stream of finished charges.

One set-based run per micro-batch covers all vehicles and windows of the batch, and
writes its documents below the batch number, so that a repeated batch replaces its own.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from packwatch.plans.charging import WINDOW, charge_records, window_rows
from packwatch.plans.health import impedance_run, run_models
from packwatch.schemas import WHOLE, struct
from packwatch.sources.readers import read_stored
from packwatch.sources.writers import on_each_batch, write_documents
from packwatch.streaming.detectors import SESSION

COMMIT = struct(batch=WHOLE)

Model = Callable[[DataFrame], DataFrame]


def notified_windows(notifications: DataFrame) -> DataFrame:
    """``vin, start_us, end_us`` from notifications with epoch-millisecond times."""

    start, end = (F.col(c).try_cast("long") * 1000 for c in ("startMsgTime", "endMsgTime"))
    return (
        notifications.select("vin", start.alias("start_us"), end.alias("end_us"))
        .dropna()
        .distinct()
    )


def run_for_windows(
    windows: DataFrame, model: Model, path: str, index: str, checkpoint: str
) -> DataStreamWriter:
    """Apply ``model`` to the windows of every micro-batch and publish its rows."""

    def step(batch: DataFrame, number: int) -> None:
        target = os.path.join(path, f"batch={number}")
        write_documents(model(batch), target, index, mode="overwrite")

    return on_each_batch(windows, step, checkpoint)


def closed_sessions(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The sessions that the detector running in ``folder`` closes, as a stream of its table."""
    whole = T.StructType().add("found", SESSION).add("letter", T.StringType())
    stream = spark.readStream.schema(whole).options(**options).parquet(os.path.join(folder, "found"))
    return stream.where("found IS NOT NULL").select("found.*")


def fan_out(sessions: DataFrame, outputs: Mapping[str, tuple[Model, str]], path: str, checkpoint: str) -> DataStreamWriter:
    """Start several models on every batch of one stream and publish each under its index.

    ``outputs`` has a model and an index for each sink. The batch is read once. Each sink notes the batches
    it has finished, by query and number: a batch that is repeated after a failure leaves finished
    sinks alone and does the others anew, in place of what they had begun.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        batch = batch.persist()
        try:
            for sink, (model, index) in outputs.items():
                done = os.path.join(path, sink, "_commits", query, str(number))
                if not read_stored(spark, done, COMMIT).isEmpty():
                    continue
                target = os.path.join(path, sink, f"query={query}", f"batch={number}")
                write_documents(model(batch), target, index, mode="overwrite")
                spark.createDataFrame([(number,)], COMMIT).coalesce(1).write.mode("overwrite").parquet(done)
        finally:
            batch.unpersist()

    return on_each_batch(sessions, step, checkpoint)


def record_model(frames: DataFrame, base: DataFrame) -> Model:
    """Charge records of the windows ``vin, start_us, end_us`` of a batch."""

    def model(batch: DataFrame) -> DataFrame:
        found = charge_records(window_rows(frames, batch.select("vin", "start_us", "end_us")), base, WINDOW)
        return found.withColumn("end_us", F.col("window_end_us")).drop("window_end_us")

    return model


def impedance_model(frames: DataFrame, **limits: float) -> Model:
    """Connection impedance over the windows of a batch."""
    return lambda batch: run_models(frames, batch.select("vin", "start_us", "end_us"), lambda f: impedance_run(f, **limits))


def record_charges(
    notifications: DataFrame, frames: DataFrame, base: DataFrame, path: str, checkpoint: str
) -> DataStreamWriter:
    """Write the charge record of every notified charge."""

    records = record_model(frames, base)
    return run_for_windows(notifications, lambda batch: records(notified_windows(batch)), path, "charge_record", checkpoint)
