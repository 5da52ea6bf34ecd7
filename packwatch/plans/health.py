"""Model runs over given windows of a vehicle, as triggered by finished sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.operators.keyed import in_windows
from packwatch.operators.models import connection_impedance, resistance_drop, sampling_inputs, sampling_result

WINDOW = ("vin", "start_us", "end_us")
ORDER = ("msg_us", "frame_id")


def window_frames(frames: DataFrame, windows: DataFrame, disjoint: bool = False) -> DataFrame:
    """Frames of every requested window, both ends included, for all vehicles at once."""
    windows = windows.select(*WINDOW)
    concerned = frames.join(windows.select("vin").distinct(), "vin", "left_semi")
    return in_windows(concerned, windows, ["vin"], "msg_us", "start_us", "end_us", disjoint)


def whole_history(frames: DataFrame) -> DataFrame:
    """One window per vehicle, from its first frame to its last."""
    return frames.groupBy("vin").agg(
        F.min("msg_us").alias("start_us"), F.max("msg_us").alias("end_us")
    )


def impedance_run(frames: DataFrame, **limits: float) -> DataFrame:
    """Connection impedance per window; the spread comes in volts."""
    scaled = frames.withColumn("_spread", F.col("cell_spread") * 1000)
    return connection_impedance(scaled, WINDOW, "_spread", "total_current", **limits)


def resistance_run(frames: DataFrame, **limits: float) -> DataFrame:
    return resistance_drop(frames, WINDOW, ORDER, "resistance", **limits)


def sampling_run(frames: DataFrame) -> DataFrame:
    """One row per window of the sampling model, with the mean spread in millivolts."""
    scaled = frames.withColumn("_spread", F.col("cell_spread") * 1000)
    return sampling_result(scaled, WINDOW, "_spread")


def sampling_signal(frames: DataFrame, piece: int = 10_000) -> DataFrame:
    """The ordered cell numbers of every window, in pieces of bounded size."""
    scaled = frames.withColumn("_spread", F.col("cell_spread") * 1000)
    return sampling_inputs(
        scaled, WINDOW, ORDER, "max_cell_num", "min_cell_num", "_spread", piece
    )


def run_models(
    frames: DataFrame, windows: DataFrame, model: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One set-based run for all windows in place of one job per window."""
    return model(window_frames(frames, windows))
