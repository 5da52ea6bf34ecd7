"""Late input: reruns of just those hours and days whose input files have changed.

For each hour that a job has computed, a table keeps the input files, with their times of change, that
had rows of it. Comparing it with the files there now tells the hours that new, changed or
vanished files touch.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwatch import schemas
from packwatch.plans.jobs import Layout
from packwatch.session import settle
from packwatch.sources.readers import read_stored
from packwatch.sources.writers import write_period

TEXT, WHOLE = schemas.TEXT, schemas.WHOLE
FILES = schemas.struct(file=TEXT, changed=WHOLE, job=TEXT, period=TEXT)
HOUR = "%Y-%m-%d %H"

HourJob = Callable[[DataFrame, Layout, datetime], None]
DayJob = Callable[[SparkSession, Layout, datetime], None]


def files_by_hour(source: DataFrame, at: str) -> DataFrame:
    """Rows (period, file, changed): which files have rows of which hour. Reads only the column ``at``."""
    hour = F.date_format(F.date_trunc("hour", at), "yyyy-MM-dd HH")
    changed = F.unix_micros("_metadata.file_modification_time")
    rows = source.select(hour.alias("period"), F.col("_metadata.file_path").alias("file"), changed.alias("changed"))
    return rows.where("period IS NOT NULL").distinct()


def refresh(source: DataFrame, layout: Layout, job: str, at: str, hour_job: HourJob, day_job: DayJob | None = None) -> list[datetime]:
    """Run the jobs of all hours whose files have changed since the last refresh, and of their days; those hours.

    ``source`` reads files, and ``at`` names its time. The files of an hour are noted after its jobs are done, so a
    refresh that breaks off is made up for by the next one. Rows without a time are no hour's.
    """
    spark = source.sparkSession
    there = settle(files_by_hour(source, at), "late-files")
    path = layout.table("input_files")
    known = read_stored(spark, path, FILES).where(F.col("job") == job).drop("job")
    columns = ["period", "file", "changed"]
    there, known = there.select(columns), known.select(columns)
    touched = there.exceptAll(known).unionByName(known.exceptAll(there)).select("period").distinct().orderBy("period").collect()
    hours = [datetime.strptime(r["period"], HOUR) for r in touched]
    for hour in hours:
        hour_job(source, layout, hour + timedelta(hours=1))
    if day_job is not None:
        for day in sorted({h.date() for h in hours}):
            day_job(spark, layout, day + timedelta(days=1))
    for hour in hours:
        period = f"{hour:{HOUR}}"
        write_period(there.where(F.col("period") == period), path, {"job": job, "period": period})
    return hours
