"""Sources: message streams, raw and clean frame tables, dimensions, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwatch import schemas
from packwatch.functions.scalars import percent_ratio
from packwatch.sources.fields import DOCUMENTS, TIMES

MESSAGE = schemas.struct(value=schemas.TEXT)
#: What the detectors read of a frame.
DETECTED = ("vin", "msgTime", "startupStatus", "chargeStatus", "soc")


def message_stream(
    spark: SparkSession, format: str = "kafka", **options: str
) -> DataFrame:
    """Lines or messages of a stream as one text column ``value``.

    ``format`` is any streaming source: ``kafka`` (servers and topic as options),
    ``socket`` (host and port), ``text`` or ``parquet`` (a folder, as ``path``). The options also
    bound what a micro-batch takes in: ``maxFilesPerTrigger``, ``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``.

    ``source_at`` is a message's place in its source, the same whenever it is read again: the
    offset of its topic's partition, or the row of its file. Sources that number nothing
    have a hash of the message there.
    """
    reader = spark.readStream.format(format).options(**options)
    if format == "parquet":
        reader = reader.schema(MESSAGE)
    raw = reader.load()
    place = {"kafka": F.col("offset"), "parquet": F.col("_metadata.row_index")}.get(format, F.xxhash64("value"))
    return raw.select(F.col("value").cast("string").alias("value"), place.alias("source_at"))


def frame_messages(messages: DataFrame, fields: Sequence[str] = DETECTED) -> DataFrame:
    """Typed frames as the detectors take them, from the messages of :func:`message_stream`.

    The clean frame's columns named in ``fields``, ``msg_us`` (microseconds), ``soc_pct``, and ``frame_id``, the place
    in the source, which tells frames of one vehicle and instant apart. ``broken`` marks messages that are no JSON, or without a
    vehicle or a readable time; they keep their text in ``message`` and have no place among the frames.
    """
    clean = clean_frames(messages.withColumn("message", F.col("value")), "value", fields).withColumnRenamed("source_at", "frame_id")
    return clean.withColumns(
        {
            "msg_us": F.unix_micros("msg_ts"),
            "soc_pct": F.round(F.col("soc") * 100, 8),
            "broken": F.col("vin").isNull() | F.col("msg_ts").isNull(),
        }
    )


def parse_messages(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One column per field of the JSON text; fields that are absent or broken are NULL."""
    return lines.select(F.from_json(column, schema).alias("_m")).select("_m.*")


def epoch_or_text_time(c: Column | str) -> Column:
    """A time given as epoch milliseconds or as formatted text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(
        F.timestamp_millis(c.try_cast("bigint")), F.try_to_timestamp(c)
    )


def clean_frames(raw: DataFrame, column: str = "data", fields: Sequence[str] | None = None) -> DataFrame:
    """Typed frames from raw JSON, plus ``msg_ts``; other columns (``dt``) are kept.

    The text is parsed once. Numbers may be JSON numbers or text; what does not parse
    becomes NULL. ``soc`` changes from ``"80%"`` to a ratio. ``fields`` names those
    that are read, ``msgTime`` among them.
    """
    kinds = {n: k for n, k in schemas.FRAME_FIELDS.items() if fields is None or n in fields}
    texts = schemas.struct(**dict.fromkeys(kinds, schemas.TEXT))
    rest = [c for c in raw.columns if c != column]

    def typed(name: str, kind: T.DataType) -> Column:
        value = F.col(f"_f.{name}")
        if name == "soc":
            return percent_ratio(value).alias(name)
        return value.try_cast(kind).alias(name) if kind != schemas.TEXT else value.alias(name)

    return (
        raw.select(F.from_json(column, texts).alias("_f"), *rest)
        .select(*[typed(n, k) for n, k in kinds.items()], *rest)
        .withColumn("msg_ts", epoch_or_text_time("msgTime"))
    )


def raw_field(column: str, path: str) -> Column:
    """A single field of raw JSON, where parsing all of it is not worth it."""
    return F.get_json_object(column, path)


def read_raw_frames(spark: SparkSession, path: str, format: str = "text") -> DataFrame:
    """Raw JSON frames below ``dt=`` folders."""
    if format == "text":
        return spark.read.text(path).withColumnRenamed("value", "data")
    return spark.read.schema(schemas.RAW_FRAME).format(format).load(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Clean frames below ``dt=`` folders."""
    stamped = T.StructType(list(schemas.FRAME.fields)).add("msg_ts", T.TimestampType())
    return spark.read.schema(stamped).parquet(path)


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; no rows where nothing has been stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_delimited(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the tab-separated tables of ``schemas.DELIMITED``."""
    return spark.read.schema(schemas.DELIMITED[table]).option("sep", "\t").csv(path)


def read_documents(
    spark: SparkSession, path: str, index: str, schema: T.StructType, format: str = "json", **options: str
) -> DataFrame:
    """Documents of an index under the column names of its table.

    ``schema`` lists the columns by their table names. ``start_us`` and ``end_us`` come from the texts that stand
    for them in documents; a text that is no time gives NULL.
    """
    names = DOCUMENTS[index]
    texts = {f"{name}_us": f"{name}_time" for name in TIMES}
    field = {f.name: names.get(texts.get(f.name, f.name), texts.get(f.name, f.name)) for f in schema.fields}
    stored = T.StructType(
        [T.StructField(field[f.name], schemas.TEXT if f.name in texts else f.dataType) for f in schema.fields]
    )
    found = spark.read.format(format).schema(stored).options(**options).load(path)

    def column(name: str) -> Column:
        value = F.col(f"`{field[name]}`")
        return (F.unix_micros(value.try_cast("timestamp")) if name in texts else value).alias(name)

    return found.select(*[column(name) for name in schema.names])


def domain(spark: SparkSession, name: str, low: int, high: int) -> DataFrame:
    """The numbers ``low`` to ``high`` with frequency 0."""
    return spark.range(low, high + 1).select(
        F.col("id").cast("int").alias(name), F.lit(0).cast("long").alias("frequency")
    )
