"""The driver tables seen as telemetry: frames, warnings, failures, vehicles."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHARGING_EVENTS = ("click", "view", "signup")
CUTOFF = "1999-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _code(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _with_k(events: DataFrame) -> DataFrame:
    """The events with the number in their properties, read once per row."""
    return events.selectExpr("*", "try_cast(get_json_object(props, '$.k') AS INT) AS k")


def frames(events: DataFrame) -> DataFrame:
    """One telemetry frame per event."""
    charging = ", ".join(f"'{e}'" for e in CHARGING_EVENTS)
    return (
        _with_k(events)
        .selectExpr("*", "concat(k, '%') AS soc_text")
        .selectExpr(
            "event_id AS frame_id",
            "cast(user_id AS STRING) AS vin",
            "ts AS msg_ts",
            "unix_micros(cast(ts AS TIMESTAMP)) AS msg_us",
            "date_format(ts, 'yyyy-MM-dd') AS dt",
            "k",
            "soc_text",
            "try_cast(substring(soc_text, 1, length(soc_text) - 1) AS DOUBLE) / 100 AS soc",
            "try_cast(substring(soc_text, 1, length(soc_text) - 1) AS DOUBLE) AS soc_pct",
            f"CASE WHEN event_type IN ({charging}) THEN '1' ELSE '0' END AS charge_status",
            "value AS total_current",
            "value * 10 AS resistance",
            "value AS high_v",
            "cast(k AS DOUBLE) AS low_v",
            "value / 100 AS cell_spread",
            "cast(user_id * 1000 AS DOUBLE) AS odo",
            "CASE WHEN event_type = 'purchase' THEN 1D ELSE 0D END AS speed",
            "concat('P', user_id % 5) AS province",
            "concat('T', user_id % 3) AS vehicle_type",
            "concat('E', user_id % 2) AS enterprise",
            "k % 96 + 1 AS max_cell_num",
            "cast((event_id + k) % 96 + 1 AS INT) AS min_cell_num",
        )
    )


def charging() -> Column:
    return F.col("charge_status") == "1"


def raw_frames(events: DataFrame) -> DataFrame:
    """Frames as the raw JSON documents of the first layer."""
    fields = {
        "vin": "vin",
        "msgTime": "cast(floor(msg_us / 1000) AS STRING)",
        "speed": "speed",
        "odo": "odo",
        "chargeStatus": "charge_status",
        "maxCellVoltageNum": "cast(max_cell_num AS STRING)",
        "minCellVoltageNum": "cast(min_cell_num AS STRING)",
        "cellVoltage": "concat('[', high_v, ',3.5]')",
        "resistance": "cast(resistance AS STRING)",
        "province": "province",
        "vehicleType": "vehicle_type",
        "enterprise": "enterprise",
        "totalCurrent": "total_current",
        "soc": "soc_text",
    }
    document = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return frames(events).selectExpr(
        "frame_id", f"to_json(named_struct({document})) AS data", "dt"
    )


def messages(events: DataFrame) -> DataFrame:
    """Frames as the messages that vehicles send, with the time and number by which they are put in order."""
    fields = {
        "vin": "vin",
        "msgTime": "date_format(msg_ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        "chargeStatus": "charge_status",
        "soc": "soc_text",
        "province": "province",
        "enterprise": "enterprise",
    }
    document = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return frames(events).selectExpr("msg_us", "frame_id", f"to_json(named_struct({document})) AS value")


def landings(found: DataFrame, parts: int) -> list[DataFrame]:
    """Messages cut by time into stretches of about equal size, to arrive one after the other.

    Within a stretch, messages of the same instant share a file, in order of their number.
    """
    share = [i / parts for i in range(1, parts)]
    bounds = found.agg(F.percentile_approx("msg_us", share).alias("b")).first()["b"] or []
    edges = [None, *sorted(set(bounds)), None]
    out = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        here = found if low is None else found.where(F.col("msg_us") > low)
        here = here if high is None else here.where(F.col("msg_us") <= high)
        out.append(here.repartitionByRange("msg_us").sortWithinPartitions("msg_us", "frame_id").select("value"))
    return out


def weekly_frames(events: DataFrame) -> DataFrame:
    """Frames under the names of the clean layer, as the weekly statistics read them."""
    return frames(events).selectExpr(
        "vin",
        "msg_ts",
        "dt",
        "province",
        "enterprise",
        "vehicle_type AS vehicleType",
        "charge_status AS chargeStatus",
        "high_v AS differenceCellVoltage",
        "low_v AS maxProbeTemperature",
        "high_v / 10 AS minProbeTemperature",
        "high_v * low_v / 100 AS maxTemperatureRate",
        "(low_v + high_v) / 2 AS averageProbeTemperature",
        "resistance",
        "low_v * 2 AS wDischargeRate",
    )


# metric -> side of the fence beyond which a unit counts as an outlier
BOX_SIDES = {
    "m_value": "above",
    "m_square": "above",
    "m_power": "above",
    "m_share": "above",
    "m_inverse": "above",
    "m_level": "below",
}


def box_units(events: DataFrame) -> DataFrame:
    """Six metrics per event, grouped by event type."""
    return (
        _with_k(events)
        .selectExpr("event_type", "event_id", "value", "cast(k AS DOUBLE) AS k")
        .selectExpr(
            "event_type",
            "event_id",
            "value AS m_value",
            "value * value AS m_square",
            "value * k AS m_power",
            "value / (k + 1) AS m_share",
            "10D / (k + 1) AS m_inverse",
            "k AS m_level",
        )
    )


def warnings(events: DataFrame) -> DataFrame:
    """Every event as a warning; a vehicle may appear under two types."""
    return _with_k(events).selectExpr(
        "cast(user_id AS STRING) AS vin",
        "concat('T', (user_id + CASE WHEN k >= 50 THEN 1 ELSE 0 END) % 3) AS vehicle_type",
        "concat('E', user_id % 2) AS enterprise",
        "concat('P', k % 5) AS province",
        "event_type AS warning_type",
        "ts AS warning_start_time",
    )


def failures(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('E', user_id % 2) AS enterprise",
        "concat('P', user_id % 5) AS province",
        "concat('T', user_id % 3) AS vehicleType",
        "cast(user_id AS STRING) AS vin",
        "CASE WHEN event_type <> 'view' THEN event_type END AS failureType",
        "ts AS failureStartTime",
    )


def order_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as reviewed warnings, counted per customer before the dimensions are joined.

    ``n`` is the number of warnings a row stands for.
    """
    review = (
        F.when(F.col("o_orderstatus") == "P", "1")
        .when(F.col("o_orderstatus") == "F", "2")
        .when(F.col("o_orderstatus") == "O", "4")
    )
    counted = (
        table(spark, folder, "orders")
        .groupBy(
            "o_custkey",
            F.substring("o_orderpriority", 1, 1).alias("risk_level"),
            review.alias("review_status"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    owners = table(spark, folder, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return counted.join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("enterprise"),
        F.col("r_name").alias("province"),
        "risk_level",
        "review_status",
        "n",
    )


def order_frames(orders: DataFrame) -> DataFrame:
    """Orders as monthly odometer readings of the customer's vehicle."""
    cust = F.col("o_custkey")
    return orders.select(
        F.col("o_orderkey").alias("frame_id"),
        cust.cast("string").alias("vin"),
        _code("E", cust % 2).alias("enterprise"),
        _code("P", cust % 5).alias("province"),
        _code("T", cust % 3).alias("vehicleType"),
        F.col("o_orderdate").alias("msg_ts"),
        F.col("o_totalprice").alias("price"),
    )


def before_cutoff() -> Column:
    return F.col("msg_ts") < F.lit(CUTOFF).cast("timestamp_ntz")


def vehicles(customer: DataFrame) -> DataFrame:
    """Customers as the base information of vehicles."""
    days = (F.col("c_custkey") % 3000).cast("int")
    return customer.select(
        F.col("c_custkey").cast("string").alias("vin"),
        F.date_add(F.lit("2010-01-01").cast("date"), days).alias("delivery_time"),
        F.col("c_name").alias("license_plate"),
        _code("E", F.col("c_custkey") % 2).alias("enterprise"),
        F.col("c_mktsegment").alias("classification"),
    )


def vector_frames(embeddings: DataFrame) -> DataFrame:
    """Embeddings as frames of cell voltages, as the text they arrive in."""
    text = F.concat(
        F.lit("["),
        F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ","),
        F.lit("]"),
    )
    return embeddings.select("vec_id", "label", text.alias("cell_text"))
