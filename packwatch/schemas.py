"""Explicit schemas of the frames, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER, WHOLE = T.StringType(), T.DoubleType(), T.LongType()

# fixed values: field names and order of the clean telemetry frame
FRAME_FIELDS = {
    "vin": TEXT,
    "msgTime": TEXT,
    "speed": NUMBER,
    "startupStatus": TEXT,
    "runMode": TEXT,
    "odo": NUMBER,
    "gearStatus": TEXT,
    "chargeStatus": TEXT,
    "maxCellVoltageNum": TEXT,
    "maxCellVoltage": NUMBER,
    "minCellVoltageNum": TEXT,
    "minCellVoltage": NUMBER,
    "maxProbeTemperatureNum": TEXT,
    "maxProbeTemperature": NUMBER,
    "minProbeTemperatureNum": TEXT,
    "minProbeTemperature": NUMBER,
    "cellVoltage": TEXT,
    "differenceCellVoltage": NUMBER,
    "maxTemperatureRate": NUMBER,
    "temperatureRate": TEXT,
    "atanMaxTemperatureRate": NUMBER,
    "atanMinTemperatureRate": NUMBER,
    "averageProbeTemperature": NUMBER,
    "averageCellVoltage": NUMBER,
    "varianceCellVoltage": NUMBER,
    "varianceProbeTemperature": NUMBER,
    "entropy": NUMBER,
    "variation": NUMBER,
    "wDifferenceCellVoltages": TEXT,
    "wDifferenceTotalCellVoltage": NUMBER,
    "differenceInternalResistance": NUMBER,
    "averageModuleCellVoltages": TEXT,
    "maxModuleCellVoltages": TEXT,
    "minModuleCellVoltages": TEXT,
    "maxModuleCellVoltageNums": TEXT,
    "minModuleCellVoltageNums": TEXT,
    "totalModuleCellVoltages": TEXT,
    "differenceModuleCellVoltages": TEXT,
    "instantaneousConsumption": NUMBER,
    "wDischargeRate": NUMBER,
    "resistance": NUMBER,
    "province": TEXT,
    "city": TEXT,
    "country": TEXT,
    "vehicleType": TEXT,
    "enterprise": TEXT,
    "totalCurrent": NUMBER,
    "soc": NUMBER,
}


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, TEXT)


FRAME = struct(**FRAME_FIELDS, dt=TEXT)
RAW_FRAME = struct(data=TEXT, dt=TEXT)

CHARGE_MESSAGE = struct(**_texts("vin", "chargeStatus", "soc", "msgTime"))
MONITOR_MESSAGE = struct(
    vin=TEXT,
    msgTime=WHOLE,
    speed=NUMBER,
    **_texts("startupStatus", "gearStatus", "chargeStatus", "soc"),
)
CHARGE_NOTIFICATION = struct(**_texts("endMsgTime", "startMsgTime", "vin"))
PATTERN_MESSAGE = struct(vin=TEXT, msgTime=WHOLE, chargeStatus=TEXT)

# unpartitioned tab-separated tables
DELIMITED = {
    "warning_type": struct(id=T.IntegerType(), type_name=TEXT, level_id=T.IntegerType()),
    "failure_type": struct(id=T.IntegerType(), type_name=TEXT),
    "warning_level": struct(id=T.IntegerType(), level_type=TEXT),
    "battery_warning_info_perhour": struct(
        **_texts("vin", "vehicle_type", "enterprise", "province", "warning_type", "dt")
    ),
    "avg_vehicle_data_perweek": struct(
        **_texts("enterprise", "province", "vehicleType", "vin"),
        diff_Voltage=NUMBER,
        diff_temper=NUMBER,
        temper_rate=NUMBER,
        temper=NUMBER,
        resistance=NUMBER,
        wDischargeRate=NUMBER,
    ),
    "vehicle_base_info": struct(**_texts("vin", "delivery_time", "licensePlate")),
    "vehicle_initial": struct(**_texts("enterprise", "vin", "quarter")),
    "ini_vol_cell_frequency": struct(cellVoltageNum=TEXT, frequency=WHOLE),
    "ini_current_frequency": struct(current_rk=TEXT, frequency=WHOLE),
}
