"""Document field names of the serving tables: table column -> document field.

Columns that are not listed keep their name.
"""

from __future__ import annotations

#: Times that tables hold in microseconds (``start_us``) and documents as text (``start_time``).
TIMES = ("start", "end")

# fixed values: index names and field mappings of the serving layer
DOCUMENTS: dict[str, dict[str, str]] = {
    "warning": {
        "vehicle_type": "vehicleType",
        "license_plate": "licensePlate",
        "battery_type": "batteryType",
        "risk_level": "riskLevel",
        "warning_start_time": "warningStartTime",
        "warning_end_time": "warningEndTime",
        "warning_type": "warningType",
        "lose_efficacy_type": "loseEfficacyType",
        "review_status": "reviewStatus",
        "review_result": "reviewResult",
        "review_user": "reviewUser",
    },
    "warninginfo_statistic_perhour": {
        "vehicle_type": "vehicleType",
        "warning_type": "warningType",
    },
    "warninginfo_statistic_perday": {
        "vehicle_type": "vehicleType",
        "warning_type": "warningType",
    },
    "province_warning_index": {
        "highrisk_num": "highriskNum",
        "medrisk_num": "medriskNum",
        "lowrisk_num": "lowriskNum",
        "safety_num": "safetyNum",
    },
    "risk_level_index": {
        "highrisk_num": "highriskNum",
        "medrisk_num": "medriskNum",
        "lowrisk_num": "lowriskNum",
    },
    "batterypack_exception": {
        "vehicle_type": "vehicleType",
        "vol_diff_exception": "cellVoldiffException",
        "temper_rate_exception": "temperRateException",
        "temper_exception": "temperException",
        "temper_diff_exception": "temperDiffException",
        "resistance_exception": "resistanceException",
        "discharge_rate_exception": "dischargeRateException",
    },
    "warningboxplot": {},
    "failure": {},
    "failure_statistics_perhour": {},
    "failure_statistics_perday": {},
    "charge_record": {
        "vehicle_type": "vehicleType",
        "license_plate": "licensePlate",
        "start_time": "chargeStartTime",
        "end_time": "chargeEndTime",
        "start_soc": "chargeStartSoc",
        "end_soc": "chargeEndSoc",
        "ampere_hours": "chargeElectricity",
        "charge_type": "chargeType",
        "max_cells": "maxVolCellNumFrequency",
        "min_cells": "minVolCellNumFrequency",
    },
    "charge_current_frequency": {
        "vehicle_type": "vehicleType",
        "charge_type": "chargeType",
        "frequency": "chargeCurrentFrequency",
        "statis_time": "time",
    },
    "charge_vol_day_diff": {
        "start_time": "dt",
        "vol_diff": "volDiff",
        "day_diff": "dayDiff",
        "is_warning": "isWarning",
    },
    "connection_impedance_es": {
        "start_time": "chargeStartTime",
        "end_time": "chargeEndTime",
        "is_warning": "isWarning",
    },
    "resistance_reduce": {
        "start_time": "startTime",
        "end_time": "endTime",
        "is_warning": "isWarning",
    },
    "bms_sampling": {
        "start_time": "startTime",
        "end_time": "endTime",
        "is_warning": "isWarning",
    },
}
