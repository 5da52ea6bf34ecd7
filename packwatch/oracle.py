"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

from packwatch.lens import BOX_SIDES, CUTOFF

LAST_N = 3


def up(c: str, digits: int) -> str:
    """Half-up rounding on the value cleaned to 8 decimals."""
    return f"CAST(round(CAST({c} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def whole(n: str, quarter: int) -> str:
    return f"CAST(floor(({n} + 1) * {quarter} / 4) AS BIGINT)"


def fraction(n: str, quarter: int) -> str:
    return f"((({n} + 1) * {quarter} / 4) % 1)"


FRAMES = """
frames AS (
  SELECT event_id AS frame_id, CAST(user_id AS VARCHAR) AS vin, ts AS msg_ts, epoch_us(ts) AS msg_us,
    strftime(ts, '%Y-%m-%d') AS dt, k, CAST(k AS DOUBLE) / 100 AS soc, CAST(k AS DOUBLE) AS soc_pct,
    event_type IN ('click', 'view', 'signup') AS is_on,
    value AS total_current, value * 10 AS resistance, value AS high_v, CAST(k AS DOUBLE) AS low_v,
    value / 100 AS cell_spread, CAST(user_id * 1000 AS DOUBLE) AS odo,
    CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS speed,
    'P' || (user_id % 5) AS province, 'T' || (user_id % 3) AS vehicle_type,
    'E' || (user_id % 2) AS enterprise, k % 96 + 1 AS max_cell_num,
    CAST((event_id + k) % 96 + 1 AS INTEGER) AS min_cell_num
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

WEEKLY = """
weekly AS (
  SELECT vin, msg_ts, province, enterprise, vehicle_type AS "vehicleType",
    CASE WHEN is_on THEN '1' ELSE '0' END AS state,
    high_v AS diff_v, CAST(k AS DOUBLE) AS max_t, high_v / 10 AS min_t, high_v * k / 100 AS rate,
    (k + high_v) / 2 AS avg_t, resistance, CAST(k * 2 AS DOUBLE) AS discharge
  FROM frames
)"""

# frames with their run of charging frames; gap_us is the time since the previous frame of the run
RUNS = """
marked AS (
  SELECT *, lag(is_on) OVER w AS was_on, lag(msg_us) OVER w AS was_us FROM frames
  WINDOW w AS (PARTITION BY vin ORDER BY msg_us, is_on, frame_id)
),
runs AS (
  SELECT *, (NOT is_on AND coalesce(was_on, false)) AS closing,
    CASE WHEN coalesce(was_on, false) THEN msg_us - was_us ELSE 0 END AS gap_us,
    sum(CASE WHEN is_on AND NOT coalesce(was_on, false) THEN 1 ELSE 0 END) OVER (
      PARTITION BY vin ORDER BY msg_us, is_on, frame_id ROWS UNBOUNDED PRECEDING) AS run_no
  FROM marked
)"""

SESSIONS = """
sessions AS (
  SELECT vin, run_no, min(msg_us) FILTER (is_on) AS start_us, max(msg_us) FILTER (is_on) AS end_us,
    min(soc_pct) FILTER (is_on) AS start_soc, max(soc_pct) FILTER (is_on) AS end_soc,
    avg(cell_spread) FILTER (is_on AND soc >= 0.8) AS spread,
    min(soc) FILTER (is_on) AS low_soc, max(soc) FILTER (is_on) AS high_soc,
    sum(gap_us / 3600000000 * total_current) FILTER (is_on) AS ampere_hours,
    CASE WHEN avg(total_current) FILTER (is_on) >= 30 OR max(total_current) FILTER (is_on) >= 70
      THEN '1' ELSE '0' END AS charge_type,
    min(province) AS province, min(vehicle_type) AS vehicle_type, min(enterprise) AS enterprise
  FROM runs WHERE is_on OR closing GROUP BY vin, run_no HAVING bool_or(closing)
)"""

CROSSING = """
crossing AS (SELECT * FROM sessions WHERE start_soc < 80 AND end_soc >= 80)"""


def with_sessions(select: str) -> str:
    return f"WITH {FRAMES}, {RUNS}, {SESSIONS}, {CROSSING} {select}"


def boxes(source: str, groups: list[str], metrics: list[str]) -> str:
    """CTE ``boxes``: one row per group and metric, from the CTE ``source``."""
    keys = ", ".join(groups)
    long = " UNION ALL ".join(
        f"SELECT {keys}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics
    )
    picks = ", ".join(
        f"max(CASE WHEN rk = {whole('n', q)} THEN value * (1 - {fraction('n', q)}) "
        f"+ nxt * {fraction('n', q)} END) AS q{q}"
        for q in (1, 2, 3)
    )
    return f"""
long AS ({long}),
ranked AS (
  SELECT *, row_number() OVER w AS rk, lead(value, 1, 0) OVER w AS nxt,
    count(*) OVER (PARTITION BY {keys}, metric) AS n
  FROM long WINDOW w AS (PARTITION BY {keys}, metric ORDER BY value ASC NULLS FIRST)
),
boxes AS (
  SELECT {keys}, metric, max(n) AS n, {picks} FROM ranked WHERE n >= 3 GROUP BY {keys}, metric
)"""


UNITS = """
units AS (
  SELECT event_type, event_id, value AS m_value, value * value AS m_square, value * k AS m_power,
    value / (k + 1) AS m_share, 10.0::DOUBLE / (k + 1) AS m_inverse, k AS m_level
  FROM (SELECT *, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k FROM events)
)"""
METRICS = list(BOX_SIDES)


def _exceptions(select: str) -> str:
    wide = ", ".join(
        f"max(CASE WHEN metric = '{m}' THEN {value} END) AS {m}_{name}"
        for m in METRICS
        for name, value in (
            ("q3", up("q3", 1)),
            ("q2", up("q2", 1)),
            ("q1", up("q1", 1)),
            ("maxvalue", up("q3 + q1 * 1.5::DOUBLE", 1)),
            ("minvalue", up("q3 - q1 * 1.5::DOUBLE", 1)),
        )
    )
    hits = ", ".join(f"count(*) FILTER ({_beyond(m)}) AS {m}_outliers" for m in METRICS)
    every = " AND ".join(f"{m}_outliers > 0" for m in METRICS)
    return f"""WITH {UNITS}, {boxes('units', ['event_type'], METRICS)},
wide AS (SELECT event_type, {wide} FROM boxes GROUP BY event_type),
hits AS (SELECT event_type, {hits} FROM units JOIN wide USING (event_type) GROUP BY event_type),
report AS (SELECT wide.*, hits.* EXCLUDE (event_type) FROM wide JOIN hits USING (event_type) WHERE {every})
{select}"""


def _beyond(m: str) -> str:
    return f"{m} > {m}_maxvalue" if BOX_SIDES[m] == "above" else f"{m} < {m}_minvalue"


WARNINGS = """
counts AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS dt, CAST(user_id AS VARCHAR) AS vin,
    'P' || (k % 5) AS province, event_type AS warning_type,
    'T' || ((user_id + CASE WHEN k >= 50 THEN 1 ELSE 0 END) % 3) AS vehicle_type,
    'E' || (user_id % 2) AS enterprise
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
hourly AS (
  SELECT vin, vehicle_type, enterprise, province, warning_type, total, dt,
    substr(dt, 1, 4) AS year, substr(dt, 6, 2) AS month, substr(dt, 9, 2) AS day
  FROM (SELECT dt, vin, province, warning_type, count(*) AS total FROM counts GROUP BY ALL)
  JOIN (SELECT DISTINCT dt, vin, vehicle_type, enterprise FROM counts) USING (dt, vin)
)"""

FAILURES = """
hourly AS (
  SELECT 'E' || (user_id % 2) AS enterprise, 'P' || (user_id % 5) AS province,
    'T' || (user_id % 3) AS "vehicleType", CAST(user_id AS VARCHAR) AS vin,
    CASE WHEN event_type <> 'view' THEN event_type END AS "failureType",
    strftime(ts, '%Y-%m-%d %H') AS dt,
    count(CASE WHEN event_type <> 'view' THEN event_type END) AS total,
    strftime(ts, '%Y-%m-%d') AS day
  FROM events GROUP BY ALL
)"""

RISK = """
w AS (
  SELECT c_mktsegment AS enterprise, r_name AS province, substr(o_orderpriority, 1, 1) AS risk,
    CASE o_orderstatus WHEN 'P' THEN '1' WHEN 'F' THEN '2' WHEN 'O' THEN '4' END AS review
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
RISK_COUNTS = """count(*) FILTER (risk = '1') AS highrisk_num, count(*) FILTER (risk = '2') AS medrisk_num,
  count(*) FILTER (risk = '3') AS lowrisk_num"""

FIRST_USE = f"""
readings AS (
  SELECT o_orderkey AS frame_id, o_custkey, CAST(o_custkey AS VARCHAR) AS vin,
    'E' || (o_custkey % 2) AS enterprise,
    'P' || (o_custkey % 5) AS province, 'T' || (o_custkey % 3) AS vehicle_type, o_orderdate AS ts,
    o_totalprice AS price, o_orderdate < TIMESTAMP '{CUTOFF} 00:00:00' AS is_old
  FROM orders
),
tops AS (
  SELECT *, price / 400000 AS odo, row_number() OVER (
    PARTITION BY is_old, enterprise, vin ORDER BY price / 400000 DESC, ts DESC) AS rk FROM readings
),
seasons AS (
  SELECT is_old, enterprise, vin, CASE WHEN odo > 1 THEN 'none'
    WHEN month(ts) BETWEEN 3 AND 5 THEN 'spring' WHEN month(ts) BETWEEN 6 AND 8 THEN 'summer'
    WHEN month(ts) BETWEEN 9 AND 11 THEN 'automn' ELSE 'winter' END AS quarter
  FROM tops WHERE rk = 1
),
first_use AS (
  SELECT CASE WHEN o.vin IS NULL THEN n.enterprise ELSE o.enterprise END AS enterprise,
    coalesce(o.vin, n.vin) AS vin, CASE WHEN o.vin IS NULL THEN n.quarter ELSE o.quarter END AS quarter
  FROM (SELECT * FROM seasons WHERE is_old) o
  FULL JOIN (SELECT * FROM seasons WHERE NOT is_old) n ON o.vin = n.vin
)"""

SESSION_SELECT = "SELECT vin, start_us, end_us, start_soc, end_soc FROM sessions"
LAST_N_SELECT = """,
grown AS (
  SELECT vin, start_us, list([start_us, end_us]) OVER (
    PARTITION BY vin ORDER BY start_us ROWS 2 PRECEDING) AS recent FROM crossing
)
SELECT vin, start_us, array_to_string(list_sort(flatten(recent)), ',') AS times
FROM grown WHERE len(recent) = 3"""
PATTERN_SELECT = f"""WITH {FRAMES}
SELECT vin, msg_us FROM (
  SELECT *, lead(is_on) OVER (PARTITION BY vin ORDER BY msg_us, frame_id) AS next_on FROM frames
) WHERE is_on AND NOT next_on"""


def _sessions_only(select: str) -> str:
    return f"WITH {FRAMES}, {RUNS}, {SESSIONS} {select}"


def _limits() -> str:
    names = {
        "diff_voltage": ("chargeMaxVolDiff", "unchargeMaxVolDiff"),
        "temper_rate": ("chargeMaxTemperRate", "unchargeMaxTemperRate"),
        "temper": ("chargeMaxTemper", "unchargeMaxTemper"),
        "diff_temper": ("chargeMaxTemperDiff", "unchargeMaxTemperDiff"),
        "resistance": ("chargeMinResistance", "unchargeMinResistance"),
    }
    columns = ", ".join(
        f"max(CASE WHEN metric = '{m}' AND state = '{s}' THEN "
        f"{up('q3 - q1 * 1.5::DOUBLE' if m == 'resistance' else 'q3 + q1 * 1.5::DOUBLE', 1)} END) AS \"{name}\""
        for m, pair in names.items()
        for s, name in zip("10", pair)
    )
    return f"""WITH {FRAMES}, {WEEKLY},
classes AS (
  SELECT 'E' || (c_custkey % 2) AS enterprise, CAST(c_custkey AS VARCHAR) AS vin,
    c_mktsegment AS classification FROM customer
),
means AS (
  SELECT w.enterprise, w.vin, c.classification, w.state,
    {up('avg(diff_v)', 1)} AS diff_voltage, {up('avg(rate)', 1)} AS temper_rate,
    {up('avg(max_t)', 1)} AS temper, {up('avg(max_t - min_t)', 1)} AS diff_temper,
    {up('avg(resistance)', 1)} AS resistance
  FROM weekly w JOIN classes c ON w.vin = c.vin GROUP BY ALL
),
{boxes('means', ['enterprise', 'classification', 'state'], list(names))},
limits AS (
  SELECT enterprise, classification, {columns} FROM boxes
  GROUP BY enterprise, classification HAVING count(DISTINCT state) = 2
)
SELECT c.enterprise, c.vin, limits.* EXCLUDE (enterprise, classification)
FROM classes c LEFT JOIN limits ON c.enterprise = limits.enterprise AND c.classification = limits.classification"""


def _histogram(column: str, low: int, high: int) -> str:
    """Counts of ``column`` for each number of the domain, as text, for use with GROUP BY."""
    return (
        f"array_to_string(list_transform(range({low}, {high + 1}), "
        f"lambda i: len(list_filter(list({column}), lambda x: x = i))), ',')"
    )


STATS = ", ".join(
    f"{up(f'{f}(v)', 6)} AS {name}"
    for name, f in {
        "mean": "avg",
        "total": "sum",
        "lowest": "min",
        "highest": "max",
        "std_samp": "stddev_samp",
        "std_pop": "stddev_pop",
    }.items()
)

TRENDS = f"""WITH {FRAMES}, {RUNS}, {SESSIONS}, {CROSSING},
series AS (
  SELECT vin, start_us, list(spread) OVER w AS ys, list(start_us) OVER w AS ts FROM crossing
  WINDOW w AS (PARTITION BY vin ORDER BY start_us ROWS 2 PRECEDING)
),
gaps AS (
  SELECT *, [0::DOUBLE, (ts[2] - ts[1]) / 86400000000, (ts[3] - ts[2]) / 86400000000] AS xs
  FROM series WHERE len(ts) = 3
),
points AS (SELECT vin, start_us, unnest(xs) AS x, unnest(ys) AS y FROM gaps),
lines AS (
  SELECT vin, start_us, regr_slope(y, x) AS slope, max(x) - min(x) AS day_range FROM points GROUP BY ALL
)"""

TEN_DAYS = """windows AS (
  SELECT vin, start_us, start_us + 864000000000 AS end_us FROM sessions WHERE end_soc - start_soc > 40
)"""

ORACLES: dict[str, str] = {
    "json_extract_frames": f"""WITH {FRAMES}
SELECT frame_id, vin, CAST(floor(msg_us / 1000) AS BIGINT) AS msg_ms, speed, odo,
  CASE WHEN is_on THEN '1' ELSE '0' END AS "chargeStatus", max_cell_num, resistance,
  total_current AS "totalCurrent", soc, high_v + 3.5::DOUBLE AS cell_sum, true AS no_city, dt
FROM frames""",
    "unit_scale_bucket": f"""WITH {FRAMES}
SELECT frame_id, cell_spread * 1000 AS spread_mv, floor(msg_us / 1000) / (1000 * 60 * 60) AS msg_hours,
  floor(msg_us / 1000) / (1000 * 3600 * 24) AS msg_days,
  CAST(trunc(odo / 10000) AS INTEGER) AS odo_band,
  CAST(trunc((total_current - 50) / 5) AS INTEGER) AS current_band, high_v - low_v AS difference,
  {whole('k', 3)} AS q3_whole, {fraction('k', 3)} AS q3_fraction,
  {whole('k', 1)} AS q1_whole, {fraction('k', 1)} AS q1_fraction,
  {up('total_current', 1)} AS current_1dp
FROM frames""",
    "vector_parse_axis_stats": f"""WITH long AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS cell_no, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings
)
SELECT 'frame' AS axis, vec_id AS id, {STATS} FROM long GROUP BY vec_id
UNION ALL SELECT 'cell', cell_no, {STATS} FROM long GROUP BY cell_no""",
    "province_risk": f"""WITH {RISK}
SELECT enterprise, province, {RISK_COUNTS}, CAST(0 AS BIGINT) AS safety_num
FROM w WHERE review IN ('1', '2', '3') GROUP BY ALL""",
    "risk_level": f"""WITH {RISK}
SELECT enterprise, {RISK_COUNTS} FROM w WHERE review IN ('1', '2', '3') GROUP BY ALL""",
    "warnings_hourly": f"WITH {WARNINGS} SELECT * FROM hourly",
    "warnings_daily": f"""WITH {WARNINGS},
days AS (SELECT * REPLACE (year || '-' || month || '-' || day AS dt) FROM hourly)
SELECT vin, vehicle_type, enterprise, province, warning_type, total, dt
FROM (SELECT dt, vin, province, warning_type, CAST(sum(total) AS BIGINT) AS total FROM days GROUP BY ALL)
JOIN (SELECT DISTINCT dt, vin, vehicle_type, enterprise FROM days) USING (dt, vin)""",
    "failures_hourly": f"WITH {FAILURES} SELECT * FROM hourly",
    "failures_daily": f"""WITH {FAILURES}
SELECT enterprise, province, "vehicleType", vin, "failureType", day AS dt,
  CAST(sum(total) AS BIGINT) AS total FROM hourly GROUP BY ALL""",
    "weekly_vehicle_means": f"""WITH {FRAMES}, {WEEKLY}
SELECT strftime(date_trunc('week', msg_ts), '%Y-%m-%d') AS week, enterprise, province, "vehicleType", vin,
  {up('avg(diff_v)', 1)} AS "diff_Voltage", {up('avg(max_t - min_t)', 1)} AS diff_temper,
  {up('avg(rate)', 1)} AS temper_rate, {up('avg(avg_t)', 1)} AS temper,
  {up('avg(resistance)', 1)} AS resistance, {up('avg(discharge)', 1)} AS "wDischargeRate"
FROM weekly GROUP BY ALL""",
    "tukey_quartiles": f"""WITH means AS (
  SELECT l_returnflag, l_linestatus, l_suppkey, {up('avg(l_quantity)', 3)} AS quantity,
    {up('avg(l_extendedprice)', 3)} AS extendedprice, {up('avg(l_discount)', 3)} AS discount,
    {up('avg(l_tax)', 3)} AS tax
  FROM lineitem GROUP BY ALL
), {boxes('means', ['l_returnflag', 'l_linestatus'], ['quantity', 'extendedprice', 'discount', 'tax'])}
SELECT l_returnflag, l_linestatus, metric, n, {up('q1', 4)} AS q1, {up('q2', 4)} AS q2, {up('q3', 4)} AS q3
FROM boxes""",
    "box_fences": f"""WITH {UNITS}, {boxes('units', ['event_type'], METRICS)}
SELECT event_type, metric, n, {up('q1', 4)} AS q1, {up('q2', 4)} AS q2, {up('q3', 4)} AS q3,
  {up('q3 + q1 * 1.5::DOUBLE', 4)} AS max_value, {up('q3 - q1 * 1.5::DOUBLE', 4)} AS min_value,
  {up('q3 + (q3 - q1) * 1.5::DOUBLE', 4)} AS iqr_max, {up('q1 - (q3 - q1) * 1.5::DOUBLE', 4)} AS iqr_min
FROM boxes""",
    "pack_exception_report": _exceptions("SELECT * FROM report"),
    "pack_exception_outliers": _exceptions(
        " UNION ALL ".join(
            f"SELECT event_type, event_id, '{m}' AS metric, {up(m, 6)} AS outlier "
            f"FROM units JOIN report USING (event_type) WHERE {_beyond(m)}"
            for m in METRICS
        )
    ),
    "class_state_limits": _limits(),
    "first_use_upsert": f"WITH {FIRST_USE} SELECT * FROM first_use",
    "vehicle_classes": f"""WITH {FIRST_USE},
lasts AS (
  SELECT *, row_number() OVER (PARTITION BY is_old, vin ORDER BY ts DESC, frame_id DESC) AS rk FROM readings
),
classed AS (
  SELECT l.is_old, l.enterprise, l.vin, concat_ws('-', l.province, l.vehicle_type,
    strftime(DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y'), f.quarter,
    CAST(CAST(trunc(l.price / 10000) AS INTEGER) AS VARCHAR)) AS classification
  FROM lasts l JOIN first_use f ON l.vin = f.vin JOIN customer c ON l.o_custkey = c.c_custkey
  WHERE l.rk = 1
)
SELECT coalesce(n.enterprise, o.enterprise) AS enterprise, coalesce(n.vin, o.vin) AS vin,
  coalesce(n.classification, o.classification) AS classification, '1999-01' AS dt
FROM (SELECT * FROM classed WHERE NOT is_old) n
FULL JOIN (SELECT * FROM classed WHERE is_old) o ON n.vin = o.vin""",
    "charge_sessions": _sessions_only(SESSION_SELECT),
    "charge_large": _sessions_only(f"{SESSION_SELECT} WHERE end_soc - start_soc > 40"),
    "charge_last_n": f"WITH {FRAMES}, {RUNS}, {SESSIONS}, {CROSSING}{LAST_N_SELECT}",
    "charge_end_pattern": PATTERN_SELECT,
    "charge_mode_ah": _sessions_only(
        f"""SELECT vin, start_us, end_us, low_soc AS start_soc, high_soc AS end_soc,
  {up('ampere_hours', 6)} AS ampere_hours, charge_type, enterprise, vehicle_type, province FROM sessions"""
    ),
    "cell_histogram": _sessions_only(
        f"""SELECT s.vin, s.start_us, c_name AS license_plate, s.charge_type,
  {_histogram('max_cell_num', 1, 96)} AS max_cells, {_histogram('min_cell_num', 1, 96)} AS min_cells
FROM sessions s JOIN runs r ON s.vin = r.vin AND s.run_no = r.run_no AND r.is_on
JOIN customer ON s.vin = CAST(c_custkey AS VARCHAR)
GROUP BY s.vin, s.start_us, c_name, s.charge_type"""
    ),
    "current_histogram": _sessions_only(
        f"""SELECT f.province, f.vehicle_type, f.vin, s.charge_type,
  {_histogram('CAST(trunc(f.total_current / 5) AS INTEGER)', 0, 30)} AS frequency
FROM frames f JOIN sessions s ON f.vin = s.vin AND f.province = s.province
  AND f.msg_us BETWEEN s.start_us AND s.end_us
WHERE f.is_on GROUP BY f.province, f.vehicle_type, f.vin, s.charge_type"""
    ),
    "trend_function": f"""{TRENDS}
SELECT vin, start_us, CASE WHEN slope * 1000 / 24 > 0.05 AND day_range * 24 > 40 THEN '1' ELSE '0' END AS is_warning
FROM lines""",
    "spread_trend": f"""{TRENDS}
SELECT vin, start_us, {', '.join(
    "concat_ws(',', " + ", ".join(f"CAST(round(CAST({v}[{i}] AS DECIMAL(28,8)), 4) AS VARCHAR)" for i in (1, 2, 3)) + f") AS {name}"
    for v, name in (("ys", "vol_diff"), ("xs", "day_diff"))
)}, {up('slope', 6)} AS slope, {up('day_range', 6)} AS day_range,
  CASE WHEN slope > 0.01 AND day_range > 3 THEN '1' ELSE '0' END AS is_warning
FROM gaps JOIN lines USING (vin, start_us)""",
    "spread_line": f"""WITH {FRAMES}, {RUNS}, {SESSIONS}, {CROSSING},
days AS (SELECT *, start_us / 86400000000 - 19700 AS day FROM crossing),
lines AS (
  SELECT vin, CASE WHEN min(day) < max(day) THEN regr_slope(spread, day) END AS slope,
    CASE WHEN min(day) < max(day) THEN regr_intercept(spread, day) END AS intercept,
    max(day) - min(day) AS x_range
  FROM days GROUP BY vin
)
SELECT vin, {up('slope', 4)} AS slope, {up('intercept', 4)} AS intercept, {up('x_range', 4)} AS x_range,
  {up('CASE WHEN slope <> 0 THEN -intercept / slope END', 4)} AS x_axis,
  CASE WHEN slope > 0.01 AND x_range > 10 THEN '1' ELSE '0' END AS is_warning FROM lines""",
    "impedance_flag": f"""WITH {FRAMES},
scored AS (
  SELECT vin, count(*) AS frames, avg(cell_spread * 1000 / total_current) FILTER (strong) AS impedance,
    avg(total_current) FILTER (strong) AS mean_current, max(total_current) FILTER (strong) AS peak_current
  FROM (SELECT *, is_on AND total_current > 5 AS strong FROM frames) GROUP BY vin
)
SELECT vin, frames, {up('impedance', 6)} AS impedance, {up('mean_current', 6)} AS mean_current,
  {up('peak_current', 6)} AS peak_current,
  CASE WHEN frames > 50 AND impedance >= CASE
    WHEN mean_current >= 50 OR (mean_current > 45 AND peak_current > 50) THEN 11 ELSE 9 END
  THEN '1' ELSE '0' END AS is_warning
FROM scored""",
    "impedance_windows": f"""WITH {FRAMES}, {RUNS}, {SESSIONS},
starts AS (SELECT vin, start_us FROM sessions WHERE end_soc - start_soc > 40),
windows AS (
  SELECT vin, start_us, start_us + 864000000000 AS end_us FROM starts
  UNION ALL SELECT vin, 0, start_us FROM starts),
scored AS (
  SELECT vin, w.start_us, w.end_us, count(*) AS frames, avg(cell_spread * 1000 / total_current) FILTER (strong) AS impedance,
    avg(total_current) FILTER (strong) AS mean_current, max(total_current) FILTER (strong) AS peak_current
  FROM (SELECT *, is_on AND total_current > 5 AS strong FROM frames) f JOIN windows w USING (vin)
  WHERE msg_us BETWEEN w.start_us AND w.end_us GROUP BY ALL
)
SELECT vin, start_us, end_us, frames, {up('impedance', 6)} AS impedance, {up('mean_current', 6)} AS mean_current,
  {up('peak_current', 6)} AS peak_current,
  CASE WHEN frames > 50 AND impedance >= CASE
    WHEN mean_current >= 50 OR (mean_current > 45 AND peak_current > 50) THEN 11 ELSE 9 END
  THEN '1' ELSE '0' END AS is_warning
FROM scored""",
    "resistance_windows": f"""WITH {FRAMES}, {RUNS}, {SESSIONS}, {TEN_DAYS},
inside AS (
  SELECT vin, w.start_us, w.end_us, msg_us, frame_id, resistance
  FROM frames f JOIN windows w USING (vin) WHERE msg_us BETWEEN w.start_us AND w.end_us
),
numbered AS (
  SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY vin, start_us, end_us) AS n,
    list(resistance) OVER (PARTITION BY vin, start_us, end_us ORDER BY msg_us, frame_id
      ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS around
  FROM inside WINDOW w AS (PARTITION BY vin, start_us, end_us ORDER BY msg_us, frame_id)
),
halves AS (SELECT *, least(20, i) AS c, least(20, i, n - 1 - i) AS h FROM numbered),
smooth AS (SELECT vin, start_us, end_us, i, list_sort(around[c - h + 1 : c + h + 1])[h + 1] AS s FROM halves),
steps AS (
  SELECT vin, start_us, end_us, s - lag(s) OVER (PARTITION BY vin, start_us, end_us ORDER BY i) AS step FROM smooth)
SELECT vin, start_us, end_us, count(*) AS frames, {up('min(step)', 4)} AS lowest_step,
  CASE WHEN coalesce(min(step) < -70, false) THEN '1' ELSE '0' END AS is_warning
FROM steps GROUP BY vin, start_us, end_us""",
    "bms_windows": f"""WITH {FRAMES}, {RUNS}, {SESSIONS}, {TEN_DAYS}
SELECT vin, w.start_us, w.end_us, count(*) AS frames, {up('avg(cell_spread * 1000)', 4)} AS mean_spread,
  CAST(NULL AS VARCHAR) AS is_warning
FROM frames f JOIN windows w USING (vin) WHERE msg_us BETWEEN w.start_us AND w.end_us
GROUP BY vin, w.start_us, w.end_us""",
    "resistance_drop": f"""WITH {FRAMES},
numbered AS (
  SELECT vin, resistance, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY vin) AS n,
    list(resistance) OVER (PARTITION BY vin ORDER BY msg_us, frame_id
      ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS around
  FROM frames WINDOW w AS (PARTITION BY vin ORDER BY msg_us, frame_id)
),
halves AS (SELECT *, least(20, i) AS c, least(20, i, n - 1 - i) AS h FROM numbered),
smooth AS (SELECT vin, i, list_sort(around[c - h + 1 : c + h + 1])[h + 1] AS s FROM halves),
steps AS (SELECT vin, s - lag(s) OVER (PARTITION BY vin ORDER BY i) AS step FROM smooth)
SELECT vin, count(*) AS frames, {up('min(step)', 4)} AS lowest_step,
  CASE WHEN coalesce(min(step) < -70, false) THEN '1' ELSE '0' END AS is_warning
FROM steps GROUP BY vin""",
    "fluctuation_flag": f"""WITH {FRAMES},
moves AS (
  SELECT vin, abs(high_v - lag(high_v) OVER w) AS x, abs(low_v - lag(low_v) OVER w) AS y
  FROM frames WINDOW w AS (PARTITION BY vin ORDER BY msg_us, frame_id)
),
paths AS (
  SELECT vin, coalesce(sum(x), 0) AS high_path, coalesce(sum(y), 0) AS low_path, count(x) + count(y) AS n
  FROM moves GROUP BY vin
),
scored AS (
  SELECT *, CASE WHEN n > 0 THEN (high_path + low_path) / n END AS mean_change,
    CASE WHEN greatest(high_path, low_path) > 0
      THEN least(high_path, low_path) / greatest(high_path, low_path) END AS ratio FROM paths
)
SELECT vin, {up('high_path', 3)} AS high_path, {up('low_path', 3)} AS low_path,
  {up('mean_change', 6)} AS mean_change, {up('ratio', 6)} AS ratio,
  CASE WHEN mean_change > 0.005 AND ratio < 0.8 THEN '1' ELSE '0' END AS is_warning FROM scored""",
    "cell_dispersion": f"""WITH entries AS (
  SELECT label, vec_id, unnest(range(1, len(embedding) + 1)) AS cell_no, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings
),
shifted AS (SELECT *, v - avg(v) OVER (PARTITION BY vec_id) AS d FROM entries),
per_cell AS (
  SELECT label, cell_no, abs(avg(d)) AS mean_dev, stddev_samp(d) AS std_dev FROM shifted GROUP BY ALL
),
{boxes('per_cell', ['label'], ['mean_dev', 'std_dev'])},
limits AS (SELECT label, metric, q1 - (q3 - q1) AS low, q3 + (q3 - q1) AS high FROM boxes)
SELECT label, count(*) FILTER (mean_dev < m.low OR mean_dev > m.high) AS mean_outliers,
  count(*) FILTER (std_dev < s.low OR std_dev > s.high) AS std_outliers,
  CASE WHEN bool_or(mean_dev < m.low OR mean_dev > m.high OR std_dev < s.low OR std_dev > s.high)
    THEN '1' ELSE '0' END AS is_warning
FROM per_cell p
JOIN (SELECT label, low, high FROM limits WHERE metric = 'mean_dev') m USING (label)
JOIN (SELECT label, low, high FROM limits WHERE metric = 'std_dev') s USING (label)
GROUP BY label""",
    "self_discharge": f"""WITH {FRAMES},
numbered AS (SELECT *, frame_id % (SELECT count(*) FROM embeddings) AS vec_id FROM frames),
pairs AS (
  SELECT vin, vec_id, soc_pct, speed, odo, lag(vec_id) OVER w AS vec_before, lag(soc_pct) OVER w AS soc_before,
    lag(speed) OVER w AS speed_before, lag(odo) OVER w AS odo_before,
    (msg_us - lag(msg_us) OVER w) / 86400000000 AS days, frame_id
  FROM numbered WINDOW w AS (PARTITION BY vin ORDER BY msg_us, frame_id)
),
rests AS (
  SELECT * FROM pairs WHERE days >= 0.5 AND odo = odo_before AND abs(soc_pct - soc_before) <= 5
    AND speed = 0 AND speed_before = 0
),
drops AS (
  SELECT r.vin, r.frame_id, (CAST(unnest(b.embedding) AS DOUBLE) - CAST(unnest(a.embedding) AS DOUBLE))
    / r.days * 1000 AS d
  FROM rests r JOIN embeddings b ON r.vec_before = b.vec_id JOIN embeddings a ON r.vec_id = a.vec_id
),
scored AS (
  SELECT vin, frame_id, max(d) AS top, avg(d) + stddev_samp(d) * 2.4::DOUBLE AS lim FROM drops GROUP BY ALL
)
SELECT vin, count(*) AS rests, {up('max(top)', 4)} AS largest_drop,
  count(*) FILTER (top > lim AND top > 30) AS warnings,
  CASE WHEN bool_or(top > lim AND top > 30) THEN '1' ELSE '0' END AS is_warning
FROM scored GROUP BY vin""",
    "bms_inputs": f"""WITH {FRAMES},
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY vin ORDER BY msg_us, frame_id) - 1) // 50 AS piece FROM frames
)
SELECT vin, piece, string_agg(max_cell_num, ',' ORDER BY msg_us, frame_id) AS high_cells,
  string_agg(min_cell_num, ',' ORDER BY msg_us, frame_id) AS low_cells, count(cell_spread) AS n,
  {up('sum(cell_spread * 1000)', 4)} AS total, CAST(NULL AS VARCHAR) AS is_warning
FROM numbered GROUP BY vin, piece""",
    "signal_functions": f"""WITH {FRAMES},
cut AS (
  SELECT *, (row_number() OVER (PARTITION BY vin ORDER BY msg_us, frame_id) - 1) // 60 AS piece,
    is_on AND total_current > 5 AS strong FROM frames
),
numbered AS (
  SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY vin, piece) AS n,
    abs(high_v - lag(high_v) OVER w) AS x, abs(low_v - lag(low_v) OVER w) AS y,
    list(resistance) OVER (PARTITION BY vin, piece ORDER BY msg_us, frame_id
      ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS around
  FROM cut WINDOW w AS (PARTITION BY vin, piece ORDER BY msg_us, frame_id)
),
halves AS (SELECT *, least(20, i) AS c, least(20, i, n - 1 - i) AS h FROM numbered),
smooth AS (SELECT *, list_sort(around[c - h + 1 : c + h + 1])[h + 1] AS s FROM halves),
steps AS (SELECT *, s - lag(s) OVER (PARTITION BY vin, piece ORDER BY i) AS step FROM smooth),
scored AS (
  SELECT vin, piece, count(*) AS frames, avg(cell_spread * 1000 / total_current) FILTER (strong) AS impedance,
    avg(total_current) FILTER (strong) AS mean_current, max(total_current) FILTER (strong) AS peak_current,
    min(step) AS lowest, sum(x) AS xs, sum(y) AS ys, count(x) + count(y) AS moves
  FROM steps GROUP BY vin, piece
)
SELECT vin, piece, frames,
  CASE WHEN frames > 50 AND impedance >= CASE
    WHEN mean_current >= 50 OR (mean_current > 30 AND peak_current > 50) THEN 11 ELSE 9 END
  THEN '1' ELSE '0' END AS impedance,
  CASE WHEN coalesce(lowest < -70, false) THEN '1' ELSE '0' END AS resistance,
  CASE WHEN moves > 0 AND greatest(xs, ys) > 0 AND (xs + ys) / moves > 0.005
    AND least(xs, ys) / greatest(xs, ys) < 0.8 THEN '1' ELSE '0' END AS fluctuation,
  CAST(NULL AS VARCHAR) AS sampling
FROM scored""",
    "stream_sessions": _sessions_only(SESSION_SELECT),
    "stream_large": _sessions_only(f"{SESSION_SELECT} WHERE end_soc - start_soc > 40"),
    "stream_last_n": f"WITH {FRAMES}, {RUNS}, {SESSIONS}, {CROSSING}{LAST_N_SELECT}",
    "stream_pattern": PATTERN_SELECT,
}
