"""The same results in the checking engine's SQL, over the same tables."""

from __future__ import annotations

from isobar.sources.fixtures import DAILY_KEYS, DAILY_TEMPERATURE, DAILY_WIND, OBS_COLUMNS, OBS_FILTER

# Fixed values, written out here so that a change in the code under test shows: variables and bounds, regions, attributes of
# derived variables, lineage texts, and the parameters of the queries.
VARIABLES = ("precipitation_surface", "temperature_2m", "wind_u_10m", "wind_v_10m")
COUNTED = ("time", "latitude", "longitude", *VARIABLES)
BOUNDS = (
    ("Coordinate", "latitude", "-90.0", "90.0"),
    ("Coordinate", "longitude", "-180.0", "180.0"),
    ("Variable", "precipitation_surface", "0.0", "1.0"),
    ("Variable", "temperature_2m", "-80.0", "54.0"),
    ("Variable", "wind_u_10m", "-97.0", "88.0"),
    ("Variable", "wind_v_10m", "-88.0", "89.0"),
)
REGIONS = (
    ("europe", "35.0", "70.0", "-10.0", "40.0"),
    ("north_america", "15.0", "70.0", "-160.0", "-50.0"),
    ("global", "-90.0", "90.0", "-180.0", "180.0"),
)
DERIVED = (
    ('wind_speed_10m', ('wind_u_10m', 'wind_v_10m'), 'm/s', 'Wind Speed 10 meters above earth surface', 'Derived from u and v components.'),
    ('wind_direction_10m', ('wind_u_10m', 'wind_v_10m'), 'degrees', '10m Meteorological Wind Direction', 'Direction the wind is coming from (0=North, 90=East, 180=South, 270=West).'),
    ('precipitation_mm_per_hour', ('precipitation_surface',), 'mm/h', 'Hourly Precipitation Accumulation', 'Derived assuming surface precipitation rate is in kg/m^2/s.'),
)
SOURCE_NAME = "NOAA_GFS"
CELL_LOGIC = '{"time": "1D", "metrics": {"temperature_2m": ["mean", "min", "max"], "wind_speed_10m": ["mean", "max"]}}'
REGION_LOGIC = '{"time": "1D", "metrics": {"temperature_2m": ["mean", "max"], "wind_speed_10m": ["mean", "max"]}}'
REGION_BOUNDS = (
    '{"europe": {"lat_slice": {"start": 70.0, "stop": 35.0, "step": null}, "lon_slice": {"start": -10.0, "stop": 40.0, "step": null}},'
    ' "north_america": {"lat_slice": {"start": 70.0, "stop": 15.0, "step": null}, "lon_slice": {"start": -160.0, "stop": -50.0, "step": null}},'
    ' "global": {"lat_slice": {"start": 90.0, "stop": -90.0, "step": null}, "lon_slice": {"start": -180.0, "stop": 180.0, "step": null}}}'
)
DAYS_AHEAD, LIST_BLOCK, SLICED_DAY, TIME_STEPS = 6, 4, "2024-01-10", 24
TABLES = (("bronze", "bronze"), ("silver", "silver"), ("gold", "daily_global"), ("gold", "daily_regional"))


def decimals(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(24,10)), {digits}) AS DOUBLE)"


def six(value: str) -> str:
    return decimals(value, 6)


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# shared subqueries, in dependency order

_COLUMNS = ", ".join(f"{e} AS {n}" for n, e in OBS_COLUMNS.items())
_KEYS = ", ".join(f"{e} AS {n}" for n, e in DAILY_KEYS.items())
_PROFILE = ", ".join(
    ["COUNT(*) - COUNT(time) AS n_untimed", "COUNT(*) FILTER (CAST(time AS DATE) <> date) AS n_off_day"]
    + [f"COUNT({c}) AS {c}__count" for c in COUNTED]
    + [f"MIN({c}) AS {c}__min, MAX({c}) AS {c}__max" for _, c, _, _ in BOUNDS]
)


def _violations() -> str:
    parts = []
    for label, c, lower, upper in BOUNDS:
        for side, sign, bound, word in (("min", "<", lower, "below"), ("max", ">", upper, "above")):
            parts.append(
                f"SELECT date, '{label.lower()}_{side}' AS kind, '{c}' AS target, {c}__{side} AS observed,"
                f" CAST({bound} AS DOUBLE) AS bound,"
                f" '{label} ''{c}'' {side} value ' || {c}__{side} || ' is {word} {bound}' AS message,"
                f" {len(parts)} AS seq FROM prof WHERE {c}__{side} {sign} {bound}"
            )
    parts.append(
        "SELECT date, 'time_steps' AS kind, 'time' AS target, CAST(n_times AS DOUBLE) AS observed, 24e0 AS bound,"
        f" 'Expected 24 time steps, but found ' || n_times AS message, {len(parts)} AS seq FROM prof WHERE n_times <> 24"
    )
    for kind, text in (("untimed", "have no time"), ("off_day", "have a time on another day")):
        parts.append(
            f"SELECT date, '{kind}', 'time', CAST(n_{kind} AS DOUBLE), 0e0, n_{kind} || ' rows {text}', {len(parts)}"
            f" FROM prof WHERE n_{kind} > 0"
        )
    return union(parts)


_SHARE = "(1e0 - CAST({v}__count AS DOUBLE) / CAST(n_rows AS DOUBLE)) * 100e0"
_DROPS = ", ".join(f"{_SHARE.format(v=v)} >= 10e0 AS {v}__drop" for v in VARIABLES)
_OTHERS = "o.time, o.date, o.latitude, o.longitude, o.spatial_ref"
_KEPT = ", ".join(f"CASE WHEN NOT s.{v}__drop THEN o.{v} END AS {v}" for v in VARIABLES)
_HEADING = "(270e0 - (180e0/pi())*atan2(wind_v_10m, wind_u_10m))"
_SPEED = "sqrt(wind_u_10m*wind_u_10m + wind_v_10m*wind_v_10m)"
_DIRECTION = f"({_HEADING} % 360e0 + 360e0) % 360e0"
_READY = "passed AND NOT temperature_2m__drop AND NOT wind_u_10m__drop AND NOT wind_v_10m__drop"

PARTS = {
    "obs": f"SELECT {_COLUMNS}, CAST(0 AS BIGINT) AS spatial_ref FROM events WHERE {OBS_FILTER}",
    "regions": union(
        [
            f"SELECT '{name}' AS region, {lat_min}e0 AS lat_min, {lat_max}e0 AS lat_max,"
            f" {lon_min}e0 AS lon_min, {lon_max}e0 AS lon_max"
            for name, lat_min, lat_max, lon_min, lon_max in REGIONS
        ]
    ),
    "daily": (
        f"SELECT date, latitude, longitude, AVG(t) AS temperature_2m_mean, MIN(t) AS temperature_2m_min,"
        f" MAX(t) AS temperature_2m_max, AVG(w) AS wind_speed_10m_mean, MAX(w) AS wind_speed_10m_max"
        f" FROM (SELECT {_KEYS}, {DAILY_TEMPERATURE} AS t, {DAILY_WIND} AS w FROM lineitem) x GROUP BY 1, 2, 3"
    ),
    "daily_regional": (
        "SELECT date, region, AVG(temperature_2m_mean) AS temp_mean, MAX(temperature_2m_max) AS temp_max,"
        " AVG(wind_speed_10m_mean) AS wind_speed_mean, MAX(wind_speed_10m_max) AS wind_speed_max"
        " FROM daily JOIN regions ON latitude BETWEEN lat_min AND lat_max AND longitude BETWEEN lon_min AND lon_max"
        " GROUP BY date, region"
    ),
    "prof": (
        "SELECT date, COUNT(*) AS n_rows, COUNT(DISTINCT time) AS n_times, MIN(time) AS start_time,"
        f" MAX(time) AS end_time, {_PROFILE} FROM obs GROUP BY date"
    ),
    "viol": _violations(),
    "status": (
        f"SELECT prof.*, date NOT IN (SELECT date FROM viol) AS passed, {_DROPS},"
        " (SELECT 'Data Quality Validation Failed:' || chr(10) || string_agg('- ' || message, chr(10) ORDER BY seq)"
        " FROM viol v WHERE v.date = prof.date) AS reason FROM prof"
    ),
    "kept": f"SELECT {_OTHERS}, {_KEPT} FROM obs o JOIN status s ON o.date = s.date WHERE s.passed",
    "silver": (
        f"SELECT *, {_SPEED} AS wind_speed_10m, {_DIRECTION} AS wind_direction_10m,"
        " precipitation_surface * 3600e0 AS precipitation_mm_per_hour FROM kept"
    ),
    "ready": f"SELECT date FROM status WHERE {_READY}",
    "cells": (
        "SELECT date, latitude, longitude, MAX(spatial_ref) AS spatial_ref, AVG(temperature_2m) AS temperature_2m_mean,"
        " MIN(temperature_2m) AS temperature_2m_min, MAX(temperature_2m) AS temperature_2m_max,"
        " AVG(wind_speed_10m) AS wind_speed_10m_mean, MAX(wind_speed_10m) AS wind_speed_10m_max"
        " FROM silver WHERE date IN (SELECT date FROM ready) GROUP BY 1, 2, 3"
    ),
    "requested": (
        "SELECT CAST(unnest(generate_series(CAST(MIN(date) AS TIMESTAMP),"
        f" CAST(MAX(date) + {DAYS_AHEAD} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM obs"
    ),
    "done": (
        "SELECT 'bronze' AS layer, 'bronze' AS transformation, date FROM status"
        " UNION ALL SELECT 'silver', 'silver', date FROM status WHERE passed"
        " UNION ALL SELECT 'gold', 'daily_global', date FROM ready"
        " UNION ALL SELECT 'gold', 'daily_regional', date FROM ready"
    ),
}
NEEDS = {
    "daily_regional": ("daily", "regions"),
    "prof": ("obs",),
    "viol": ("prof",),
    "status": ("prof", "viol"),
    "kept": ("obs", "status"),
    "silver": ("kept",),
    "ready": ("status",),
    "cells": ("silver", "ready"),
    "requested": ("obs",),
    "done": ("status", "ready"),
}


def over(parts: str, select: str) -> str:
    """``select`` with the named shared subqueries, and those they need, in front of it."""
    wanted: set[str] = set()
    todo = parts.split()
    while todo:
        part = todo.pop()
        if part not in wanted:
            wanted.add(part)
            todo += NEEDS.get(part, ())
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in PARTS.items() if n in wanted) + " " + select


OBS_ALL = f"time, date, latitude, longitude, {', '.join(VARIABLES)}, spatial_ref"
_INSIDE = "latitude BETWEEN lat_min AND lat_max AND longitude BETWEEN lon_min AND lon_max"


def _as_float(column: str) -> str:
    return f"CAST(CAST({column} AS FLOAT) AS DOUBLE)"


def _regional_rollup(names: dict[str, str]) -> str:
    return (
        f"SELECT date, region, AVG(temperature_2m) AS {names['tm']}, MAX(temperature_2m) AS {names['tx']},"
        f" {six('AVG(wind_speed_10m)')} AS {names['wm']}, {six('MAX(wind_speed_10m)')} AS {names['wx']}"
        f" FROM silver JOIN regions ON {_INSIDE} WHERE date IN (SELECT date FROM ready) GROUP BY date, region"
    )


def _stored_regional(names: dict[str, str]) -> str:
    """The regional rollup from stored silver, whose wind speed is a 4-byte float."""
    return _regional_rollup(names).replace("(wind_speed_10m)", "(CAST(wind_speed_10m AS FLOAT))")


def _stored_cells() -> str:
    """The stored cell table: from silver as 4-byte floats, itself stored as 4-byte floats."""
    wind = "CAST(wind_speed_10m AS FLOAT)"
    return (
        "SELECT date, latitude, longitude, MAX(spatial_ref) AS spatial_ref,"
        f" {_as_float('AVG(temperature_2m)')} AS temperature_2m_mean, MIN(temperature_2m) AS temperature_2m_min,"
        f" MAX(temperature_2m) AS temperature_2m_max, {six(_as_float(f'AVG({wind})'))} AS wind_speed_10m_mean,"
        f" {six(_as_float(f'MAX({wind})'))} AS wind_speed_10m_max"
        " FROM silver WHERE date IN (SELECT date FROM ready) GROUP BY 1, 2, 3"
    )


LONG = {"tm": "temperature_2m_mean", "tx": "temperature_2m_max", "wm": "wind_speed_10m_mean", "wx": "wind_speed_10m_max"}
SHORT = {"tm": "temp_mean", "tx": "temp_max", "wm": "wind_speed_mean", "wx": "wind_speed_max"}


def _silver_select(stored: bool) -> str:
    speed, direction = ("wind_speed_10m", "wind_direction_10m")
    if stored:
        speed, direction = _as_float(speed), _as_float(direction)
    return (
        f"SELECT {OBS_ALL}, {six(speed)} AS wind_speed_10m, {six(direction)} AS wind_direction_10m,"
        " precipitation_mm_per_hour FROM silver"
    )


def _monthly(value: str, name: str) -> str:
    return (
        f"SELECT region, CAST(date_trunc('month', date) AS DATE) AS month, {decimals(f'AVG({value})', 2)} AS {name}"
        " FROM daily_regional GROUP BY 1, 2"
    )


def _rolling(rows: int) -> str:
    mean = f"AVG(temp_mean) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"SELECT region, date AS day, {decimals('temp_mean', 2)} AS tmp_mean,"
        f" {decimals(mean, 2)} AS tmp_avg_rolling_{rows}d FROM daily_regional"
    )


_MONTHLY_MART = (
    f"SELECT region, CAST(date_trunc('month', date) AS DATE) AS month, {decimals('AVG(temp_mean)', 2)} AS tmp_avg,"
    f" {decimals('MAX(temp_max)', 2)} AS tmp_max, COUNT(*) AS days_in_month FROM daily_regional GROUP BY 1, 2"
)
_HOTTEST_MART = (
    f"SELECT rlongitude, rlatitude, day, {decimals('peak', 2)} AS tmp_max, rank FROM ("
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY rlongitude, rlatitude ORDER BY peak DESC, day) AS rank FROM ("
    "SELECT ROUND(longitude, 0) + 0e0 AS rlongitude, ROUND(latitude, 0) + 0e0 AS rlatitude, date AS day,"
    " MAX(temperature_2m_max) AS peak FROM daily WHERE temperature_2m_max >= 45 GROUP BY 1, 2, 3) g) r WHERE rank <= 1"
)


def _share_rows() -> str:
    return union(
        [
            f"SELECT date, '{v}' AS variable, n_rows AS total_elements, {v}__count AS non_null_count,"
            f" {_SHARE.format(v=v)} AS null_percentage, {_SHARE.format(v=v)} >= 10e0 AS dropped FROM prof"
            for v in VARIABLES
        ]
    )


def _null_rows(table: str, columns: tuple[str, ...]) -> str:
    return union(
        [
            f"SELECT '{c}' AS variable, COUNT(*) AS total_elements, COUNT({c}) AS non_null_count,"
            f" CASE WHEN COUNT(*) > 0 THEN (1e0 - CAST(COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) * 100e0 END"
            f" AS null_percentage FROM {table}"
            for c in columns
        ]
    )


def _profile_rows(table: str, columns: dict[str, str]) -> str:
    parts = []
    for c, t in columns.items():
        numeric = t == "DOUBLE"
        stats = [("avg", f"AVG({c})"), ("std", f"STDDEV_SAMP({c})")]
        stats += [(f"q{int(p * 100)}", f"QUANTILE_CONT({c}, {p})") for p in (0.25, 0.5, 0.75)]
        shown = ", ".join(f"{six(e) if numeric else 'CAST(NULL AS DOUBLE)'} AS {n}" for n, e in stats)
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(MIN({c}) AS VARCHAR) AS \"min\","
            f" CAST(MAX({c}) AS VARCHAR) AS \"max\", {shown}, COUNT({c}) AS \"count\","
            f" (1e0 - CAST(COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) * 100e0 AS null_percentage,"
            f" COUNT(DISTINCT {c}) AS distinct_values FROM {table}"
        )
    return union(parts)


def _summary_rows(table: str, columns: dict[str, str]) -> str:
    """What the sketched profile gives exactly, and that its approximate values are within their bounds."""
    return union(
        [
            f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(MIN({c}) AS VARCHAR) AS \"min\","
            f" CAST(MAX({c}) AS VARCHAR) AS \"max\", {six(f'AVG({c})') if t == 'DOUBLE' else 'CAST(NULL AS DOUBLE)'} AS avg,"
            f" COUNT({c}) AS \"count\", TRUE AS distinct_near,"
            f" {'TRUE' if t == 'DOUBLE' else 'CAST(NULL AS BOOLEAN)'} AS quartiles_near FROM {table}"
            for c, t in columns.items()
        ]
    )


def _merged_rows(table: str, columns: dict[str, str]) -> str:
    """The same of the profile that is merged from states, with deviation and null share."""
    parts = []
    for c, t in columns.items():
        numeric = t == "DOUBLE"
        avg, std = ((six(f"AVG({c})"), six(f"STDDEV_SAMP({c})")) if numeric else ("CAST(NULL AS DOUBLE)",) * 2)
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(MIN({c}) AS VARCHAR) AS \"min\","
            f" CAST(MAX({c}) AS VARCHAR) AS \"max\", {avg} AS avg, {std} AS std, COUNT({c}) AS \"count\","
            f" (1e0 - CAST(COUNT({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) * 100e0 AS null_percentage,"
            f" TRUE AS distinct_near, {'TRUE' if numeric else 'CAST(NULL AS BOOLEAN)'} AS quartiles_near FROM {table}"
        )
    return union(parts)


_CELL_METRICS = (
    "temperature_2m_mean",
    "temperature_2m_min",
    "temperature_2m_max",
    "wind_speed_10m_mean",
    "wind_speed_10m_max",
)
_DAILY_TYPES = {"date": "DATE", "latitude": "DOUBLE", "longitude": "DOUBLE", **{m: "DOUBLE" for m in _CELL_METRICS}}
_REGIONAL_TYPES = {
    "date": "DATE",
    "region": "VARCHAR",
    "temp_mean": "DOUBLE",
    "temp_max": "DOUBLE",
    "wind_speed_mean": "DOUBLE",
    "wind_speed_max": "DOUBLE",
}
_GOLD_TYPES = {
    **{"date": "DATE", "latitude": "DOUBLE", "longitude": "DOUBLE", "spatial_ref": "BIGINT"},
    **{m: "FLOAT" for m in _CELL_METRICS},
}


def _described(table: str, types: dict[str, str]) -> str:
    return union(
        [
            f"SELECT '{c}' AS column_name, '{t}' AS column_type, 'YES' AS \"null\", COUNT({c}) AS n_values FROM {table}"
            for c, t in types.items()
        ]
    )


def _not_null() -> str:
    tests = [("stg_daily_regional", "daily_regional", c) for c in ("date", "region")]
    tests += [("stg_daily_global", "daily", c) for c in ("date", "latitude", "longitude")]
    return union(
        [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) AS failures,"
            f" COUNT(*) <> 0 AS should_warn, COUNT(*) <> 0 AS should_error FROM {table} WHERE {c} IS NULL"
            for name, table, c in tests
        ]
    )


def _list_when(conditions: dict[str, str]) -> str:
    """The names whose condition holds, sorted and comma-joined."""
    items = ", ".join(f"CASE WHEN {conditions[n]} THEN '{n}' END" for n in sorted(conditions))
    return f"COALESCE(array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ','), '')"


_STORED = {v: f"NOT {v}__drop" for v in VARIABLES}
_MADE = {name: " AND ".join(f"NOT {i}__drop" for i in inputs) for name, inputs, *_ in DERIVED}
_N_KEPT = " + ".join(f"CAST({c} AS INT)" for c in [f"({e})" for e in [*_STORED.values(), *_MADE.values()]])


def _catalog() -> str:
    return union(
        [
            f"SELECT '{name}' AS variable, '{units}' AS units, '{long_name}' AS long_name,"
            f" '{description}' AS description, COUNT({name}) AS n_values FROM silver"
            for name, _, units, long_name, description in DERIVED
        ]
    )


def _format_bytes() -> str:
    size = "(n_chars * 1000e0 * pow(1024e0, doc_id % 6))"
    cases = " ".join(
        f"WHEN {size} < {1024 ** (k + 1)}e0 THEN printf('%.2f', {size} / {1024**k}e0) || '{u}B'"
        for k, u in enumerate(("", "K", "M", "G", "T"))
    )
    return (
        f"SELECT doc_id, CASE {cases} ELSE printf('%.2f', {size} / {1024**5}e0) || 'PB' END AS size FROM documents"
    )


_FAILED = (
    "SELECT date, 'silver' AS stage, reason FROM status WHERE NOT passed UNION ALL"
    " SELECT date, 'gold' AS stage, 'Missing variable: ' || array_to_string(list_filter(["
    "CASE WHEN temperature_2m__drop THEN 'temperature_2m' END,"
    " CASE WHEN wind_u_10m__drop OR wind_v_10m__drop THEN 'wind_speed_10m' END], lambda x: x IS NOT NULL), ', ')"
    f" AS reason FROM status WHERE passed AND NOT ({_READY})"
)


def _exact_sum(value: str) -> str:
    """Exact in whole numbers of 2^-48, then the nearest double."""
    return f"CAST(CAST(SUM(CAST(trunc({value} * 281474976710656e0) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / 281474976710656e0"


def _exact_rollups() -> str:
    values = ("temperature_2m", "wind_speed_10m")
    regional = ", ".join(f"{_exact_sum(v)} / COUNT({v}) AS {v}_mean, {_exact_sum(v)} AS {v}_sum" for v in values)
    cells = ", ".join(f"{_exact_sum(v)} / COUNT({v}) AS {v}_mean" for v in values)
    near = ", ".join(f"{_exact_sum(f'{v}_mean')} AS {v}_of_means" for v in values)
    used = "FROM silver WHERE date IN (SELECT date FROM ready)"
    return (
        f"SELECT * FROM (SELECT date, region, {regional} FROM (SELECT * {used}) s JOIN regions ON {_INSIDE} GROUP BY 1, 2) r"
        f" JOIN (SELECT date, {near} FROM (SELECT date, latitude, longitude, {cells} {used} GROUP BY 1, 2, 3) c"
        " WHERE latitude >= 0 GROUP BY date) n USING (date)"
    )


def statements() -> dict[str, str]:
    day = SLICED_DAY
    pending = (
        "SELECT t.layer, t.transformation, r.date FROM requested r, ("
        + union([f"SELECT '{layer}' AS layer, '{name}' AS transformation" for layer, name in TABLES])
        + ") t WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.layer = t.layer"
        " AND d.transformation = t.transformation AND d.date = r.date)"
    )
    wind = "SELECT time, latitude, longitude, wind_u_10m, wind_v_10m"
    return {
        "scan_observations": over("obs", f"SELECT {OBS_ALL} FROM obs"),
        "day_slice": over("obs", f"SELECT {OBS_ALL} FROM obs WHERE date = DATE '{day}'"),
        "bronze_write_roundtrip": over("obs", f"SELECT {OBS_ALL} FROM obs"),
        "silver_write_roundtrip": over("silver", _silver_select(stored=True)),
        "gold_write_roundtrip": over("silver ready", _stored_cells()),
        "stg_daily_global": over("silver ready", _stored_cells()),
        "stg_daily_regional": over("silver ready regions", _stored_regional(SHORT)),
        "mart_roundtrip": over("daily_regional", _MONTHLY_MART),
        "gated_mart": over("daily", _HOTTEST_MART),
        "concat_partitions": over(
            "obs",
            "SELECT time, date, latitude, longitude, spatial_ref, temperature_2m, wind_u_10m, wind_v_10m,"
            " CASE WHEN EXTRACT(DAY FROM date) <> 5 THEN precipitation_surface END AS precipitation_surface FROM obs",
        ),
        "grid_flatten": (
            "SELECT vec_id, CAST(p - 1 AS INT) AS position, 90e0 - 0.25e0 * ((p - 1) // 8) AS latitude,"
            " -180e0 + 0.25e0 * ((p - 1) % 8) AS longitude, CAST(v AS DOUBLE) AS value FROM ("
            "SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS p FROM embeddings) e"
        ),
        "grid_pack": (
            f"SELECT date, latitude, longitude, COUNT(*) AS steps, CASE WHEN COUNT(*) <= {TIME_STEPS} THEN"
            " array_to_string(list(COALESCE(CAST(temperature_2m AS VARCHAR), 'null') ORDER BY time, event_id), ',') END"
            f" AS packed FROM (SELECT event_id, {_COLUMNS} FROM events WHERE {OBS_FILTER}) o GROUP BY 1, 2, 3"
        ),
        "hourly_global": over(
            "silver",
            f"SELECT time, date, latitude, longitude, temperature_2m, {six('wind_speed_10m')} AS wind_speed_10m,"
            f" {six('wind_direction_10m')} AS wind_direction_10m, precipitation_mm_per_hour FROM silver",
        ),
        "pending_partitions": over("requested done", pending),
        "gold_completeness": over(
            "requested done",
            "SELECT r.date, COUNT(d.date) AS finished, COUNT(d.date) = 2 AS all_done FROM requested r"
            " LEFT JOIN done d ON d.date = r.date AND d.layer = 'gold' GROUP BY r.date",
        ),
        "wind_speed": over("obs", f"{wind}, {six(_SPEED)} AS wind_speed_10m FROM obs"),
        "wind_direction": over("obs", f"{wind}, {six(_DIRECTION)} AS wind_direction_10m FROM obs"),
        "precipitation_mm": over(
            "obs",
            "SELECT time, latitude, longitude, precipitation_surface * 3600e0 AS precipitation_mm_per_hour FROM obs",
        ),
        "silver": over("silver", _silver_select(stored=False)),
        "drop_null_variables": over(
            "obs status", f"SELECT {_OTHERS}, {_KEPT} FROM obs o JOIN status s ON o.date = s.date"
        ),
        "variable_catalog": over("silver", _catalog()),
        "diurnal_range": over(
            "daily",
            "SELECT date, latitude, longitude, temperature_2m_min AS min_tmp, temperature_2m_mean AS mean_tmp,"
            " temperature_2m_max AS max_tmp FROM daily WHERE latitude BETWEEN 25 AND 60"
            " AND temperature_2m_max - temperature_2m_min > 20",
        ),
        "regional_trend": over(
            "daily_regional", f"SELECT region, date AS day, {six('temp_mean')} AS tmp_mean FROM daily_regional"
        ),
        "region_list": over("daily_regional", "SELECT region FROM daily_regional GROUP BY region"),
        "coarsen_grid": over(
            "daily",
            "SELECT ROUND(longitude, 0) + 0e0 AS rlongitude, ROUND(latitude, 0) + 0e0 AS rlatitude,"
            " COUNT(*) AS cells, MAX(temperature_2m_max) AS temperature_2m_max_max FROM daily GROUP BY 1, 2",
        ),
        "region_assign": over(
            "obs regions",
            f"SELECT region, time, latitude, longitude, temperature_2m FROM obs JOIN regions ON {_INSIDE}",
        ),
        "daily_global": over(
            "cells",
            "SELECT date, latitude, longitude, spatial_ref, temperature_2m_mean, temperature_2m_min,"
            f" temperature_2m_max, {six('wind_speed_10m_mean')} AS wind_speed_10m_mean,"
            f" {six('wind_speed_10m_max')} AS wind_speed_10m_max FROM cells",
        ),
        "daily_regional": over("silver ready regions", _regional_rollup(LONG)),
        "exact_rollups": over("silver ready regions", _exact_rollups()),
        "monthly_regional_averages": over("daily_regional", _monthly("temp_mean", "tmp_avg")),
        "monthly_wind_averages": over("daily_regional", _monthly("wind_speed_mean", "wind_avg")),
        "mart_regional_monthly_averages": over("daily_regional", _MONTHLY_MART),
        "compare_regions_over_time": over(
            "daily_regional",
            f"SELECT date AS day, region, {decimals('AVG(temp_mean)', 2)} AS tmp_avg FROM daily_regional GROUP BY 1, 2",
        ),
        "rolling_7d": over("daily_regional", _rolling(7)),
        "rolling_30d": over("daily_regional", _rolling(30)),
        "rolling_30d_per_cell": over(
            "daily",
            f"SELECT latitude, longitude, date AS day, {decimals('temperature_2m_mean', 2)} AS tmp_mean,"
            f" {decimals('AVG(temperature_2m_mean) OVER (PARTITION BY latitude, longitude ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 2)}"
            " AS tmp_avg_rolling_30d FROM daily",
        ),
        "hottest_days_per_region": over(
            "daily_regional",
            f"SELECT region, day, {decimals('peak', 2)} AS tmp_max, rank FROM (SELECT *, ROW_NUMBER() OVER"
            " (PARTITION BY region ORDER BY peak DESC, day) AS rank FROM (SELECT region, date AS day,"
            " MAX(temp_max) AS peak FROM daily_regional GROUP BY 1, 2) g) r WHERE rank <= 50",
        ),
        "mart_global_hottest_days": over("daily", _HOTTEST_MART),
        "summarize_daily_global": over("daily", _summary_rows("daily", _DAILY_TYPES)),
        "profile_daily_global": over("daily", _profile_rows("daily", _DAILY_TYPES)),
        "summarize_from_sketches": over("daily", _merged_rows("daily", _DAILY_TYPES)),
        "profile_daily_regional": over(
            "daily_regional",
            _profile_rows(
                f"(SELECT date, region, {six('temp_mean')} AS temp_mean, temp_max,"
                f" {six('wind_speed_mean')} AS wind_speed_mean, wind_speed_max FROM daily_regional) d",
                _REGIONAL_TYPES,
            ),
        ),
        "missing_days": over(
            "requested status", "SELECT date FROM requested EXCEPT SELECT date FROM status WHERE passed"
        ),
        "extra_days": over("requested", "SELECT date FROM obs EXCEPT SELECT date + 2 FROM requested"),
        "date_utils": (
            "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) + 1 AS next_day,"
            " CAST(CAST(l_shipdate AS DATE) - DATE '1998-01-01' AS INT) AS days_since,"
            " strftime(l_shipdate, '%Y-%m-%d') AS day_text FROM lineitem"
        ),
        "date_list": (
            "SELECT o_orderkey, CAST(unnest(generate_series(o_orderdate,"
            f" o_orderdate + to_days(CAST(o_orderkey % {LIST_BLOCK} AS INT)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders"
        ),
        "format_bytes": _format_bytes(),
        "path_date": over("obs", "SELECT date, date AS path_date, COUNT(*) AS n_rows FROM obs GROUP BY date"),
        "table_label": (
            "SELECT 'daily_' || event_type || '_10m' AS name, 'Daily ' || upper(event_type[1]) || event_type[2:]"
            " || ' 10M' AS label, COUNT(*) AS n FROM events GROUP BY event_type"
        ),
        "quality_metrics": over("prof", "SELECT * FROM prof"),
        "quality_violations": over("viol", "SELECT date, kind, target, observed, bound, message FROM viol"),
        "quality_passed": over(
            "obs status", f"SELECT {OBS_ALL} FROM obs WHERE date IN (SELECT date FROM status WHERE passed)"
        ),
        "quality_quarantine": over(
            "obs status", f"SELECT {OBS_ALL} FROM obs WHERE date IN (SELECT date FROM status WHERE NOT passed)"
        ),
        "null_share_flags": over("prof", _share_rows()),
        "null_report": over("obs", _null_rows("obs", VARIABLES)),
        "hours_check": over(
            "requested",
            "SELECT (SELECT COUNT(*) FROM requested) * 24 AS expected_hours, COUNT(DISTINCT time) AS ingested_hours,"
            " (SELECT COUNT(*) FROM requested) * 24 = COUNT(DISTINCT time) AS hours_equal,"
            " COUNT(*) > (SELECT COUNT(*) FROM (SELECT DISTINCT time, latitude, longitude FROM obs) k)"
            " AS duplicate_timestamps FROM obs",
        ),
        "duplicate_observations": over(
            "obs",
            "SELECT time, latitude, longitude, COUNT(*) AS copies FROM obs GROUP BY 1, 2, 3 HAVING COUNT(*) > 1",
        ),
        "gold_missing_partitions": over(
            "requested ready",
            "SELECT 'Daily Global' AS table_label, date FROM requested WHERE date NOT IN (SELECT date FROM ready)",
        ),
        "gold_null_report": over("cells", _null_rows("cells", _CELL_METRICS)),
        "not_null_tests": over("daily daily_regional", _not_null()),
        "lineage_bronze": over(
            "prof",
            f"SELECT 'bronze' AS layer, '{SOURCE_NAME}' AS source, date, start_time, end_time, 4 AS variable_count,"
            f" '{','.join(sorted(VARIABLES))}' AS variables, n_rows AS row_count, n_rows * 16 AS size_bytes FROM prof",
        ),
        "lineage_silver": over(
            "status",
            f"SELECT 'silver' AS layer, '{SOURCE_NAME}' AS source, date, 'bronze' AS parent_layer, start_time, end_time,"
            f" {_list_when({**_STORED, **_MADE})} AS variables,"
            f" {_list_when({v: f'{v}__drop' for v in VARIABLES})} AS variables_dropped,"
            f" {_list_when(_MADE)} AS variables_derived, n_rows AS row_count,"
            f" n_rows * 4 * ({_N_KEPT}) AS size_bytes FROM status WHERE passed",
        ),
        "lineage_gold": over(
            "cells silver ready regions",
            f"SELECT 'gold' AS layer, 'daily_global' AS transformation, date, '{CELL_LOGIC}' AS aggregation_logic,"
            " '\"Global\"' AS spatial_bounds, COUNT(*) AS row_count FROM cells GROUP BY date"
            f" UNION ALL SELECT 'gold', 'daily_regional', date, '{REGION_LOGIC}', '{REGION_BOUNDS}',"
            f" COUNT(DISTINCT region) FROM silver JOIN regions ON {_INSIDE}"
            " WHERE date IN (SELECT date FROM ready) GROUP BY date",
        ),
        "list_tables": over(
            "daily daily_regional",
            "SELECT 'daily_global' AS table_name, 'VIEW' AS table_type, COUNT(*) AS n_rows FROM daily"
            " UNION ALL SELECT 'daily_regional', 'VIEW', COUNT(*) FROM daily_regional",
        ),
        "describe_daily_global": over("cells", _described("cells", _GOLD_TYPES)),
        "describe_daily_regional": over("daily_regional", _described("daily_regional", _REGIONAL_TYPES)),
        "repaired_days": over("silver ready regions", _stored_regional(LONG)),
        "landing_files": over("obs", "SELECT date, COUNT(*) AS n_rows, TRUE AS has_files, TRUE AS marked FROM obs GROUP BY date"),
        "elt_daily_regional": over("silver ready regions", _stored_regional(LONG)),
        "failed_days": over("status", _FAILED),
        "backfill_dates": over(
            "requested done",
            "SELECT date FROM requested EXCEPT SELECT date FROM done WHERE transformation = 'daily_regional'",
        ),
    }
