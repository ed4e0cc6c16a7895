"""DuckDB oracle: the same queries as plain SQL over the driver's test tables.

Each query is an independent SQL string: the shared CTE chain below
re-derives the stand-in inputs, the Silver frames, the risk rules and the
star schema (natural keys only; surrogate hash keys are not compared),
then the view.  Measures come out as DOUBLE on both sides; rounding that
must be exact (half away from zero on a ratio) is done with integer
arithmetic here, because DuckDB divides decimals in floating point.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracle does not depend on the jobs.
AS_OF, RUN_TIME, RUN_TIME_2 = "2024-01-29 12:00:00", "2024-02-01 00:00:00", "2024-02-02 00:00:00"
RECOMMENDATION_GREEN = "Conditions are within configured operational limits."
RECOMMENDATION_UNKNOWN = "Insufficient data for a complete operational assessment."
_RED_HEAD, _RED_TAIL = "Suspend weather-sensitive operations; limiting parameter: ", "."
_AMBER_HEAD, _AMBER_TAIL = "Proceed with caution and enhanced monitoring; limiting parameter: ", "."
ATMOSPHERIC_SOURCE, MARINE_SOURCE = "Open-Meteo", "Open-Meteo Marine"
PRICE_SOURCE, RIG_SOURCE, RISK_SOURCE = "EIA", "Baker Hughes", "Operational Risk Engine v1"

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def title(x: str) -> str:
    """Python str.title(): capitalise each run of letters."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), "
        f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"
    )


def pct(part: str, total: str) -> str:
    """ROUND(part * 100 / NULLIF(total, 0), 2) for non-negative integers, exactly."""
    return (
        f"CASE WHEN ({total}) = 0 THEN NULL ELSE "
        f"CAST((20000 * CAST({part} AS HUGEINT) + ({total})) // (2 * CAST({total} AS HUGEINT)) AS DOUBLE) / 100.0 END"
    )


def avg_exact(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / COUNT({x})"


def level_counts(col: str = "overall_risk_level") -> str:
    return ", ".join(
        f"COUNT(*) FILTER (WHERE {col} = '{lvl}') AS {lvl.lower()}_hours"
        for lvl in ["GREEN", "AMBER", "RED", "UNKNOWN"]
    )


def upper_level(v: str, lim: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN {v} > {lim} THEN 'RED' "
        f"WHEN {v} >= {lim} * CAST(0.8 AS DOUBLE) THEN 'AMBER' ELSE 'GREEN' END"
    )


def minimum_level(v: str, lim: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN {v} < {lim} THEN 'RED' "
        f"WHEN {v} <= {lim} * CAST(1.25 AS DOUBLE) THEN 'AMBER' ELSE 'GREEN' END"
    )


def score(x: str) -> str:
    return f"CASE {x} WHEN 'GREEN' THEN 1 WHEN 'AMBER' THEN 2 WHEN 'RED' THEN 3 ELSE 0 END"


ATM_MEASURES = [
    ("temperature_c", "DECIMAL(8,3)"), ("relative_humidity_pct", "DECIMAL(8,3)"),
    ("pressure_hpa", "DECIMAL(10,3)"), ("precipitation_mm", "DECIMAL(10,3)"),
    ("wind_speed_kmh", "DECIMAL(10,3)"), ("wind_direction_deg", "DECIMAL(8,3)"),
    ("wind_gust_kmh", "DECIMAL(10,3)"), ("visibility_m", "DECIMAL(12,3)"),
]
MAR_MEASURES = [
    "wave_height_m", "wave_direction_deg", "wave_period_s", "wind_wave_height_m", "swell_wave_height_m",
    "swell_wave_direction_deg", "swell_wave_period_s", "sea_surface_temperature_c",
    "ocean_current_velocity_kmh", "ocean_current_direction_deg",
]
MAR_NON_NEGATIVE = {
    "wave_height_m", "wave_period_s", "wind_wave_height_m", "swell_wave_height_m",
    "swell_wave_period_s", "ocean_current_velocity_kmh",
}
HOUR = "asset_id, forecast_reference_time, forecast_valid_time"

_atm_fact_cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in ATM_MEASURES)
_mar_fact_cols = ", ".join(f"CAST({n} AS DECIMAL(8,3)) AS {n}" for n in MAR_MEASURES)
_mar_silver_cols = ", ".join(
    f"CASE WHEN {n} >= 0 THEN {n} END AS {n}" if n in MAR_NON_NEGATIVE else n for n in MAR_MEASURES
)
_rig_status = (
    "CASE WHEN o.o_orderstatus = 'F' THEN 'active' WHEN o.o_orderstatus = 'O' THEN 'non-opec stacked' "
    "ELSE 'o''neil 3rd party' END"
)
_num = "'^[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?|[iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$'"


def to_number(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), {_num}) THEN TRY_CAST(trim({x}) AS DOUBLE) END"


CTES = f"""
o_registry AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS asset_id, c.c_name AS asset_name, c.c_mktsegment AS asset_type,
         r.r_name AS operator_name, 'LOC-' || CAST(n.n_nationkey AS VARCHAR) AS location_id,
         n.n_name AS location_name, r.r_name AS country,
         CAST(n.n_nationkey AS DOUBLE) * 3.5 - 40.0 AS latitude,
         CAST(n.n_regionkey AS DOUBLE) * 30.0 - 60.0 + CAST(n.n_nationkey AS DOUBLE) * 0.5 AS longitude,
         CASE WHEN c.c_custkey % 7 <> 6 THEN CAST(30 + (c.c_custkey % 5) * 10 AS DOUBLE) END AS max_wind_kmh,
         CASE WHEN c.c_custkey % 7 <> 6 THEN CAST(45 + (c.c_custkey % 5) * 12 AS DOUBLE) END AS max_gust_kmh,
         CASE WHEN c.c_custkey % 7 <> 6 THEN 2.0 + CAST(c.c_custkey % 3 AS DOUBLE) * 0.5 END AS max_wave_height_m,
         CASE WHEN c.c_custkey % 7 <> 6 THEN CAST(1000 + (c.c_custkey % 4) * 500 AS DOUBLE) END AS minimum_visibility_m,
         c.c_custkey AS registry_row
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
o_limits AS (
  SELECT * FROM o_registry
  WHERE asset_id IS NOT NULL AND location_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
    AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
  QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY registry_row DESC) = 1
),
o_atm_land AS (
  SELECT CAST(user_id AS VARCHAR) AS asset_id,
         date_trunc('week', ts) AS forecast_reference_time, date_trunc('hour', ts) AS forecast_valid_time,
         value / 10 AS temperature_c, {K} AS relative_humidity_pct,
         CASE WHEN event_type = 'purchase' THEN value / 30 ELSE 0.0 END AS precipitation_mm,
         980.0 + {K} * 0.5 AS pressure_hpa,
         CASE WHEN event_type <> 'signup' THEN value END AS wind_speed_kmh,
         {K} * 3.6 AS wind_direction_deg,
         CASE WHEN event_type <> 'signup' THEN value * 1.4 END AS wind_gust_kmh,
         CASE WHEN event_type <> 'signup' THEN {K} * 100 END AS visibility_m,
         CAST({K} % 4 AS INTEGER) AS weather_code,
         event_id AS record_order
  FROM events
),
o_atm AS (
  SELECT forecast_reference_time, forecast_valid_time,
         CAST(greatest(floor((epoch_us(forecast_valid_time) - epoch_us(forecast_reference_time)) / 3600000000), 0) AS INTEGER) AS forecast_horizon_hours,
         asset_id, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
         temperature_c, relative_humidity_pct, precipitation_mm, pressure_hpa, wind_speed_kmh, wind_direction_deg,
         wind_gust_kmh, visibility_m, weather_code, '{ATMOSPHERIC_SOURCE}' AS source, 'events.parquet' AS source_file
  FROM o_atm_land
  QUALIFY row_number() OVER (PARTITION BY {HOUR} ORDER BY record_order DESC) = 1
),
o_mar_land AS (
  SELECT CAST(user_id AS VARCHAR) AS asset_id,
         date_trunc('week', ts) AS forecast_reference_time, date_trunc('hour', ts) AS forecast_valid_time,
         value / 30 AS wave_height_m, {K} * 3.6 AS wave_direction_deg, {K} / 10 AS wave_period_s,
         (value - 25) / 30 AS wind_wave_height_m, (value - 60) / 30 AS swell_wave_height_m,
         360.0 - {K} * 3.6 AS swell_wave_direction_deg, ({K} - 10) / 5 AS swell_wave_period_s,
         (value - 40) / 10 AS sea_surface_temperature_c, ({K} - 30) / 20 AS ocean_current_velocity_kmh,
         {K} * 1.8 AS ocean_current_direction_deg, event_id AS record_order
  FROM events WHERE event_type NOT IN ('error', 'signup')
),
o_mar AS (
  SELECT forecast_reference_time, forecast_valid_time,
         CAST(greatest(floor((epoch_us(forecast_valid_time) - epoch_us(forecast_reference_time)) / 3600000000), 0) AS INTEGER) AS forecast_horizon_hours,
         asset_id, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
         {_mar_silver_cols}, '{MARINE_SOURCE}' AS source, 'events.parquet' AS source_file
  FROM o_mar_land
  QUALIFY row_number() OVER (PARTITION BY {HOUR} ORDER BY record_order DESC) = 1
),
o_risk_levels AS (
  SELECT a.forecast_reference_time, a.forecast_valid_time, a.asset_id,
         {upper_level('a.wind_speed_kmh', 'l.max_wind_kmh')} AS wind_risk_level,
         {upper_level('a.wind_gust_kmh', 'l.max_gust_kmh')} AS gust_risk_level,
         {upper_level('m.wave_height_m', 'l.max_wave_height_m')} AS wave_risk_level,
         {minimum_level('a.visibility_m', 'l.minimum_visibility_m')} AS visibility_risk_level
  FROM o_atm a
  LEFT JOIN o_mar m ON m.asset_id = a.asset_id AND m.forecast_reference_time = a.forecast_reference_time
                   AND m.forecast_valid_time = a.forecast_valid_time
  LEFT JOIN o_limits l ON l.asset_id = a.asset_id
),
o_risk_scored AS (
  SELECT *, greatest({score('wind_risk_level')}, {score('gust_risk_level')}, {score('wave_risk_level')}, {score('visibility_risk_level')}) AS top
  FROM o_risk_levels
),
o_risk_rated AS (
  SELECT forecast_reference_time, forecast_valid_time, asset_id, wind_risk_level, gust_risk_level,
         wave_risk_level, visibility_risk_level,
         CASE top WHEN 3 THEN 'RED' WHEN 2 THEN 'AMBER' WHEN 1 THEN 'GREEN' ELSE 'UNKNOWN' END AS overall_risk_level,
         CASE WHEN top = 1 THEN NULL
              WHEN {score('wind_risk_level')} = top THEN 'wind_speed'
              WHEN {score('gust_risk_level')} = top THEN 'wind_gust'
              WHEN {score('wave_risk_level')} = top THEN 'wave_height'
              ELSE 'visibility' END AS limiting_parameter
  FROM o_risk_scored
),
o_risk AS (
  SELECT forecast_reference_time, forecast_valid_time, asset_id, wind_risk_level, gust_risk_level,
         wave_risk_level, visibility_risk_level, overall_risk_level,
         CASE overall_risk_level
           WHEN 'RED' THEN '{_RED_HEAD}' || limiting_parameter || '{_RED_TAIL}'
           WHEN 'AMBER' THEN '{_AMBER_HEAD}' || limiting_parameter || '{_AMBER_TAIL}'
           WHEN 'GREEN' THEN '{RECOMMENDATION_GREEN}'
           ELSE '{RECOMMENDATION_UNKNOWN}' END AS operation_recommendation,
         limiting_parameter, '{RISK_SOURCE}' AS source
  FROM o_risk_rated
),
o_dim_location AS (
  SELECT DISTINCT location_id, location_name, country,
         CAST(latitude AS DECIMAL(9,6)) AS latitude, CAST(longitude AS DECIMAL(9,6)) AS longitude
  FROM o_registry WHERE location_id IS NOT NULL
),
o_dim_asset AS (
  SELECT g.asset_id, g.asset_name, g.asset_type, g.operator_name, g.location_id, TRUE AS is_active,
         CAST(g.max_wind_kmh AS DECIMAL(8,2)) AS max_wind_kmh, CAST(g.max_gust_kmh AS DECIMAL(8,2)) AS max_gust_kmh,
         CAST(g.max_wave_height_m AS DECIMAL(8,2)) AS max_wave_height_m,
         CAST(g.minimum_visibility_m AS DECIMAL(10,2)) AS minimum_visibility_m
  FROM (SELECT * FROM o_registry QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY registry_row DESC) = 1) g
  JOIN o_dim_location d ON d.location_id = g.location_id
),
o_fact_weather AS (
  SELECT asset_id, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, {_atm_fact_cols},
         weather_code, source, TIMESTAMP '{RUN_TIME}' AS ingestion_time
  FROM o_atm
),
o_fact_marine AS (
  SELECT asset_id, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, {_mar_fact_cols},
         source, TIMESTAMP '{RUN_TIME}' AS ingestion_time
  FROM o_mar
),
o_fact_risk AS (SELECT *, TIMESTAMP '{RUN_TIME}' AS ingestion_time FROM o_risk),
o_operational AS (
  SELECT a.asset_id, a.asset_name, a.asset_type, l.location_name, l.country, l.latitude, l.longitude,
         w.forecast_reference_time, w.forecast_valid_time, w.forecast_horizon_hours,
         w.temperature_c, w.relative_humidity_pct, w.pressure_hpa, w.precipitation_mm, w.wind_speed_kmh,
         w.wind_direction_deg, w.wind_gust_kmh, w.visibility_m, w.weather_code,
         {", ".join("m." + n for n in MAR_MEASURES)},
         r.wind_risk_level, r.gust_risk_level, r.wave_risk_level, r.visibility_risk_level,
         r.overall_risk_level, r.operation_recommendation, r.limiting_parameter
  FROM o_fact_weather w
  JOIN o_dim_asset a ON a.asset_id = w.asset_id
  JOIN o_dim_location l ON l.location_id = a.location_id
  LEFT JOIN o_fact_marine m ON m.asset_id = w.asset_id AND m.forecast_reference_time = w.forecast_reference_time
                           AND m.forecast_valid_time = w.forecast_valid_time
  LEFT JOIN o_fact_risk r ON r.asset_id = w.asset_id AND r.forecast_reference_time = w.forecast_reference_time
                         AND r.forecast_valid_time = w.forecast_valid_time
),
o_latest AS (
  SELECT f.* FROM o_operational f
  JOIN (SELECT asset_id, MAX(forecast_reference_time) AS latest_reference_time FROM o_operational GROUP BY asset_id) lr
    ON lr.asset_id = f.asset_id AND lr.latest_reference_time = f.forecast_reference_time
),
o_price_land AS (
  SELECT strftime(l.l_shipdate, '%Y-%m-%d') AS period, p.p_brand AS product, p.p_name AS product_name_raw,
         l.l_extendedprice AS value, p.p_brand || '.' || l.l_returnflag AS series, l.l_returnflag AS units,
         l.l_linestatus AS process,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_returnflag,
         l.l_linestatus, l.l_shipdate
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
o_price AS (
  SELECT TRY_CAST(trim(period) AS TIMESTAMP) AS timestamp, trim(product) AS product_code,
         trim(product_name_raw) AS product, value AS price_usd, trim(units) AS unit, '{PRICE_SOURCE}' AS source,
         trim(series) AS series, trim(process) AS process_code
  FROM o_price_land
  WHERE TRY_CAST(trim(period) AS TIMESTAMP) IS NOT NULL AND product IS NOT NULL AND product_name_raw IS NOT NULL
    AND value IS NOT NULL AND units IS NOT NULL AND series IS NOT NULL AND value >= 0
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(trim(period) AS TIMESTAMP), trim(series)
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
             l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) = 1
),
o_price_fact_in AS (
  SELECT timestamp, upper(trim(product_code)) AS product_code, price_usd, trim(unit) AS unit,
         trim(source) AS source, trim(series) AS series
  FROM o_price WHERE price_usd >= 0
),
o_dim_product AS (
  SELECT product_code, product_name,
         CASE WHEN upper(product_name) LIKE '%DIESEL%' OR upper(product_name) LIKE '%GASOLINE%'
                   OR upper(product_name) LIKE '%JET FUEL%' THEN 'REFINED_PRODUCT'
              WHEN upper(product_name) LIKE '%BRENT%' OR upper(product_name) LIKE '%WTI%'
                   OR upper(product_name) LIKE '%CRUDE%' THEN 'CRUDE_OIL'
              WHEN upper(product_name) LIKE '%NATURAL GAS%' THEN 'NATURAL_GAS'
              ELSE 'ENERGY_COMMODITY' END AS commodity_type,
         default_unit
  FROM (
    SELECT upper(trim(product_code)) AS product_code, product_code AS raw_code, trim(product) AS product_name,
           trim(unit) AS default_unit, timestamp, series
    FROM o_price WHERE product IS NOT NULL AND price_usd >= 0
    QUALIFY row_number() OVER (PARTITION BY upper(trim(product_code)), product_code, trim(product), trim(unit)
                               ORDER BY timestamp, series) = 1
  ) firsts
  QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY timestamp DESC, series DESC) = 1
),
o_fact_price AS (
  SELECT timestamp, product_code, CAST(price_usd AS DECIMAL(12,4)) AS price_usd, unit, source, series,
         timestamp AS source_timestamp, TIMESTAMP '{RUN_TIME}' AS ingestion_time
  FROM o_price_fact_in
),
o_price_star AS (
  SELECT f.*, CAST(f.timestamp AS DATE) AS date, CAST(hour(f.timestamp) AS INTEGER) AS hour,
         CAST(month(f.timestamp) AS INTEGER) AS month, p.product_name, p.commodity_type, p.default_unit
  FROM o_fact_price f JOIN o_dim_product p ON p.product_code = f.product_code
),
o_rig_land AS (
  SELECT r.r_name AS region_raw, lower(n.n_name) AS country_raw,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'oil' ELSE 'GAS' END AS target_raw,
         CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN ' offshore ' ELSE 'land' END AS location_raw,
         {_rig_status} AS status_raw,
         CAST(year(o.o_orderdate) AS VARCHAR) AS year_raw, CAST(month(o.o_orderdate) AS VARCHAR) AS month_raw,
         CAST(COUNT(*) AS VARCHAR) AS count_raw
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
),
o_rig_typed AS (
  SELECT trim(region_raw) AS region, trim(country_raw) AS country, trim(target_raw) AS drilling_target,
         trim(location_raw) AS location_type, trim(status_raw) AS rig_status,
         {to_number('year_raw')} AS year_n, {to_number('month_raw')} AS month_n, {to_number('count_raw')} AS rig_count,
         CAST(year_raw AS INTEGER) AS o_year, CAST(month_raw AS INTEGER) AS o_month,
         region_raw, country_raw, target_raw, location_raw, status_raw
  FROM o_rig_land
),
o_rig AS (
  SELECT CAST(make_date(CAST(year_n AS INTEGER), CAST(month_n AS INTEGER), 1) AS TIMESTAMP) AS observation_date,
         {title('region')} AS region, upper(country) AS country, {title('drilling_target')} AS drilling_target,
         {title('location_type')} AS location_type, {title('rig_status')} AS rig_status,
         rig_count, '{RIG_SOURCE}' AS source, 'rig_count_monthly.csv' AS source_file,
         TIMESTAMP '{RUN_TIME}' AS ingestion_time
  FROM o_rig_typed
  WHERE region IS NOT NULL AND country IS NOT NULL AND drilling_target IS NOT NULL AND location_type IS NOT NULL
    AND rig_status IS NOT NULL AND year_n IS NOT NULL AND month_n IS NOT NULL AND rig_count IS NOT NULL
    AND month_n BETWEEN 1 AND 12 AND year_n BETWEEN 1900 AND 2100 AND rig_count >= 0
  QUALIFY row_number() OVER (
    PARTITION BY make_date(CAST(year_n AS INTEGER), CAST(month_n AS INTEGER), 1), upper(country),
                 {title('drilling_target')}, {title('location_type')}, {title('rig_status')}
    ORDER BY o_year DESC, o_month DESC, region_raw DESC, country_raw DESC, target_raw DESC,
             location_raw DESC, status_raw DESC) = 1
),
o_fact_rig AS (
  SELECT observation_date AS timestamp, upper(trim(country)) AS country_name,
         {title('trim(drilling_target)')} AS drilling_target, {title('trim(location_type)')} AS location_type,
         {title('trim(rig_status)')} AS rig_status, CAST(rig_count AS DECIMAL(12,4)) AS rig_count,
         source, source_file, ingestion_time AS source_ingestion_time,
         TIMESTAMP '{RUN_TIME}' AS warehouse_loaded_at
  FROM o_rig WHERE rig_count >= 0
),
o_dim_country AS (
  SELECT country_name, region FROM (
    SELECT upper(trim(country)) AS country_name, {title('trim(region)')} AS region, observation_date, region AS o_region, country AS o_country, drilling_target, location_type
    FROM o_rig
    QUALIFY row_number() OVER (PARTITION BY upper(trim(country)), country, region
                               ORDER BY observation_date, region, country, drilling_target, location_type) = 1
  ) f
  QUALIFY row_number() OVER (PARTITION BY country_name
                             ORDER BY observation_date DESC, o_region DESC, o_country DESC, drilling_target DESC, location_type DESC) = 1
),
o_rig_star AS (
  SELECT f.*, CAST(f.timestamp AS DATE) AS date, CAST(month(f.timestamp) AS INTEGER) AS month,
         CASE WHEN month(f.timestamp) IN (12, 1, 2) THEN 'Winter' WHEN month(f.timestamp) IN (3, 4, 5) THEN 'Spring'
              WHEN month(f.timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
         c.region
  FROM o_fact_rig f JOIN o_dim_country c ON c.country_name = f.country_name
),
o_dim_time AS (
  SELECT DISTINCT timestamp FROM (
    SELECT forecast_valid_time AS timestamp FROM o_atm
    UNION ALL SELECT forecast_valid_time FROM o_mar
    UNION ALL SELECT forecast_valid_time FROM o_risk
    UNION ALL SELECT timestamp FROM o_price_fact_in
    UNION ALL SELECT observation_date FROM o_rig
  ) u WHERE timestamp IS NOT NULL
),
o_run_src AS (
  SELECT user_id, MIN(ts) AS started, MAX(ts) AS finished,
         arg_max(event_type, ts) AS last_type
  FROM events GROUP BY user_id
),
o_runs AS (
  SELECT user_id AS pipeline_run_key, 'complete_energy_operations' AS pipeline_name, started AS started_at,
         CASE WHEN last_type <> 'signup' THEN finished END AS finished_at,
         CASE WHEN last_type <> 'signup' THEN
           CAST(((epoch_us(finished) - epoch_us(started)) * 2 + 1000) // 2000 AS DOUBLE) / 1000.0 END AS duration_seconds,
         CASE WHEN last_type = 'signup' THEN 'RUNNING' WHEN last_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN last_type = 'error' THEN 'quality gate failed' END AS error_message
  FROM o_run_src
),
o_checks AS (
  SELECT event_id AS quality_check_key, user_id AS pipeline_run_key, event_type || '_check' AS check_name,
         event_type <> 'error' AS passed, props AS check_value, 'no error events' AS expectation,
         CASE WHEN event_type = 'error' THEN 'error event' END AS details, ts AS checked_at
  FROM events
),
o_latest_run AS (
  SELECT pipeline_run_key FROM o_runs ORDER BY started_at DESC, pipeline_run_key DESC LIMIT 1
)
"""


def q(select: str) -> str:
    return "WITH " + CTES.strip() + "\n" + select


def _d(cols: list[str]) -> str:
    """Cast NUMERIC columns to DOUBLE (the compared form)."""
    return ", ".join(cols)


ATM_D = [f"CAST({n} AS DOUBLE) AS {n}" for n, _ in ATM_MEASURES]
MAR_D = [f"CAST({n} AS DOUBLE) AS {n}" for n in MAR_MEASURES]
OPERATIONAL_SELECT = (
    "asset_id, asset_name, asset_type, location_name, country, CAST(latitude AS DOUBLE) AS latitude, "
    "CAST(longitude AS DOUBLE) AS longitude, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, "
    + ", ".join(ATM_D) + ", weather_code, " + ", ".join(MAR_D)
    + ", wind_risk_level, gust_risk_level, wave_risk_level, visibility_risk_level, overall_risk_level, "
    "operation_recommendation, limiting_parameter"
)
WINDOW_COLS = (
    "asset_id, asset_name, asset_type, location_name, forecast_reference_time, forecast_valid_time, "
    "forecast_horizon_hours, CAST(wind_speed_kmh AS DOUBLE) AS wind_speed_kmh, "
    "CAST(wind_gust_kmh AS DOUBLE) AS wind_gust_kmh, CAST(wave_height_m AS DOUBLE) AS wave_height_m, "
    "CAST(visibility_m AS DOUBLE) AS visibility_m, overall_risk_level"
)
RISK_SUMMARY = q(f"""
SELECT asset_id, asset_name, asset_type, CAST(forecast_valid_time AS DATE) AS forecast_date,
       COUNT(*) AS forecast_hours, {level_counts()},
       CAST(MAX(wind_speed_kmh) AS DOUBLE) AS maximum_wind_speed_kmh,
       CAST(MAX(wind_gust_kmh) AS DOUBLE) AS maximum_wind_gust_kmh,
       CAST(MAX(wave_height_m) AS DOUBLE) AS maximum_wave_height_m,
       CAST(MIN(visibility_m) AS DOUBLE) AS minimum_visibility_m
FROM o_latest GROUP BY asset_id, asset_name, asset_type, CAST(forecast_valid_time AS DATE)
""")

_weather_run = f"""
  SELECT forecast_reference_time, MIN(forecast_valid_time) AS first_forecast_valid_time,
         MAX(forecast_valid_time) AS last_forecast_valid_time, COUNT(DISTINCT asset_id) AS monitored_assets,
         COUNT(*) AS forecast_hours, {level_counts()}
  FROM o_fact_risk WHERE forecast_reference_time = (SELECT MAX(forecast_reference_time) FROM o_fact_risk)
  GROUP BY forecast_reference_time
"""
_rig_latest = """
  SELECT date AS rig_count_date, CAST(SUM(rig_count) AS DOUBLE) AS total_rig_count,
         COUNT(DISTINCT country_name) AS countries_reporting
  FROM o_rig_star WHERE date = (SELECT MAX(date) FROM o_rig_star) GROUP BY date
"""
_price_latest = f"""
  SELECT date AS energy_price_date, {avg_exact('price_usd')} AS average_energy_price_usd,
         CAST(MIN(price_usd) AS DOUBLE) AS minimum_energy_price_usd,
         CAST(MAX(price_usd) AS DOUBLE) AS maximum_energy_price_usd, COUNT(*) AS energy_price_observations
  FROM o_price_star WHERE date = (SELECT MAX(date) FROM o_price_star) GROUP BY date
"""
_rig_monthly = """
  SELECT date, country_name, region, drilling_target, location_type, rig_status, SUM(rig_count) AS rig_count,
         SUM(CAST(rig_count * 10000 AS BIGINT)) AS units
  FROM o_rig_star GROUP BY date, country_name, region, drilling_target, location_type, rig_status
"""

EXEC_SELECT = f"""
SELECT TIMESTAMP '{RUN_TIME}' AS snapshot_generated_at, rig.*, price.*,
       weather.forecast_reference_time AS weather_forecast_reference_time, weather.first_forecast_valid_time,
       weather.last_forecast_valid_time, weather.monitored_assets, weather.forecast_hours, weather.green_hours,
       weather.amber_hours, weather.red_hours, weather.unknown_hours,
       {pct('weather.green_hours', 'weather.forecast_hours')} AS green_hours_percent,
       {pct('weather.amber_hours', 'weather.forecast_hours')} AS amber_hours_percent,
       {pct('weather.red_hours', 'weather.forecast_hours')} AS red_hours_percent
FROM ({_rig_latest}) rig CROSS JOIN ({_price_latest}) price CROSS JOIN ({_weather_run}) weather
"""

SQL: dict[str, str] = {
    # ---------------------------------------------------------------- weather
    "offshore_risk_summary": RISK_SUMMARY,
    "silver_atmospheric": q(
        "SELECT forecast_reference_time, forecast_valid_time, forecast_horizon_hours, asset_id, location_id, "
        "latitude, longitude, temperature_c, relative_humidity_pct, precipitation_mm, pressure_hpa, wind_speed_kmh, "
        "wind_direction_deg, wind_gust_kmh, visibility_m, weather_code, source, source_file FROM o_atm"
    ),
    "silver_marine": q(
        "SELECT forecast_reference_time, forecast_valid_time, forecast_horizon_hours, asset_id, location_id, latitude, "
        "longitude, " + ", ".join(MAR_MEASURES) + ", source, source_file FROM o_mar"
    ),
    "operational_risk": q("SELECT * FROM o_risk"),
    "risk_distribution": q("SELECT overall_risk_level, COUNT(*) AS hours FROM o_risk GROUP BY overall_risk_level"),
    "offshore_operational_forecast": q(f"SELECT {OPERATIONAL_SELECT} FROM o_operational"),
    "latest_offshore_forecast": q(f"SELECT {OPERATIONAL_SELECT} FROM o_latest"),
    "offshore_safe_windows": q(
        f"SELECT {WINDOW_COLS}, operation_recommendation FROM o_latest WHERE overall_risk_level = 'GREEN'"
    ),
    "offshore_critical_periods": q(
        f"SELECT {WINDOW_COLS}, limiting_parameter, operation_recommendation FROM o_latest "
        "WHERE overall_risk_level IN ('AMBER', 'RED')"
    ),
    "asset_kpis": q(f"""
SELECT asset_id, asset_name, asset_type, location_name, country, forecast_reference_time,
       MIN(forecast_valid_time) AS first_forecast_valid_time, MAX(forecast_valid_time) AS last_forecast_valid_time,
       COUNT(*) AS forecast_hours, {level_counts()},
       CAST(MAX(wind_speed_kmh) AS DOUBLE) AS maximum_wind_speed_kmh,
       CAST(MAX(wind_gust_kmh) AS DOUBLE) AS maximum_wind_gust_kmh,
       CAST(MAX(wave_height_m) AS DOUBLE) AS maximum_wave_height_m,
       CAST(MIN(visibility_m) AS DOUBLE) AS minimum_visibility_m,
       {avg_exact('temperature_c')} AS average_temperature_c,
       {avg_exact('sea_surface_temperature_c')} AS average_sea_surface_temperature_c,
       MIN(CASE WHEN overall_risk_level = 'RED' THEN forecast_valid_time END) AS first_red_risk_time,
       MIN(CASE WHEN overall_risk_level = 'GREEN' THEN forecast_valid_time END) AS first_green_window_time
FROM o_latest GROUP BY asset_id, asset_name, asset_type, location_name, country, forecast_reference_time
"""),
    "next_critical_event": q(f"""
SELECT {WINDOW_COLS}, limiting_parameter, operation_recommendation FROM o_latest
WHERE overall_risk_level IN ('AMBER', 'RED') AND forecast_valid_time >= TIMESTAMP '{AS_OF}'
QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY forecast_valid_time, forecast_reference_time) = 1
"""),
    "weather_run_summary": q(_weather_run),
    "latest_global_run": q(
        "SELECT forecast_reference_time, forecast_valid_time, asset_id, wind_risk_level, gust_risk_level, "
        "wave_risk_level, visibility_risk_level, overall_risk_level, operation_recommendation, limiting_parameter, "
        "source, ingestion_time FROM o_fact_risk "
        "WHERE forecast_reference_time = (SELECT MAX(forecast_reference_time) FROM o_fact_risk)"
    ),
    # ------------------------------------------------------------------ price
    "silver_price": q("SELECT timestamp, product_code, product, price_usd, unit, source, series, process_code FROM o_price"),
    "dim_product_rows": q("SELECT product_code, product_name, commodity_type, default_unit FROM o_dim_product"),
    "fact_price_rows": q(
        "SELECT product_code, CAST(price_usd AS DOUBLE) AS price_usd, unit, source, series, source_timestamp, "
        "ingestion_time FROM o_fact_price"
    ),
    "price_history": q(
        "SELECT timestamp, date, hour, month, "
        "CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring' "
        "WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season, product_code, product_name, "
        "commodity_type, default_unit, CAST(price_usd AS DOUBLE) AS price_usd, unit, source, series, "
        "source_timestamp, ingestion_time FROM o_price_star"
    ),
    "daily_price": q(f"""
SELECT date, product_code, product_name AS product, commodity_type, unit, source,
       {avg_exact('price_usd')} AS average_price_usd, CAST(MIN(price_usd) AS DOUBLE) AS minimum_price_usd,
       CAST(MAX(price_usd) AS DOUBLE) AS maximum_price_usd, COUNT(*) AS observations
FROM o_price_star GROUP BY date, product_code, product_name, commodity_type, unit, source
"""),
    "daily_price_summary": q(f"""
SELECT date, product_code, product_name, commodity_type, unit, source, series, COUNT(*) AS observation_count,
       CAST(MIN(price_usd) AS DOUBLE) AS minimum_price, CAST(MAX(price_usd) AS DOUBLE) AS maximum_price,
       {avg_exact('price_usd')} AS average_price, MIN(source_timestamp) AS first_observation,
       MAX(source_timestamp) AS last_observation
FROM o_price_star GROUP BY date, product_code, product_name, commodity_type, unit, source, series
"""),
    "latest_price_by_product": q("""
SELECT date, product_code, product_name AS product, commodity_type, CAST(price_usd AS DOUBLE) AS price_usd, unit, source
FROM o_price_star
QUALIFY row_number() OVER (PARTITION BY product_code
  ORDER BY date DESC, timestamp DESC, series DESC, price_usd DESC, unit DESC, source DESC) = 1
"""),
    "latest_price_by_series": q("""
SELECT timestamp, date, product_code, product_name, commodity_type, CAST(price_usd AS DOUBLE) AS price_usd, unit,
       source, series, source_timestamp, ingestion_time
FROM o_price_star
QUALIFY row_number() OVER (PARTITION BY product_code, series ORDER BY timestamp DESC, ingestion_time DESC, source DESC) = 1
"""),
    "price_summary": q("""
SELECT product_code, product_name AS product, commodity_type, MIN(date) AS first_observation_date,
       MAX(date) AS latest_observation_date, COUNT(*) AS total_observations,
       CAST((2 * SUM(CAST(price_usd * 10000 AS BIGINT)) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10000.0 AS average_price_usd,
       CAST(MIN(price_usd) AS DOUBLE) AS minimum_price_usd, CAST(MAX(price_usd) AS DOUBLE) AS maximum_price_usd,
       MAX(unit) AS unit, MAX(source) AS source
FROM o_price_star GROUP BY product_code, product_name, commodity_type
"""),
    "latest_price_summary": q(_price_latest),
    # -------------------------------------------------------------------- rig
    "silver_rig": q(
        "SELECT observation_date, region, country, drilling_target, location_type, rig_status, rig_count, source, "
        "source_file, ingestion_time FROM o_rig"
    ),
    "dim_country_rows": q("SELECT country_name, region FROM o_dim_country"),
    "dim_rig_classification_rows": q(
        "SELECT DISTINCT drilling_target, location_type, rig_status FROM o_fact_rig"
    ),
    "fact_rig_rows": q(
        "SELECT timestamp AS observation_date, country_name, drilling_target, location_type, rig_status, "
        "CAST(rig_count AS DOUBLE) AS rig_count, source, source_file, source_ingestion_time, warehouse_loaded_at "
        "FROM o_fact_rig"
    ),
    "rig_count_history": q(
        "SELECT timestamp, date, month, season, country_name, region, drilling_target, location_type, rig_status, "
        "CAST(rig_count AS DOUBLE) AS rig_count, source, source_file, source_ingestion_time, warehouse_loaded_at "
        "FROM o_rig_star"
    ),
    "rig_country_monthly": q(
        "SELECT date, region, country_name, drilling_target, location_type, rig_status, "
        "CAST(SUM(rig_count) AS DOUBLE) AS rig_count, source FROM o_rig_star GROUP BY ALL"
    ),
    "rig_region_monthly": q(
        "SELECT date, region, drilling_target, location_type, rig_status, CAST(SUM(rig_count) AS DOUBLE) AS rig_count, "
        "COUNT(DISTINCT country_name) AS country_count FROM o_rig_star GROUP BY date, region, drilling_target, "
        "location_type, rig_status"
    ),
    "latest_rig_count": q("""
SELECT timestamp, date, country_name, region, drilling_target, location_type, rig_status,
       CAST(rig_count AS DOUBLE) AS rig_count, source, source_file, source_ingestion_time, warehouse_loaded_at
FROM o_rig_star
QUALIFY row_number() OVER (PARTITION BY country_name, drilling_target, location_type, rig_status, source
                           ORDER BY timestamp DESC, warehouse_loaded_at DESC) = 1
"""),
    "latest_rig_summary": q(_rig_latest),
    # ------------------------------------------------------------- integrated
    "executive_snapshot": q(EXEC_SELECT),
    # ---------------------------------------------------------- observability
    "latest_pipeline_run": q(
        "SELECT * FROM o_runs ORDER BY started_at DESC, pipeline_run_key DESC LIMIT 1"
    ),
    "quality_summary": q(f"""
SELECT c.pipeline_run_key, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
       COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
       {pct('COUNT(*) FILTER (WHERE passed)', 'COUNT(*)')} AS pass_rate_percent
FROM o_checks c JOIN o_latest_run r ON r.pipeline_run_key = c.pipeline_run_key GROUP BY c.pipeline_run_key
"""),
    "quality_summary_total": q(f"""
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
       COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
       COALESCE({pct('COUNT(*) FILTER (WHERE passed)', 'COUNT(*)')}, 0.0) AS pass_rate_percent
FROM o_checks c JOIN o_latest_run r ON r.pipeline_run_key = c.pipeline_run_key
"""),
    "latest_quality_checks": q(
        "SELECT c.* FROM o_checks c JOIN o_latest_run r ON r.pipeline_run_key = c.pipeline_run_key"
    ),
    "run_history": q("""
SELECT r.*, COUNT(c.quality_check_key) AS total_checks,
       COUNT(c.quality_check_key) FILTER (WHERE c.passed) AS passed_checks,
       COUNT(c.quality_check_key) FILTER (WHERE NOT c.passed) AS failed_checks
FROM o_runs r LEFT JOIN o_checks c ON c.pipeline_run_key = r.pipeline_run_key
GROUP BY ALL
"""),
}

SQL["rig_monthly_change"] = q(f"""
SELECT date, country_name, region, drilling_target, location_type, rig_status,
       CAST(rig_count AS DOUBLE) AS rig_count, CAST(previous_month_rig_count AS DOUBLE) AS previous_month_rig_count,
       CAST(rig_count - previous_month_rig_count AS DOUBLE) AS monthly_change,
       CASE WHEN prev_units IS NULL OR prev_units = 0 THEN NULL ELSE
         sign(units - prev_units) * CAST(
           (2 * abs(units - prev_units) * 10000 + prev_units) // (2 * prev_units) AS DOUBLE) / 100.0
       END AS monthly_change_percent
FROM (
  SELECT *,
         LAG(rig_count) OVER (PARTITION BY country_name, drilling_target, location_type, rig_status ORDER BY date)
           AS previous_month_rig_count,
         CAST(LAG(units) OVER (PARTITION BY country_name, drilling_target, location_type, rig_status ORDER BY date)
           AS HUGEINT) AS prev_units
  FROM ({_rig_monthly}) m
) w
""")

SQL["dim_time_rows"] = q(f"""
SELECT timestamp, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(month(timestamp) AS INTEGER) AS month,
       CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'Winter' WHEN month(timestamp) IN (3, 4, 5) THEN 'Spring'
            WHEN month(timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
       TIMESTAMP '{RUN_TIME}' AS created_at
FROM o_dim_time
""")
SQL["dim_location_rows"] = q(
    "SELECT location_id, location_name, country, CAST(latitude AS DOUBLE) AS latitude, "
    "CAST(longitude AS DOUBLE) AS longitude FROM o_dim_location"
)
SQL["dim_asset_rows"] = q(
    "SELECT asset_id, asset_name, asset_type, operator_name, location_id, is_active, "
    "CAST(max_wind_kmh AS DOUBLE) AS max_wind_kmh, CAST(max_gust_kmh AS DOUBLE) AS max_gust_kmh, "
    "CAST(max_wave_height_m AS DOUBLE) AS max_wave_height_m, "
    "CAST(minimum_visibility_m AS DOUBLE) AS minimum_visibility_m FROM o_dim_asset"
)
SQL["fact_forecast_rows"] = q(
    "SELECT asset_id, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, "
    + ", ".join(ATM_D) + ", weather_code, source, ingestion_time FROM o_fact_weather"
)
SQL["fact_marine_rows"] = q(
    "SELECT asset_id, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, "
    + ", ".join(MAR_D) + ", source, ingestion_time FROM o_fact_marine"
)
SQL["fact_risk_rows"] = q("SELECT * FROM o_fact_risk")

# ----------------------------------------------------------------- serving
ASSET_D = (
    "a.asset_id, a.asset_name, a.asset_type, a.operator_name, a.is_active, CAST(a.max_wind_kmh AS DOUBLE) AS max_wind_kmh, "
    "CAST(a.max_gust_kmh AS DOUBLE) AS max_gust_kmh, CAST(a.max_wave_height_m AS DOUBLE) AS max_wave_height_m, "
    "CAST(a.minimum_visibility_m AS DOUBLE) AS minimum_visibility_m, l.location_name, l.country, "
    "CAST(l.latitude AS DOUBLE) AS latitude, CAST(l.longitude AS DOUBLE) AS longitude"
)
_current_risk = f"""
  SELECT asset_id, forecast_reference_time, forecast_valid_time, overall_risk_level FROM o_fact_risk
  WHERE forecast_reference_time = (SELECT MAX(forecast_reference_time) FROM o_fact_risk)
    AND forecast_valid_time >= TIMESTAMP '{AS_OF}'
  QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY forecast_valid_time, source) = 1
"""
_asset_map = f"""
  SELECT a.asset_id, a.asset_name, a.asset_type, a.operator_name, l.location_name, l.country,
         CAST(l.latitude AS DOUBLE) AS latitude, CAST(l.longitude AS DOUBLE) AS longitude,
         CAST(a.max_wind_kmh AS DOUBLE) AS max_wind_kmh, CAST(a.max_gust_kmh AS DOUBLE) AS max_gust_kmh,
         CAST(a.max_wave_height_m AS DOUBLE) AS max_wave_height_m,
         CAST(a.minimum_visibility_m AS DOUBLE) AS minimum_visibility_m,
         r.forecast_reference_time, r.forecast_valid_time, COALESCE(r.overall_risk_level, 'UNKNOWN') AS overall_risk_level,
         l.latitude AS lat_dec, l.longitude AS lon_dec
  FROM o_dim_asset a JOIN o_dim_location l ON l.location_id = a.location_id
  LEFT JOIN ({_current_risk}) r ON r.asset_id = a.asset_id
  WHERE a.is_active
"""
_daily_price = f"""
  SELECT date, product_code, product_name AS product, commodity_type, unit, source,
         {avg_exact('price_usd')} AS average_price_usd
  FROM o_price_star GROUP BY date, product_code, product_name, commodity_type, unit, source
"""
_region_monthly = """
  SELECT date, region, drilling_target, location_type, rig_status, CAST(SUM(rig_count) AS DOUBLE) AS rig_count,
         COUNT(DISTINCT country_name) AS country_count
  FROM o_rig_star GROUP BY date, region, drilling_target, location_type, rig_status
"""


def fmt3(x: str) -> str:
    return f"COALESCE(format('{{:,.3f}}', {x}), '—')"


SQL.update({
    "serve_assets": q(f"SELECT {ASSET_D} FROM o_dim_asset a JOIN o_dim_location l ON l.location_id = a.location_id WHERE a.is_active"),
    "asset_map": q(
        "SELECT asset_id, asset_name, asset_type, operator_name, location_name, country, latitude, longitude, "
        "max_wind_kmh, max_gust_kmh, max_wave_height_m, minimum_visibility_m, forecast_reference_time, "
        f"forecast_valid_time, overall_risk_level FROM ({_asset_map}) m"
    ),
    "asset_map_center": q(
        f"SELECT {avg_exact('lat_dec')} AS center_latitude, {avg_exact('lon_dec')} AS center_longitude, "
        f"COUNT(*) AS assets_on_map FROM ({_asset_map}) m WHERE lat_dec IS NOT NULL AND lon_dec IS NOT NULL"
    ),
    "serve_risk_distribution": q(
        f"SELECT 'GREEN' AS risk, green_hours AS hours FROM ({EXEC_SELECT}) x "
        f"UNION ALL SELECT 'AMBER', amber_hours FROM ({EXEC_SELECT}) x "
        f"UNION ALL SELECT 'RED', red_hours FROM ({EXEC_SELECT}) x "
        f"UNION ALL SELECT 'UNKNOWN', unknown_hours FROM ({EXEC_SELECT}) x"
    ),
    "serve_param_query": q(f"SELECT {OPERATIONAL_SELECT} FROM o_latest WHERE asset_name = 'Customer#000000003'"),
    "serve_current_conditions": q(f"""
SELECT asset_id, asset_name, forecast_valid_time, CAST(temperature_c AS DOUBLE) AS temperature_c,
       CAST(wind_speed_kmh AS DOUBLE) AS wind_speed_kmh, CAST(wind_gust_kmh AS DOUBLE) AS wind_gust_kmh,
       CAST(wave_height_m AS DOUBLE) AS wave_height_m, CAST(visibility_m AS DOUBLE) AS visibility_m,
       overall_risk_level, limiting_parameter
FROM o_latest WHERE forecast_valid_time IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY asset_id
  ORDER BY CASE WHEN forecast_valid_time >= TIMESTAMP '{AS_OF}' THEN 0 ELSE 1 END, forecast_valid_time) = 1
"""),
    "serve_wind_long": q(
        "SELECT asset_id, forecast_valid_time, 'wind_speed_kmh' AS variable, CAST(wind_speed_kmh AS DOUBLE) AS km_h FROM o_latest "
        "UNION ALL SELECT asset_id, forecast_valid_time, 'wind_gust_kmh', CAST(wind_gust_kmh AS DOUBLE) FROM o_latest"
    ),
    "serve_risk_timeline": q(
        "SELECT asset_id, forecast_valid_time, upper(COALESCE(overall_risk_level, 'UNKNOWN')) AS overall_risk_level, "
        + score("upper(COALESCE(overall_risk_level, 'UNKNOWN'))") + " AS risk_score FROM o_latest"
    ),
    "serve_rig_kpis": q("""
SELECT CAST(SUM(rig_count) AS DOUBLE) AS latest_rig_count, COUNT(DISTINCT country_name) AS countries_reporting
FROM (SELECT * FROM o_rig_star
      QUALIFY row_number() OVER (PARTITION BY country_name, drilling_target, location_type, rig_status, source
                                 ORDER BY timestamp DESC, warehouse_loaded_at DESC) = 1) l
"""),
    "serve_region_snapshot": q(
        f"SELECT * FROM ({_region_monthly}) r WHERE date = (SELECT MAX(date) FROM o_rig_star)"
    ),
    "serve_region_totals": q(
        "SELECT date, region, CAST(SUM(rig_count) AS DOUBLE) AS rig_count, COUNT(DISTINCT country_name) AS country_count "
        "FROM o_rig_star GROUP BY date, region"),
    "serve_price_kpis": q(f"""
SELECT MAX(d.date) AS latest_date,
       concat_ws(' ', {fmt3('MAX(lst.average_price_usd)')}, MAX(lst.unit)) AS latest_price,
       {fmt3('AVG(d.average_price_usd)')} AS average_price,
       {fmt3('MIN(d.average_price_usd)')} AS minimum_price,
       {fmt3('MAX(d.average_price_usd)')} AS maximum_price,
       MIN(d.average_price_usd) AS minimum_daily_average, MAX(d.average_price_usd) AS maximum_daily_average
FROM ({_daily_price}) d
CROSS JOIN (SELECT average_price_usd, unit FROM ({_daily_price}) z
            ORDER BY date DESC, product_code DESC, unit DESC, source DESC LIMIT 1) lst
"""),
    "serve_date_labels": q(f"""
SELECT DISTINCT date, strftime(date, '%Y-%m-%d') AS day_label, strftime(date, '%Y-%m') AS month_label,
       strftime(CAST(date AS TIMESTAMP), '%Y%m%d_%H%M%S') AS stamp_label
FROM ({_region_monthly}) r
"""),
})

# ------------------------------------------------------------------ quality
_TABLE_SRC = {
    "fact_weather_forecast": "o_fact_weather",
    "fact_marine_forecast": "o_fact_marine",
    "fact_operational_weather_risk": "o_fact_risk",
    "fact_rig_count": "o_fact_rig",
    "fact_oil_price": "o_fact_price",
}
_GRAIN = "asset_id, forecast_reference_time, forecast_valid_time, source"

# Name and expectation of each check, and the detail texts.
CHECKS = {
    "tables": ("Required tables", "11 required tables"),
    "views": ("Required analytical views", "7 required views"),
    "rows": ("{table} row count", "Greater than zero"),
    "alignment": ("Historical weather table alignment", "Atmospheric, marine, and risk tables have equal row counts"),
    "latest_alignment": ("Latest weather-run alignment", "Latest forecast run has equal row counts across all weather facts"),
    "dup_atmospheric": ("Atmospheric duplicate grain", "Zero duplicate groups"),
    "dup_marine": ("Marine duplicate grain", "Zero duplicate groups"),
    "dup_risk": ("Risk duplicate grain", "Zero duplicate groups"),
    "orphan_weather": ("Weather asset references", "Zero orphan asset keys"),
    "orphan_marine": ("Marine asset references", "Zero orphan asset keys"),
    "asset_locations": ("Active asset locations", "Every active asset has a location"),
    "humidity": ("Relative humidity range", "All values between 0 and 100"),
    "wave": ("Wave-height range", "No negative wave heights"),
    "visibility": ("Visibility range", "No negative visibility"),
    "levels": ("Operational risk categories", "Only GREEN, AMBER, RED, or UNKNOWN"),
    "snapshot": ("Executive snapshot grain", "Exactly one row"),
    "kpi_coverage": ("Asset KPI coverage", "One KPI row per active asset"),
    "latest_forecast": ("Latest offshore forecast", "Greater than zero"),
}
ROWS_PRESENT, ROWS_ABSENT = "Dataset contains records.", "Dataset is empty."
ALL_PRESENT = "All required {what} exist."


def _check(check: str, passed: str, value: str, details: str = "NULL", src: str = "", **fmt: str) -> str:
    name, expectation = CHECKS[check]
    return (f"SELECT '{name.format(**fmt)}' AS check_name, {passed} AS passed, CAST({value} AS VARCHAR) AS check_value, "
            f"'{expectation}' AS expectation, CAST({details} AS VARCHAR) AS details {src}")


def _latest_count(src: str) -> str:
    return (f"(SELECT COUNT(*) FROM {src} WHERE forecast_reference_time = "
            f"(SELECT MAX(forecast_reference_time) FROM {src}))")


def _json3(a: str, m: str, r: str) -> str:
    return f"""'{{"atmospheric":' || {a} || ',"marine":' || {m} || ',"risk":' || {r} || '}}'"""


_checks = [
    _check("tables", "TRUE", "'11'", "'" + ALL_PRESENT.format(what="tables") + "'"),
    _check("views", "TRUE", "'7'", "'" + ALL_PRESENT.format(what="views") + "'"),
]
for _t, _src in _TABLE_SRC.items():
    _checks.append(_check("rows", "n > 0", "n",
                          f"CASE WHEN n > 0 THEN '{ROWS_PRESENT}' ELSE '{ROWS_ABSENT}' END",
                          f"FROM (SELECT COUNT(*) AS n FROM {_src}) c", table=_t))
_a, _m, _r = "(SELECT COUNT(*) FROM o_fact_weather)", "(SELECT COUNT(*) FROM o_fact_marine)", "(SELECT COUNT(*) FROM o_fact_risk)"
_checks.append(_check("alignment", f"{_a} = {_m} AND {_m} = {_r}", _json3(_a, _m, _r)))
_la, _lm, _lr = _latest_count("o_fact_weather"), _latest_count("o_fact_marine"), _latest_count("o_fact_risk")
_checks.append(_check("latest_alignment", f"{_la} = {_lm} AND {_lm} = {_lr}", _json3(_la, _lm, _lr)))
for _c, _src in [("dup_atmospheric", "o_fact_weather"), ("dup_marine", "o_fact_marine"), ("dup_risk", "o_fact_risk")]:
    _checks.append(_check(_c, "n = 0", "n",
                          src=f"FROM (SELECT COUNT(*) AS n FROM (SELECT {_GRAIN} FROM {_src} GROUP BY ALL HAVING COUNT(*) > 1) d) c"))
for _c, _src in [("orphan_weather", "o_fact_weather"), ("orphan_marine", "o_fact_marine")]:
    _checks.append(_check(_c, "n = 0", "n",
                          src=f"FROM (SELECT COUNT(*) AS n FROM {_src} f ANTI JOIN o_dim_asset a ON a.asset_id = f.asset_id) c"))
_checks.append(_check("asset_locations", "n = 0", "n",
                      src="FROM (SELECT COUNT(*) AS n FROM o_dim_asset a ANTI JOIN o_dim_location l "
                          "ON l.location_id = a.location_id WHERE a.is_active) c"))
_checks.append(_check("humidity", "n = 0", "n",
                      src="FROM (SELECT COUNT(*) FILTER (WHERE NOT (relative_humidity_pct BETWEEN 0 AND 100)) AS n FROM o_fact_weather) c"))
_checks.append(_check("wave", "n = 0", "n",
                      src="FROM (SELECT COUNT(*) FILTER (WHERE wave_height_m < 0) AS n FROM o_fact_marine) c"))
_checks.append(_check("visibility", "n = 0", "n",
                      src="FROM (SELECT COUNT(*) FILTER (WHERE visibility_m < 0) AS n FROM o_fact_weather) c"))
_checks.append(_check("levels", "n = 0", "n",
                      src="FROM (SELECT COUNT(*) FILTER (WHERE overall_risk_level NOT IN ('UNKNOWN', 'GREEN', 'AMBER', 'RED')) AS n FROM o_fact_risk) c"))
_checks.append(_check("snapshot", "n = 1", "n", src=f"FROM (SELECT COUNT(*) AS n FROM ({EXEC_SELECT}) x) c"))
_kpi_rows = "(SELECT COUNT(*) FROM (SELECT DISTINCT asset_id, forecast_reference_time FROM o_latest) k)"
_active = "(SELECT COUNT(*) FROM o_dim_asset WHERE is_active)"
_checks.append(_check("kpi_coverage", f"{_kpi_rows} = {_active}",
                      f"""'{{"view_rows":' || {_kpi_rows} || ',"active_assets":' || {_active} || '}}'"""))
_checks.append(_check("latest_forecast", "n > 0", "n", src="FROM (SELECT COUNT(*) AS n FROM o_latest) c"))
SQL["dq_checks"] = q("\nUNION ALL\n".join(_checks))


def _cv(table: str, name: str, src: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, ({src}) AS violations"


def _cnt(src: str, cond: str) -> str:
    return f"SELECT COUNT(*) FILTER (WHERE {cond}) FROM {src}"


_LEVELS = "('UNKNOWN', 'GREEN', 'AMBER', 'RED')"
_keys_nn = "asset_id IS NULL OR forecast_reference_time IS NULL OR forecast_valid_time IS NULL OR source IS NULL"
_cvs = [
    _cv("fact_weather_forecast", "keys_not_null", _cnt("o_fact_weather", _keys_nn)),
    _cv("fact_weather_forecast", "horizon_not_negative", _cnt("o_fact_weather", "forecast_horizon_hours < 0")),
    _cv("fact_weather_forecast", "humidity_range", _cnt("o_fact_weather", "NOT (relative_humidity_pct BETWEEN 0 AND 100)")),
    _cv("fact_weather_forecast", "source_length", _cnt("o_fact_weather", "length(source) > 100")),
    _cv("fact_marine_forecast", "keys_not_null", _cnt("o_fact_marine", _keys_nn)),
    _cv("fact_marine_forecast", "horizon_not_negative", _cnt("o_fact_marine", "forecast_horizon_hours < 0")),
    _cv("fact_marine_forecast", "wave_not_negative", _cnt("o_fact_marine", "wave_height_m < 0")),
    _cv("fact_operational_weather_risk", "keys_not_null", _cnt("o_fact_risk", _keys_nn)),
]
for _c in ["wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level", "overall_risk_level"]:
    _cvs.append(_cv("fact_operational_weather_risk", f"{_c}_domain", _cnt("o_fact_risk", f"{_c} NOT IN {_LEVELS} OR {_c} IS NULL")))
_cvs += [
    _cv("fact_operational_weather_risk", "recommendation_length", _cnt("o_fact_risk", "length(operation_recommendation) > 255")),
    _cv("fact_oil_price", "price_not_negative", _cnt("o_fact_price", "price_usd < 0")),
    _cv("fact_oil_price", "series_length", _cnt("o_fact_price", "length(series) > 150")),
    _cv("fact_rig_count", "rig_count_not_negative", _cnt("o_fact_rig", "rig_count < 0")),
    _cv("dim_time", "hour_range", _cnt("o_dim_time", "NOT (hour(timestamp) BETWEEN 0 AND 23)")),
    _cv("dim_time", "month_range", _cnt("o_dim_time", "NOT (month(timestamp) BETWEEN 1 AND 12)")),
    _cv("dim_asset", "asset_id_length", _cnt("o_dim_asset", "length(asset_id) > 50")),
    _cv("dim_asset", "name_length", _cnt("o_dim_asset", "length(asset_name) > 150")),
    _cv("fact_pipeline_run", "status_domain", _cnt("o_runs", "status NOT IN ('RUNNING', 'SUCCESS', 'FAILED')")),
]


def _dups(src: str, keys: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {keys} FROM {src} GROUP BY ALL HAVING COUNT(*) > 1) d"


for _t, _src in [("fact_weather_forecast", "o_fact_weather"), ("fact_marine_forecast", "o_fact_marine"),
                 ("fact_operational_weather_risk", "o_fact_risk")]:
    _cvs.append(_cv(_t, "unique_asset_key_forecast_reference_time_forecast_valid_time_source", _dups(_src, _GRAIN)))
    _cvs.append(_cv(_t, "fk_asset_key", f"SELECT COUNT(*) FROM {_src} f ANTI JOIN o_dim_asset a ON a.asset_id = f.asset_id"))
    _cvs.append(_cv(_t, "fk_time_key", f"SELECT COUNT(*) FROM {_src} f ANTI JOIN o_dim_time d ON d.timestamp = f.forecast_valid_time"))
_cvs += [
    _cv("fact_oil_price", "unique_time_key_product_key_source_series", _dups("o_fact_price", "timestamp, product_code, source, series")),
    _cv("fact_rig_count", "unique_time_key_country_key_rig_classification_key_source",
        _dups("o_fact_rig", "timestamp, country_name, drilling_target, location_type, rig_status, source")),
    _cv("fact_oil_price", "fk_product_key", "SELECT COUNT(*) FROM o_fact_price f ANTI JOIN o_dim_product p ON p.product_code = f.product_code"),
    _cv("fact_rig_count", "fk_country_key", "SELECT COUNT(*) FROM o_fact_rig f ANTI JOIN o_dim_country c ON c.country_name = f.country_name"),
    _cv("dim_asset", "fk_location_key", "SELECT COUNT(*) FROM o_dim_asset a ANTI JOIN o_dim_location l ON l.location_id = a.location_id"),
]
for _t, _src, _nat in [
    ("dim_location", "o_dim_location", "location_id"), ("dim_time", "o_dim_time", "timestamp"),
    ("dim_asset", "o_dim_asset", "asset_id"), ("dim_energy_product", "o_dim_product", "product_code"),
    ("dim_country", "o_dim_country", "country_name"),
    ("dim_rig_classification", "(SELECT DISTINCT drilling_target, location_type, rig_status FROM o_fact_rig)",
     "drilling_target, location_type, rig_status"),
]:
    _key = {"dim_location": "location_key", "dim_time": "time_key", "dim_asset": "asset_key",
            "dim_energy_product": "product_key", "dim_country": "country_key",
            "dim_rig_classification": "rig_classification_key"}[_t]
    _cvs.append(_cv(_t, "unique_" + _nat.replace(", ", "_"), _dups(_src, _nat)))
    _cvs.append(_cv(_t, "unique_" + _key, _dups(_src, _nat)))
SQL["src_silver_contract"] = q(
    "SELECT asset_id, forecast_reference_time, forecast_valid_time, forecast_horizon_hours, temperature_c, source "
    "FROM o_atm WHERE hour(forecast_valid_time) % 7 <> 3 AND hour(forecast_valid_time) <> 5")
SQL["constraint_violations"] = q("\nUNION ALL\n".join(_cvs))

# -------------------------------------------------------- second deliveries
_season = ("CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'Winter' WHEN month(timestamp) IN (3, 4, 5) THEN 'Spring' "
           "WHEN month(timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")
_weather_stamps = ("SELECT forecast_valid_time AS timestamp FROM o_atm UNION SELECT forecast_valid_time FROM o_mar "
                   "UNION SELECT forecast_valid_time FROM o_risk")
_simple = f"""
  SELECT 25.0::DOUBLE AS latitude, 55.0::DOUBLE AS longitude, 'GMT' AS timezone,
         date_trunc('minute', ts) AS timestamp,
         COALESCE(value / 10, 0.0) AS temperature_c,
         COALESCE(CASE WHEN event_type <> 'error' THEN {K} END, 0.0) AS humidity,
         COALESCE(CASE WHEN event_type <> 'signup' THEN value END, 0.0) AS wind_kmh,
         TIMESTAMP '{RUN_TIME}' AS ingestion_time, 'LOC-0' AS location_id
  FROM events
"""
SQL.update({
    "reload_dim_asset": q(f"""
SELECT asset_id, asset_name, CAST(CAST(max_wind_kmh + 5 AS DECIMAL(8,2)) AS DOUBLE) AS max_wind_kmh,
       CAST(max_gust_kmh AS DOUBLE) AS max_gust_kmh, TIMESTAMP '{RUN_TIME}' AS created_at,
       TIMESTAMP '{RUN_TIME_2}' AS updated_at
FROM o_dim_asset
"""),
    "reload_dim_rig_classification": q(
        f"SELECT DISTINCT drilling_target, location_type, rig_status, TIMESTAMP '{RUN_TIME}' AS created_at, "
        f"TIMESTAMP '{RUN_TIME_2}' AS updated_at FROM o_fact_rig"),
    "redelivery_weather_fact": q(
        "SELECT asset_id, forecast_reference_time, forecast_valid_time, CAST(wind_speed_kmh AS DOUBLE) AS wind_speed_kmh, "
        f"source, TIMESTAMP '{RUN_TIME_2}' AS ingestion_time FROM o_fact_weather"),
    "dim_time_incremental": q(f"""
SELECT timestamp, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(month(timestamp) AS INTEGER) AS month, {_season} AS season,
       CASE WHEN timestamp IN ({_weather_stamps}) THEN TIMESTAMP '{RUN_TIME}' ELSE TIMESTAMP '{RUN_TIME_2}' END AS created_at
FROM o_dim_time
"""),
    "assets_without_forecast": q(
        "SELECT asset_id, asset_name FROM o_dim_asset a WHERE asset_id NOT IN (SELECT asset_id FROM o_fact_weather)"),
    "products_in_batch": q(
        "SELECT product_code, product_name FROM o_dim_product WHERE product_code IN (SELECT product_code FROM o_price_fact_in)"),
    "simple_weather_clean": q(
        "SELECT latitude, longitude, timezone, timestamp, temperature_c, humidity, wind_kmh, ingestion_time, "
        f"location_id FROM ({_simple}) s"),
    "fact_simple_weather": q(
        "SELECT s.location_id IN (SELECT location_id FROM o_dim_location) AS location_resolved, "
        "s.timestamp IN (SELECT timestamp FROM o_dim_time) AS time_resolved, "
        f"temperature_c, humidity, wind_kmh, ingestion_time FROM ({_simple}) s"),
})


# ------------------------------------------------------ compared form of dates
# DATE outputs are compared as TIMESTAMP at midnight on both sides (see
# ``registry.comparable``); these are the DATE columns of each query.
DATE_COLUMNS = {
    "daily_price": [
        "date"
    ],
    "daily_price_summary": [
        "date"
    ],
    "dim_time_incremental": [
        "date"
    ],
    "dim_time_rows": [
        "date"
    ],
    "executive_snapshot": [
        "rig_count_date",
        "energy_price_date"
    ],
    "latest_price_by_product": [
        "date"
    ],
    "latest_price_by_series": [
        "date"
    ],
    "latest_price_summary": [
        "energy_price_date"
    ],
    "latest_rig_count": [
        "date"
    ],
    "latest_rig_summary": [
        "rig_count_date"
    ],
    "offshore_risk_summary": [
        "forecast_date"
    ],
    "price_history": [
        "date"
    ],
    "price_summary": [
        "first_observation_date",
        "latest_observation_date"
    ],
    "rig_count_history": [
        "date"
    ],
    "rig_country_monthly": [
        "date"
    ],
    "rig_monthly_change": [
        "date"
    ],
    "rig_region_monthly": [
        "date"
    ],
    "serve_date_labels": [
        "date"
    ],
    "serve_price_kpis": [
        "latest_date"
    ],
    "serve_region_snapshot": [
        "date"
    ],
    "serve_region_totals": [
        "date"
    ],
}


# Landed documents: the arrays hold the same readings, so Silver is the same.
SQL["silver_atmospheric_landed"] = SQL["silver_atmospheric"]
_DOCUMENT = "PARTITION BY user_id, date_trunc('week', ts), event_id // 1000"
SQL["explode_hourly_padded"] = f"""
WITH hours AS (
  SELECT *, event_id // 1000 AS document, date_trunc('week', ts) AS week,
         row_number() OVER ({_DOCUMENT} ORDER BY event_id) - 1 AS position
  FROM events),
winds AS (
  SELECT user_id, event_id // 1000 AS document, date_trunc('week', ts) AS week, value,
         row_number() OVER ({_DOCUMENT} ORDER BY event_id) - 1 AS position
  FROM events WHERE event_type <> 'signup')
SELECT CAST(h.user_id AS VARCHAR) AS asset_id, h.document, CAST(h.week AS TIMESTAMP) AS forecast_reference_time,
       h.position, date_trunc('hour', h.ts) AS forecast_valid_time, w.value AS wind_speed
FROM hours h LEFT JOIN winds w USING (user_id, document, week, position)
"""
SQL["contract_hourly_arrays"] = """
SELECT CAST(user_id AS VARCHAR) AS asset_id, 'wind_speed_10m: length differs from time' AS problems
FROM events GROUP BY user_id, date_trunc('week', ts), event_id // 1000
HAVING count(*) FILTER (WHERE event_type = 'signup') > 0
"""
SQL["attach_by_position"] = """
SELECT c_custkey AS request_index, CAST(c_custkey AS VARCHAR) AS asset_id, c_name AS asset_name, c_acctbal AS response
FROM customer
"""

# The same readings, records and rows read back from landed files.
SQL["silver_atmospheric_files"] = SQL["silver_atmospheric"]
SQL["silver_price_landed"] = SQL["silver_price"]
SQL["silver_rig_files"] = f"SELECT * EXCLUDE (source_file) FROM ({SQL['silver_rig']}) AS sheet"
SQL["bronze_rig_rows"] = q(f"""
SELECT region_raw AS region, country_raw AS country, target_raw AS drillfor, location_raw AS location,
       status_raw AS rig_status, year_raw AS year, month_raw AS month, count_raw AS rig_count_value,
       'rig_count_monthly.csv' AS source_file, TIMESTAMP '{RUN_TIME}' AS ingestion_time,
       date_trunc('day', TIMESTAMP '{RUN_TIME}') AS ingest_date
FROM o_rig_land""")
DATE_COLUMNS.update({name: DATE_COLUMNS[like] for name, like in (
    ("silver_rig_files", "silver_rig"), ("silver_price_landed", "silver_price")) if like in DATE_COLUMNS})


def _dates_as_timestamps(name: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(name)
    if not cols:
        return sql
    replace = ", ".join(f'CAST("{c}" AS TIMESTAMP) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({replace}) FROM (\n{sql}\n) AS compared"


SQL = {name: _dates_as_timestamps(name, sql) for name, sql in SQL.items()}
