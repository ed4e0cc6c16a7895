"""Stand-in inputs built from the driver's test tables.

The test tables hold no forecasts, prices or rig counts, so each function
here projects a test table into the *input* shape a job expects (landed
hourly readings, price records, rig-sheet rows, asset registry, run
events).  They only rename and map columns; every cleaning, dedupe, rule,
load and view step then runs on these rows through the library's own
code, exactly as it would on landed files.

The mappings are fixed and mirrored one to one by the DuckDB oracle
(``tidewatch.oracle``).  Numeric mappings use only factors whose results
have at most three decimals or never end in an exact half (``* 1.4``,
``/ 10``, ``/ 30``), so NUMERIC(p,3) storage rounds the same in both
engines.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters shared with the oracle.
AS_OF = "2024-01-29 12:00:00"  # "now" for future-only views
RUN_TIME = "2024-02-01 00:00:00"  # load / ingestion time of the run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _k(props: str = "props"):
    """The integer ``k`` carried in the events' JSON ``props``."""
    return F.get_json_object(F.col(props), "$.k").cast("double")


def asset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset registry rows (customer x nation x region), one per customer.

    Limits follow the customer key; every seventh customer (key % 7 = 6)
    has no limits configured.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    no_limits = (k % 7) == 6

    def limit(expr):
        return F.when(~no_limits, expr.cast("double"))

    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            k.cast("string").alias("asset_id"),
            F.col("c_name").alias("asset_name"),
            F.col("c_mktsegment").alias("asset_type"),
            F.col("r_name").alias("operator_name"),
            F.concat(F.lit("LOC-"), F.col("n_nationkey").cast("string")).alias("location_id"),
            F.col("n_name").alias("location_name"),
            F.col("r_name").alias("country"),
            (F.col("n_nationkey").cast("double") * 3.5 - 40.0).alias("latitude"),
            (F.col("n_regionkey").cast("double") * 30.0 - 60.0 + F.col("n_nationkey").cast("double") * 0.5).alias("longitude"),
            limit(30 + (k % 5) * 10).alias("max_wind_kmh"),
            limit(45 + (k % 5) * 12).alias("max_gust_kmh"),
            limit(F.lit(2.0) + (k % 3).cast("double") * 0.5).alias("max_wave_height_m"),
            limit(1000 + (k % 4) * 500).alias("minimum_visibility_m"),
            k.alias("registry_row"),
        )
    )


def _forecast_keys():
    return [
        F.col("user_id").cast("string").alias("asset_id"),
        F.date_trunc("week", F.col("ts")).cast("timestamp_ntz").alias("forecast_reference_time"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("forecast_valid_time"),
    ]


def atmospheric_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed atmospheric readings, one row per event (input of the Silver job).

    asset = user, run = week of the event, hour = hour of the event; wind,
    gust and visibility are missing for ``signup`` events.  ``record_order``
    is the landing order (event id).
    """
    e = table(spark, sf_dir, "events")
    v, k = F.col("value"), _k()
    missing = F.col("event_type") == "signup"
    return e.select(
        *_forecast_keys(),
        F.lit(None).cast("string").alias("location_id"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        (v / 10).alias("temperature_2m"),
        k.alias("relative_humidity_2m"),
        F.when(F.col("event_type") == "purchase", v / 30).otherwise(F.lit(0.0)).alias("precipitation"),
        (F.lit(980.0) + k * 0.5).alias("pressure_msl"),
        F.when(~missing, v).alias("wind_speed_10m"),
        (k * 3.6).alias("wind_direction_10m"),
        F.when(~missing, v * 1.4).alias("wind_gusts_10m"),
        F.when(~missing, k * 100).alias("visibility"),
        (k % 4).alias("weather_code"),
        F.lit("events.parquet").alias("source_file"),
        F.col("event_id").alias("record_order"),
    )


def marine_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed marine readings: events other than ``error`` and ``signup``."""
    e = table(spark, sf_dir, "events").where(~F.col("event_type").isin("error", "signup"))
    v, k = F.col("value"), _k()
    return e.select(
        *_forecast_keys(),
        F.lit(None).cast("string").alias("location_id"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        (v / 30).alias("wave_height"),
        (k * 3.6).alias("wave_direction"),
        (k / 10).alias("wave_period"),
        ((v - 25) / 30).alias("wind_wave_height"),
        ((v - 60) / 30).alias("swell_wave_height"),
        (F.lit(360.0) - k * 3.6).alias("swell_wave_direction"),
        ((k - 10) / 5).alias("swell_wave_period"),
        ((v - 40) / 10).alias("sea_surface_temperature"),
        ((k - 30) / 20).alias("ocean_current_velocity"),
        (k * 1.8).alias("ocean_current_direction"),
        F.lit("events.parquet").alias("source_file"),
        F.col("event_id").alias("record_order"),
    )


# Columns that fix the landing order of a line item.  (l_orderkey,
# l_linenumber) alone is not unique; rows that tie on all of these carry
# identical price records, so which of them is "last" does not matter.
PRICE_RECORD_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
]


def price_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed energy price records (lineitem x part), one per line item.

    period = ship date, product code = brand, product name = part name,
    value = extended price, units = return flag, series = brand + flag,
    process = line status.  Column names are those of the source feed.
    """
    return _price_records(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def price_record_parts(spark: SparkSession, sf_dir: str, lines: int = 5_000_000, most: int = 4) -> list[DataFrame]:
    """``price_records`` in up to ``most`` parts of about as many line items, cut by order
    key, of ``lines`` and more: written one after the other, the joins of only one part
    take up disk at a time."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    n = min(most, li.count() // lines)
    key = F.col("l_orderkey")
    cuts = li.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 1000)).first()[0] if n > 1 else None
    parts, low = [], key.isNull()
    for cut in sorted(set(cuts or [])):
        parts.append(low & (key <= cut) if parts else low | (key <= cut))
        low = key > cut
    return [_price_records(li.where(c), p) for c in [*parts, low]] if parts else [_price_records(li, p)]


def _price_records(li: DataFrame, p: DataFrame) -> DataFrame:
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("period"),
        F.col("p_brand").alias("product"),
        F.col("p_name").alias("product-name"),
        F.col("l_extendedprice").alias("value"),
        F.concat(F.col("p_brand"), F.lit("."), F.col("l_returnflag")).alias("series"),
        F.col("l_returnflag").alias("units"),
        F.col("l_linestatus").alias("process"),
        F.struct(*[F.col(c) for c in PRICE_RECORD_ORDER]).alias("record_order"),
    )


def rig_sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rig-count sheet rows as text (orders x customer x nation x region).

    One row per (month, country, target, location, status) with the
    number of orders as the rig count; Oil for urgent / high priority,
    offshore for BUILDING / MACHINERY customers; the three order states
    become three rig states written in mixed case.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    codes = {
        "c_nationkey": F.col("c_nationkey"),
        "oil": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0),
        "offshore": F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 1).otherwise(0),
        "state": F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2),
        "year": F.year("o_orderdate"),
        "month": F.month("o_orderdate"),
    }
    # Orders are counted by codes; the texts are written from aggregated codes,
    # so whatever a job does to a text runs per sheet row, never per order.
    counted = o.join(c, o.o_custkey == c.c_custkey).select(*[e.alias(n) for n, e in codes.items()])
    counted = counted.groupBy(*[F.col(n).alias(f"by_{n}") for n in codes]).agg(
        F.count(F.lit(1)).alias("orders"), *[F.max(n).alias(n) for n in codes])
    rows = (
        counted.join(n, counted.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("r_name").alias("Region"),
            F.lower("n_name").alias("Country"),
            F.when(F.col("oil") == 1, "oil").otherwise("GAS").alias("DrillFor"),
            F.when(F.col("offshore") == 1, " offshore ").otherwise("land").alias("Location"),
            F.when(F.col("state") == 0, "active")
            .when(F.col("state") == 1, "non-opec stacked")
            .otherwise("o'neil 3rd party").alias("Rig Status"),
            F.col("year").cast("string").alias("Year"),
            F.col("month").cast("string").alias("Month"),
            "orders",
        )
    )
    keys = ["Region", "Country", "DrillFor", "Location", "Rig Status", "Year", "Month"]
    return rows.groupBy(*keys).agg(F.sum("orders").cast("string").alias("Rig Count Value")).select(
        *keys,
        "Rig Count Value",
        F.lit("rig_count_monthly.csv").alias("source_file"),
        F.struct(
            F.col("Year").cast("int"), F.col("Month").cast("int"), "Region", "Country",
            "DrillFor", "Location", "Rig Status",
        ).alias("record_order"),
    )


def run_ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-ledger events: a RUNNING event at each user's first event, and a
    SUCCESS / FAILED event at the last one (FAILED when that last event is
    an ``error``; none when it is a ``signup``, so the run stays RUNNING).
    """
    e = table(spark, sf_dir, "events")
    runs = e.groupBy("user_id").agg(
        F.min("ts").alias("started"),
        F.max("ts").alias("finished"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"),
    )
    start = runs.select(
        F.col("user_id").alias("pipeline_run_key"),
        F.lit("complete_energy_operations").alias("pipeline_name"),
        F.col("started").alias("event_time"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    finish = runs.where(F.col("last_type") != "signup").select(
        F.col("user_id").alias("pipeline_run_key"),
        F.lit("complete_energy_operations").alias("pipeline_name"),
        F.col("finished").alias("event_time"),
        F.when(F.col("last_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("last_type") == "error", F.lit("quality gate failed")).alias("error_message"),
    )
    return start.unionByName(finish)


def quality_check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results of the runs: one per event, failed for ``error`` events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("quality_check_key"),
        F.col("user_id").alias("pipeline_run_key"),
        F.concat(F.col("event_type"), F.lit("_check")).alias("check_name"),
        (F.col("event_type") != "error").alias("passed"),
        F.col("props").alias("check_value"),
        F.lit("no error events").alias("expectation"),
        F.when(F.col("event_type") == "error", F.lit("error event")).otherwise(F.lit("")).alias("details"),
        F.col("ts").alias("checked_at"),
    )


RUN_TIME_2 = "2024-02-02 00:00:00"  # load time of a second delivery


def single_location_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings of the older single-location feed: every event is one
    reading (time text to the minute); humidity is missing for ``error``
    events and wind for ``signup`` events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit(25.0).alias("latitude"),
        F.lit(55.0).alias("longitude"),
        F.lit("GMT").alias("timezone"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (F.col("value") / 10).cast("string").alias("temperature_2m"),
        F.when(F.col("event_type") != "error", _k()).cast("string").alias("relative_humidity_2m"),
        F.when(F.col("event_type") != "signup", F.col("value")).cast("string").alias("wind_speed_10m"),
    )


def landed_forecast_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed forecast documents, opened to one row per asset: parallel hourly
    arrays of text. A document holds a user's events of one week and of one
    block of 1,000 event ids, so no array has more than 1,000 entries.

    Feed text as it comes: odd events give their hour with a +02:00 offset;
    ``signup`` events give wind, gust and visibility as text that is no number.
    """
    e = table(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / 1000).cast("int")
    v, k = F.col("value"), _k()
    missing = F.col("event_type") == "signup"
    hour = F.date_trunc("hour", "ts")
    fields = {
        "time": F.when(F.col("event_id") % 2 == 0, F.date_format(hour, "yyyy-MM-dd'T'HH:mm'Z'"))
        .otherwise(F.concat(F.date_format(hour + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm"), F.lit("+02:00"))),
        "temperature_2m": v / 10,
        "relative_humidity_2m": k,
        "precipitation": F.when(F.col("event_type") == "purchase", v / 30).otherwise(F.lit(0.0)),
        "pressure_msl": F.lit(980.0) + k * 0.5,
        "wind_speed_10m": F.when(missing, F.lit("n/a")).otherwise(v.cast("string")),
        "wind_direction_10m": k * 3.6,
        "wind_gusts_10m": F.when(missing, F.lit("12d")).otherwise((v * 1.4).cast("string")),
        "visibility": F.when(missing, F.lit("NaN")).otherwise((k * 100).cast("string")),
        "weather_code": k % 4,
    }
    hours = F.array_sort(F.collect_list(F.struct("event_id", *[c.cast("string").alias(n) for n, c in fields.items()])))
    docs = e.groupBy("user_id", F.date_trunc("week", "ts").alias("week"), block.alias("block")).agg(hours.alias("hours"))
    none = F.lit(None).cast("string")
    return docs.select(
        F.lit("events.parquet").alias("source_file"),
        F.lit(None).cast("timestamp").alias("file_time"),
        F.date_format("week", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_time"),
        F.col("block").alias("asset_pos"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("asset_id"),
        F.struct(none.alias("location_id"), none.alias("latitude"), none.alias("longitude")).alias("asset"),
        F.struct(*[F.col(f"hours.{n}").alias(n) for n in fields]).alias("hourly"),
    )


def short_forecast_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``landed_forecast_assets`` of a feed that leaves out readings: entries
    that are no number are absent, so wind arrays can be shorter than ``time``."""
    docs = landed_forecast_assets(spark, sf_dir)
    return docs.withColumn("hourly", F.col("hourly").withField(
        "wind_speed_10m", F.filter("hourly.wind_speed_10m", lambda x: x != "n/a")))


def feed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed response per requested asset, known by its position only."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request_index"), F.col("c_acctbal").alias("response"))
