"""The 22 data-quality checks (§2.12) and declared constraints.

``quality_checks`` returns one row per check (name, passed, value,
expectation, details) as a single DataFrame. Every fact is read once for
its row counters, once for its grain and once for its references; the
counters are folded into one row and all check rows are taken from it.
Nothing is collected until the gate reads the 22 result rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.risk_rules import LEVELS
from tidewatch.operators.contracts import ContractError, duplicate_keys
from tidewatch.plans import build
from tidewatch.plans import views_integrated as VI
from tidewatch.plans import views_weather as VW
from tidewatch.sources.testtables import RUN_TIME

Tables = Mapping[str, DataFrame]
FACT_COUNT_TABLES = [
    "fact_weather_forecast", "fact_marine_forecast", "fact_operational_weather_risk",
    "fact_rig_count", "fact_oil_price",
]
# Name and expectation text of each check, in check order
# ("{table}" is filled with each of the five fact tables for checks 3-7),
# and the detail texts.
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
MISSING_PREFIX, ALL_PRESENT = "Missing: ", "All required {what} exist."


def _check(check: str, passed: Column, value: Column, details: Column | None = None, **fmt: str) -> Column:
    name, expectation = CHECKS[check]
    return F.struct(
        F.lit(name.format(**fmt)).alias("check_name"),
        passed.alias("passed"),
        value.cast("string").alias("check_value"),
        F.lit(expectation).alias("expectation"),
        (details if details is not None else F.lit(None)).cast("string").alias("details"),
    )


def _count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gather(frames: Sequence[DataFrame]) -> DataFrame:
    """One row with every column of ``frames``, which are one-row counters
    (null counts as 0). The counters are unioned as (metric, value) rows and
    folded, so each frame is computed once however many checks use it."""
    tall = _union([
        f.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in f.columns])))
        for f in frames])
    return tall.agg(*[
        F.coalesce(F.max(F.when(F.col("metric") == c, F.col("value"))), F.lit(0).cast("bigint")).alias(c)
        for f in frames for c in f.columns])


def required_objects(spark: SparkSession, existing_tables: Sequence[str], existing_views: Sequence[str]) -> DataFrame:
    """Checks 1-2: required tables and views exist (U03; driver metadata only).

    The two rows are literals on a one-row relation, so no Python worker
    is started to ship local data.
    """
    frames = []
    for check, required, existing, what in [
        ("tables", S.REQUIRED_TABLES, existing_tables, "tables"),
        ("views", S.REQUIRED_VIEWS, existing_views, "views"),
    ]:
        name, expectation = CHECKS[check]
        missing = sorted(set(required) - set(existing))
        found = len(set(required) & set(existing))
        details = MISSING_PREFIX + ", ".join(missing) if missing else ALL_PRESENT.format(what=what)
        frames.append(spark.range(1).select(
            F.lit(name).alias("check_name"), F.lit(not missing).alias("passed"),
            F.lit(str(found)).alias("check_value"), F.lit(expectation).alias("expectation"),
            F.lit(details).alias("details"),
        ))
    return _union(frames)


# table -> (prefix of its counters, rules counted on its rows)
PARTITIONED = {
    "fact_weather_forecast": ("atmospheric", {"humidity": lambda: ~F.col("relative_humidity_pct").between(0, 100),
                                              "visibility": lambda: F.col("visibility_m") < 0}),
    "fact_marine_forecast": ("marine", {"wave": lambda: F.col("wave_height_m") < 0}),
    "fact_operational_weather_risk": ("risk", {"levels": lambda: ~F.col("overall_risk_level").isin(*LEVELS)}),
    "fact_rig_count": ("rig", {}),
    "fact_oil_price": ("price", {}),
}


def partition_counters(fact: DataFrame, table: str, part: str) -> DataFrame:
    """Rows of ``agg_fact_partition`` for the partitions in ``fact``: rows, duplicate
    grain groups (a partition is a function of the grain, so groups lie within one),
    the partition's latest run with its rows, and rows that break a rule."""
    schema, grain = S.DERIVED["agg_fact_partition"][0], S.TABLES[table][1]
    rules = {name: rule() for name, rule in PARTITIONED[table][1].items()}
    run = "forecast_reference_time" if "forecast_reference_time" in fact.columns else None
    at = F.col(run) if run else F.lit(None).cast("timestamp_ntz")
    groups = fact.groupBy(part, *grain).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(cond).alias(name) for name, cond in rules.items()])
    runs = groups.groupBy(F.col(part).cast("string").alias("part"), at.alias("run")).agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("duplicates"), *[F.sum(name).alias(name) for name in rules])
    parts = runs.groupBy("part").agg(
        F.sum("n").alias("n"), F.sum("duplicates").alias("duplicates"), F.max("run").alias("latest_run"),
        F.max_by("n", "run").alias("latest_n"), *[F.sum(name).alias(name) for name in rules])
    return parts.select(*[
        (F.lit(table) if f.name == "table_name" else F.col(f.name) if f.name in parts.columns else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schema.fields])


def _stored_counters(counters: DataFrame) -> DataFrame:
    """The counters of checks 3-19 that ``table_metrics`` takes from the facts' rows, one row."""
    def of(table: str, column: str) -> Column:
        return F.when(F.col("table_name") == table, F.col(column))

    named = []
    for table, (prefix, rules) in PARTITIONED.items():
        named += [F.sum(of(table, "n")).alias(prefix), *[F.sum(of(table, name)).alias(name) for name in rules]]
        if prefix in ("atmospheric", "marine", "risk"):
            named += [F.max_by(of(table, "latest_n"), of(table, "latest_run")).alias(f"{prefix}_latest"),
                      F.sum(of(table, "duplicates")).alias(f"dup_{prefix}")]
    return counters.agg(*named)


def _forecast_metrics(fact: DataFrame, prefix: str, **bad: Column) -> DataFrame:
    """Rows, rows of the latest run and rows that break a rule: counted per
    run, then folded to one row, in one scan."""
    runs = fact.groupBy("forecast_reference_time").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(cond).alias(name) for name, cond in bad.items()])
    return runs.agg(
        F.sum("n").alias(prefix), F.max_by("n", "forecast_reference_time").alias(f"{prefix}_latest"),
        *[F.sum(name).alias(name) for name in bad])


def table_metrics(t: Tables) -> list[DataFrame]:
    """Counters behind checks 3-19, each frame one row. A stored warehouse keeps the
    counters of its partitions, so its history is not counted again; the references
    are read from the facts in either case."""
    assets, locations = t["dim_asset"], t["dim_location"].select("location_key")
    frames = [_stored_counters(t["agg_fact_partition"])] if "agg_fact_partition" in t else _fact_counters(t)
    frames.append(_count(assets.where(F.col("is_active")).select("location_key")
                         .join(locations, on="location_key", how="left_anti"), "asset_locations"))
    for check, table in [("orphan_weather", "fact_weather_forecast"), ("orphan_marine", "fact_marine_forecast")]:
        keys = t[table].groupBy("asset_key").count()  # J10: one row per key meets the dimension
        frames.append(keys.join(assets.select("asset_key"), on="asset_key", how="left_anti").agg(F.sum("count").alias(check)))
    return frames


def _fact_counters(t: Tables) -> list[DataFrame]:
    """Row, grain and rule counters straight from the facts."""
    frames = [
        _forecast_metrics(t["fact_weather_forecast"], "atmospheric",
                          humidity=~F.col("relative_humidity_pct").between(0, 100),
                          visibility=F.col("visibility_m") < 0),
        _forecast_metrics(t["fact_marine_forecast"], "marine", wave=F.col("wave_height_m") < 0),
        _forecast_metrics(t["fact_operational_weather_risk"], "risk", levels=~F.col("overall_risk_level").isin(*LEVELS)),
        _count(t["fact_rig_count"], "rig"),
        _count(t["fact_oil_price"], "price"),
    ]
    for check, table in [  # A12
        ("dup_atmospheric", "fact_weather_forecast"),
        ("dup_marine", "fact_marine_forecast"),
        ("dup_risk", "fact_operational_weather_risk"),
    ]:
        frames.append(_count(duplicate_keys(t[table], S.FORECAST_GRAIN), check))
    return frames


def _json_counts(**cols: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()]))


def table_checks() -> list[Column]:
    """Checks 3-19, from the columns of ``table_metrics``."""
    rows = []
    for table, name in zip(FACT_COUNT_TABLES, ["atmospheric", "marine", "risk", "rig", "price"], strict=True):
        n = F.col(name)
        rows.append(_check("rows", n > 0, n, F.when(n > 0, ROWS_PRESENT).otherwise(ROWS_ABSENT), table=table))
    for check, suffix in [("alignment", ""), ("latest_alignment", "_latest")]:  # J12
        counts = {k: F.col(k + suffix) for k in ["atmospheric", "marine", "risk"]}
        equal = (counts["atmospheric"] == counts["marine"]) & (counts["marine"] == counts["risk"])
        rows.append(_check(check, equal, _json_counts(**counts)))
    rows += [_check(name, F.col(name) == 0, F.col(name)) for name in [
        "dup_atmospheric", "dup_marine", "dup_risk", "orphan_weather", "orphan_marine", "asset_locations",
        "humidity", "wave", "visibility", "levels"]]
    return rows


def view_metrics(t: Tables, snapshot_time: str) -> list[DataFrame]:
    """Row counts behind checks 20-22."""
    return [
        _count(VI.executive_energy_operations(t, snapshot_time), "snapshot"),
        _count(VW.asset_operational_kpis(t), "kpi_rows"),
        _count(t["dim_asset"].where(F.col("is_active")), "active_assets"),
        _count(VW.latest_offshore_forecast(t), "latest_forecast"),
    ]


def view_checks() -> list[Column]:
    """Checks 20-22: snapshot is one row, KPI rows = active assets, latest forecast not empty."""
    return [
        _check("snapshot", F.col("snapshot") == 1, F.col("snapshot")),
        _check("kpi_coverage", F.col("kpi_rows") == F.col("active_assets"),
               _json_counts(view_rows=F.col("kpi_rows"), active_assets=F.col("active_assets"))),
        _check("latest_forecast", F.col("latest_forecast") > 0, F.col("latest_forecast")),
    ]


def quality_checks(
    spark: SparkSession,
    t: Tables,
    snapshot_time: str,
    existing_tables: Sequence[str] | None = None,
    existing_views: Sequence[str] | None = None,
) -> DataFrame:
    """All 22 checks as one DataFrame of (check_name, passed, check_value, expectation, details).

    Views are those of the session's catalog unless given. Checks 3-19 need
    the required tables, checks 20-22 the required views.
    """
    tables = list(existing_tables) if existing_tables is not None else [n for n in t if n in S.REQUIRED_TABLES]
    if existing_views is not None:
        views = list(existing_views)
    else:
        views = [v.name for v in spark.catalog.listTables()]
    out = required_objects(spark, tables, views)
    metrics, rows = [], []
    if set(S.REQUIRED_TABLES) <= set(tables):
        metrics, rows = metrics + table_metrics(t), rows + table_checks()
    if set(S.REQUIRED_VIEWS) <= set(views):
        metrics, rows = metrics + view_metrics(t, snapshot_time), rows + view_checks()
    return out.unionByName(gather(metrics).select(F.inline(F.array(*rows)))) if rows else out


def gate(checks: DataFrame) -> list:
    """Read the (at most 22) check rows and fail the run if any did not pass."""
    rows = checks.collect()
    failed = [r["check_name"] for r in rows if not r["passed"]]
    if failed:
        raise ContractError("Quality gate failed: " + ", ".join(failed))
    return rows


# ------------------------------------------------------------- constraints


def constraint_violations(t: Tables) -> DataFrame:
    """Violations of the declared constraints, one row per (table, constraint).

    NOT NULL on keys, CHECK ranges and domains, UNIQUE grain, FOREIGN KEY
    and VARCHAR length. Each table is read once for its row checks, once per
    unique key and once for all of its foreign keys.
    """
    rows: list[DataFrame] = []
    references: list[tuple[str, str, str]] = []  # (table, column, dimension)

    def violations(table: str, named: dict[str, Column]) -> Column:
        return F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("constraint_name"),
                     F.coalesce(c, F.lit(0).cast("bigint")).alias("violations")) for n, c in named.items()]))

    def checks(table: str, named: dict[str, Column]) -> None:
        agg = t[table].agg(*[F.count_if(cond).alias(n) for n, cond in named.items()])
        rows.append(agg.select(violations(table, {n: F.col(n) for n in named})))

    def unique(table: str, keys: Sequence[str]) -> None:
        name = "unique_" + "_".join(keys)
        rows.append(_count(duplicate_keys(t[table], keys)).select(violations(table, {name: F.col("n")})))

    def fk(table: str, col: str, dim: str) -> None:
        references.append((table, col, dim))

    def foreign_keys() -> None:
        """Distinct keys with their row counts (combined map-side) meet all
        dimensions' keys in one join, named by the referring column."""
        used = _union([
            t[table].select(F.lit(table).alias("table_name"), F.inline(F.array(*[
                F.struct(F.lit(col).alias("name"), F.col(col).cast("bigint").alias("key")) for col in cols])))
            for table, cols in {
                table: [c for x, c, _ in references if x == table] for table, _, _ in references}.items()])
        used = used.where(F.col("key").isNotNull()).groupBy("table_name", "name", "key").count()
        known = _union([
            t[dim].select(F.lit(col).alias("name"), F.col(col).cast("bigint").alias("key"))
            for col, dim in dict.fromkeys((col, dim) for _, col, dim in references)])
        orphans = used.join(known, on=["name", "key"], how="left_anti")
        one = orphans.agg(*[
            F.sum(F.when((F.col("table_name") == table) & (F.col("name") == col), F.col("count"))).alias(f"{table}.{col}")
            for table, col, _ in references])
        rows.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(f"fk_{col}").alias("constraint_name"),
                     F.coalesce(F.col(f"`{table}.{col}`"), F.lit(0).cast("bigint")).alias("violations"))
            for table, col, _ in references]))))

    def too_long(c: str, n: int) -> Column:
        return F.length(c) > n

    horizon = {"horizon_not_negative": F.col("forecast_horizon_hours") < 0}
    keys_nn = {"keys_not_null": F.col("asset_key").isNull() | F.col("forecast_reference_time").isNull()
               | F.col("forecast_valid_time").isNull() | F.col("source").isNull()}
    checks("fact_weather_forecast", {**keys_nn, **horizon,
           "humidity_range": ~F.col("relative_humidity_pct").between(0, 100),
           "source_length": too_long("source", 100)})
    checks("fact_marine_forecast", {**keys_nn, **horizon, "wave_not_negative": F.col("wave_height_m") < 0})
    checks("fact_operational_weather_risk", {
        **keys_nn,
        **{f"{c}_domain": ~F.col(c).isin(*LEVELS) | F.col(c).isNull() for c in
           ["wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level", "overall_risk_level"]},
        "recommendation_length": too_long("operation_recommendation", 255)})
    checks("fact_oil_price", {"price_not_negative": F.col("price_usd") < 0, "series_length": too_long("series", 150)})
    checks("fact_rig_count", {"rig_count_not_negative": F.col("rig_count") < 0})
    checks("dim_time", {"hour_range": ~F.col("hour").between(0, 23), "month_range": ~F.col("month").between(1, 12)})
    checks("dim_asset", {"asset_id_length": too_long("asset_id", 50), "name_length": too_long("asset_name", 150)})
    if "fact_pipeline_run" in t:
        checks("fact_pipeline_run", {"status_domain": ~F.col("status").isin("RUNNING", "SUCCESS", "FAILED")})
    for table in ["fact_weather_forecast", "fact_marine_forecast", "fact_operational_weather_risk"]:
        unique(table, S.FORECAST_GRAIN)
        fk(table, "asset_key", "dim_asset")
        fk(table, "time_key", "dim_time")
    unique("fact_oil_price", S.TABLES["fact_oil_price"][1])
    unique("fact_rig_count", S.TABLES["fact_rig_count"][1])
    fk("fact_oil_price", "product_key", "dim_energy_product")
    fk("fact_rig_count", "country_key", "dim_country")
    fk("dim_asset", "location_key", "dim_location")
    for dim, (schema, natural) in S.TABLES.items():
        if dim.startswith("dim_"):
            unique(dim, natural)
            unique(dim, [schema.fields[0].name])  # surrogate key uniqueness (hash collisions)
    foreign_keys()
    return _union(rows)


def _checks_with_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a fresh warehouse after its views are registered."""
    from tidewatch.plans.serving import register_views

    t = build.warehouse(spark, sf_dir)
    register_views(spark, t, RUN_TIME)
    return quality_checks(spark, t, RUN_TIME)


QUERIES = {
    "dq_checks": _checks_with_views,
    "constraint_violations": lambda spark, sf_dir: constraint_violations(build.warehouse(spark, sf_dir)),
}
