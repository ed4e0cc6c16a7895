"""Landed-file readers and writers.

All readers use explicit schemas (no inference) and return DataFrames
whose ``record_order`` column carries input order (file, position in the
file, position in an array) for keep-last semantics.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import scalars as X
from tidewatch.operators.contracts import (
    ContractError, Watch, assert_hourly_arrays, hourly_array_problems, require_columns, require_non_empty,
)
from tidewatch.operators.metrics import observe_rows

STR, DBL, INT = T.StringType(), T.DoubleType(), T.IntegerType()

# ------------------------------------------------------------ asset registry

# Names of the delivered files.
REGISTRY_COLUMNS = [
    "asset_id", "asset_name", "asset_type", "operator_name", "location_id", "location_name", "country",
    "latitude", "longitude", "max_wind_kmh", "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m",
]
REGISTRY_REQUIRED_LENIENT = ["asset_id", "asset_name", "asset_type", "location_id", "latitude", "longitude"]
REGISTRY_NUMERIC = ["latitude", "longitude", "max_wind_kmh", "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m"]


def read_asset_registry(spark: SparkSession, path: str) -> DataFrame:
    """Asset registry CSV with header, every column read as text.

    Numbers are coerced (bad text -> NULL); ``registry_row`` is the row's
    position in the file, taken on the scan before any shuffle.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(raw, REGISTRY_REQUIRED_LENIENT, "asset registry")
    cols = []
    for c in raw.columns:
        if c in REGISTRY_NUMERIC:
            cols.append(X.to_number(F.col(c)).alias(c))
        else:
            cols.append(X.trim_all(F.col(c)).alias(c))
    return raw.select(*cols, F.monotonically_increasing_id().alias("registry_row"))


def clean_asset_registry(registry: DataFrame) -> DataFrame:
    """Lenient registry (S01): keys and coordinates present and in range.

    Keep-last per asset id is left to the caller (it needs ``registry_row``).
    """
    require_columns(registry, REGISTRY_REQUIRED_LENIENT, "asset registry")
    return registry.dropna(subset=["asset_id", "location_id", "latitude", "longitude"]).where(
        F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    )


def strict_asset_registry(registry: DataFrame) -> DataFrame:
    """Strict registry for the warehouse load (S02): all 13 columns required."""
    return require_columns(registry, REGISTRY_COLUMNS, "asset registry")


# ------------------------------------------------------------ forecast JSON

# Names of the delivered files.
ATMOSPHERIC_ARRAYS = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "pressure_msl", "wind_speed_10m",
    "wind_direction_10m", "wind_gusts_10m", "visibility", "weather_code",
]
MARINE_ARRAYS = [
    "wave_height", "wave_direction", "wave_period", "wind_wave_height", "swell_wave_height",
    "swell_wave_direction", "swell_wave_period", "sea_surface_temperature", "ocean_current_velocity",
    "ocean_current_direction",
]
ASSET_STRUCT = T.StructType([
    T.StructField("asset_id", STR), T.StructField("asset_name", STR), T.StructField("asset_type", STR),
    T.StructField("location_id", STR), T.StructField("latitude", STR), T.StructField("longitude", STR),
    T.StructField("operator_name", STR), T.StructField("location_name", STR), T.StructField("country", STR),
])


def forecast_schema(arrays: Sequence[str]) -> T.StructType:
    """Bronze forecast document: an array of assets with parallel hourly arrays.

    Array elements are read as text so a stray string does not fail the
    whole document; they are coerced per value later (X01).
    """
    hourly = T.StructType(
        [T.StructField("time", T.ArrayType(STR))] + [T.StructField(a, T.ArrayType(STR)) for a in arrays]
    )
    asset_entry = T.StructType([
        T.StructField("request_index", INT),
        T.StructField("asset", ASSET_STRUCT),
        T.StructField("api_response", T.StructType([T.StructField("hourly", hourly)])),
    ])
    return T.StructType([
        T.StructField("dataset", STR),
        T.StructField("source", STR),
        T.StructField("ingestion_time", STR),
        T.StructField("asset_count", INT),
        T.StructField("assets", T.ArrayType(asset_entry)),
    ])


def read_forecast_documents(spark: SparkSession, path: str, arrays: Sequence[str]) -> DataFrame:
    """Multi-line forecast JSON documents, one row per file."""
    return (
        spark.read.schema(forecast_schema(arrays)).option("multiLine", True).json(path)
        .select("*", F.col("_metadata.file_name").alias("source_file"),
                F.col("_metadata.file_modification_time").alias("file_time"))
    )


def forecast_assets(docs: DataFrame, dataset: str, arrays: Sequence[str], validate: bool = True) -> DataFrame:
    """Assets of the documents tagged ``dataset``, one row each.

    Errors: a document with another tag, no assets, or hourly arrays that
    are missing or not as long as ``time``.
    """
    if validate:
        bad = docs.where((F.col("dataset") != dataset) | F.col("dataset").isNull()
                         | F.col("assets").isNull() | (F.size("assets") == 0)).limit(1).collect()
        if bad:
            raise ContractError(
                f"forecast file {bad[0]['source_file']}: expected dataset '{dataset}' with a non-empty asset list"
            )
    assets = docs.select(
        "source_file", "file_time", "ingestion_time", F.posexplode("assets").alias("asset_pos", "entry")
    ).select(
        "source_file", "file_time", "ingestion_time", "asset_pos",
        X.trim_all(F.col("entry.asset.asset_id")).alias("asset_id"),
        F.col("entry.asset").alias("asset"),
        F.col("entry.api_response.hourly").alias("hourly"),
    )
    if validate:
        assert_hourly_arrays(assets, ["time", *arrays])
    return assets


def explode_hourly(assets: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Parallel hourly arrays -> one row per hour, position kept.

    ``arrays_zip`` pads shorter arrays with NULL, which is the padded
    (older) behaviour; strict callers validate lengths first (F07).
    """
    zipped = F.arrays_zip(*[F.col(f"hourly.{a}").alias(a) for a in ["time", *arrays]])
    rows = assets.select(
        "source_file", "file_time", "ingestion_time", "asset_pos", "asset_id", "asset",
        F.posexplode(zipped).alias("hour_pos", "h"),
    )
    return rows.select(
        "asset_id",
        F.col("ingestion_time").alias("forecast_reference_time"),
        F.col("h.time").alias("forecast_valid_time"),
        F.col("asset.location_id").alias("location_id"),
        F.col("asset.latitude").alias("latitude"),
        F.col("asset.longitude").alias("longitude"),
        *[F.col(f"h.{a}").alias(a) for a in arrays],
        "source_file",
        F.struct("file_time", "source_file", "asset_pos", "hour_pos").alias("record_order"),
    )


def read_forecast_hours(spark: SparkSession, path: str, dataset: str, arrays: Sequence[str]) -> DataFrame:
    """Forecast JSON -> hourly rows ready for the Silver job."""
    docs = read_forecast_documents(spark, path, arrays)
    return explode_hourly(forecast_assets(docs, dataset, arrays), arrays)


LANDED = "dataset string, ingestion_time string, source_file string, file_time timestamp, pos int, entry string"


def land_entries(spark: SparkSession, path: str, root: str, array: str, ingest_time: str) -> str:
    """Land one delivered JSON document in Bronze, an entry of its ``array`` (``assets`` or
    ``response.data``) to a line (K01): a document is one task's work however large it is,
    its lines split over tasks wherever they are read. Entries stay raw JSON text.

    Lines go under the ingest date, one folder a delivery; the job commit publishes all
    of a delivery or nothing. Returns the delivery's folder.
    """
    inner = T.ArrayType(STR)
    for name in reversed(array.split(".")):
        inner = T.StructType([T.StructField(name, inner)])
    schema = T.StructType([T.StructField("dataset", STR), T.StructField("ingestion_time", STR), *inner.fields])
    entries = spark.read.schema(schema).option("multiLine", True).json(path).select(
        "dataset", "ingestion_time", F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"), F.posexplode_outer(array).alias("pos", "entry"))
    day = spark.range(1).select(F.to_date(F.lit(ingest_time).cast("timestamp_ntz")).cast("string")).first()[0]
    folder = f"{root}/ingest_date={day}/delivery={uuid.uuid4().hex}"
    entries.repartition(F.col("pos")).write.json(folder)
    return folder


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of one landed delivery."""
    return spark.read.schema(LANDED).json(folder)


def landed_forecast_hours(landed: DataFrame, dataset: str, arrays: Sequence[str]) -> tuple[DataFrame, list[Watch]]:
    """Hourly rows of a landed forecast delivery, every asset parsed from its own line;
    the contracts (S03, F07) are counted by whatever writes the rows."""
    of_lines, of_assets = Observation(), Observation()
    wrong = (F.col("dataset") != dataset) | F.col("dataset").isNull() | F.col("entry").isNull()
    entry_type = forecast_schema(arrays)["assets"].dataType.elementType

    def assets_of(lines: DataFrame) -> DataFrame:
        # a generator's columns: the line is parsed once, not again for every use of a field
        parsed = lines.select("source_file", "file_time", "ingestion_time", F.col("pos").alias("asset_pos"),
                              F.inline(F.array(F.from_json("entry", entry_type))))
        return parsed.select(
            "source_file", "file_time", "ingestion_time", "asset_pos",
            X.trim_all(F.col("asset.asset_id")).alias("asset_id"), "asset",
            F.col("api_response.hourly").alias("hourly"))

    def explain() -> None:
        if not landed.where(wrong).isEmpty():
            raise ContractError(f"landed forecast: expected dataset '{dataset}' with a non-empty asset list")
        assert_hourly_arrays(assets_of(landed), ["time", *arrays])

    assets = assets_of(landed.observe(of_lines, F.count_if(wrong).alias("lines")))
    assets = assets.observe(of_assets, F.count_if(F.size(hourly_array_problems(["time", *arrays])) > 0).alias("assets"))
    return explode_hourly(assets, arrays), [Watch(of_lines, explain), Watch(of_assets, explain)]


def watched_forecast_hours(docs: DataFrame, dataset: str, arrays: Sequence[str]) -> tuple[DataFrame, list[Watch]]:
    """Hourly rows of opened documents; their contracts (S03, F07) are counted by
    whatever writes the rows, so the documents are parsed once."""
    of_docs, of_assets = Observation(), Observation()
    wrong = (F.col("dataset") != dataset) | F.col("dataset").isNull() | F.col("assets").isNull() | (F.size("assets") == 0)
    watched = docs.observe(of_docs, F.count_if(wrong).alias("documents"))
    assets = forecast_assets(watched, dataset, arrays, validate=False)
    assets = assets.observe(of_assets, F.count_if(F.size(hourly_array_problems(["time", *arrays])) > 0).alias("assets"))

    def explain() -> None:
        forecast_assets(docs, dataset, arrays)

    return explode_hourly(assets, arrays), [Watch(of_docs, explain), Watch(of_assets, explain)]


def attach_by_position(responses: DataFrame, assets: DataFrame) -> DataFrame:
    """Join API responses to the assets they were requested for by position.

    ``responses`` and ``assets`` each carry ``request_index`` (the array
    position of the request); the counts must match or the run fails.
    """
    counts = responses.agg(F.count(F.lit(1)).alias("r")).crossJoin(
        assets.agg(F.count(F.lit(1)).alias("a"))).collect()[0]
    if counts["r"] != counts["a"]:
        raise ContractError(f"{counts['r']} responses for {counts['a']} assets")
    return assets.join(responses, on="request_index", how="inner")


# --------------------------------------------------------------- price JSON

# Names of the delivered files.
PRICE_FIELDS = ["period", "product", "product-name", "value", "series", "units",
                "duoarea", "area-name", "process", "process-name", "series-description"]
# Lines in a compressed file of landed records (some 100 MB of plain text), and records that
# one task reads at least once all cores have some: its keep-last finds more of the records
# of a key before the shuffle.
PRICE_LINES_PER_FILE = 250_000
PRICE_RECORDS_PER_TASK = 1_500_000


def read_price_records(spark: SparkSession, path: str) -> DataFrame:
    """Price JSON ``response.data[]`` -> one row per record.

    Records are taken as raw JSON text first, so the columns present in the
    feed are known (pandas would build the frame from the keys it sees);
    a column appears only if some record has it (P04, P05).
    """
    schema = T.StructType([T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(STR))]))])
    docs = spark.read.schema(schema).option("multiLine", True).json(path).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.posexplode("response.data").alias("pos", "rec"),
    )
    return price_records(docs)


def landed_price_records(landed: DataFrame) -> DataFrame:
    """Price records of a landed delivery, a record to a line."""
    return price_records(landed.where(F.col("entry").isNotNull()).select(
        "source_file", "file_time", "pos", F.col("entry").alias("rec")))


def price_records(docs: DataFrame) -> DataFrame:
    """Records (``rec``, raw JSON) with the known fields that the feed holds."""
    # one row whatever the feed's size: how many records, and which known keys they hold
    keys = F.json_object_keys("rec")
    seen = docs.agg(F.count(F.lit(1)).alias("n"), *[
        F.bool_or(F.array_contains(keys, f)).alias(f) for f in PRICE_FIELDS]).collect()[0]
    if not seen["n"]:
        raise ContractError("price file holds no records under response.data")
    fields = [f for f in PRICE_FIELDS if seen[f]]
    parsed = F.from_json("rec", T.StructType([T.StructField(f, STR) for f in fields]))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    docs = docs.coalesce(max(cores, seen["n"] // PRICE_RECORDS_PER_TASK))
    # a generator's columns: a record is parsed once, not again for every field and condition
    return docs.select(
        F.inline(F.array(parsed)),
        F.struct("file_time", "source_file", "pos").alias("record_order"),
    )


# -------------------------------------------------- single-location forecast

# Names of the delivered files.
SIMPLE_ARRAYS = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]


def read_simple_weather(spark: SparkSession, path: str) -> DataFrame:
    """Older single-location forecast JSON -> hourly rows, short arrays padded."""
    hourly = T.StructType([T.StructField(a, T.ArrayType(STR)) for a in ["time", *SIMPLE_ARRAYS]])
    schema = T.StructType([
        T.StructField("latitude", DBL), T.StructField("longitude", DBL),
        T.StructField("timezone", STR), T.StructField("hourly", hourly),
    ])
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    zipped = F.arrays_zip(*[F.col(f"hourly.{a}").alias(a) for a in ["time", *SIMPLE_ARRAYS]])
    return doc.select("latitude", "longitude", "timezone", F.explode(zipped).alias("h")).select(
        "latitude", "longitude", "timezone", *[F.col(f"h.{a}").alias(a) for a in ["time", *SIMPLE_ARRAYS]]
    ).where(F.col("time").isNotNull())


# -------------------------------------------------------------- rig sheet CSV

# Names of the delivered files.
RIG_HEADER = ["Region", "Country", "DrillFor", "Location", "Rig Status", "Year", "Month", "Rig Count Value"]


def read_rig_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Rig-count sheet exported as CSV: preamble lines, then a header row.

    Spark's CSV reader has no skip-rows option, so lines are read
    positionally as text, and a one-row probe finds the header row: the first
    line that has a *cell* equal to the value column's name (a title in the
    preamble may hold that name among other words). Its cells give the number
    and the names of the columns. Preamble lines and the header itself fail
    the Year coercion in the Silver job.
    """
    cells = F.regexp_extract_all("value", F.lit(r'("(?:[^"]++|"")*+"|[^,]*+)(?:,|$)'), F.lit(1))
    is_header = F.exists(cells, lambda c: X.trim_all(F.regexp_replace(c, r'^\s*"|"\s*$', "")) == RIG_HEADER[-1])
    line = spark.read.text(path).where(is_header).limit(1).collect()
    if not line:
        raise ContractError("rig sheet: header row not found")
    header = [c.strip() for c in next(csv.reader([line[0]["value"]], skipinitialspace=True))]
    schema = T.StructType([T.StructField(f"_c{i}", STR) for i in range(len(header))])
    raw = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)
    raw = raw.select("*", F.col("_metadata.file_name").alias("source_file"),
                     F.monotonically_increasing_id().alias("line_order"))
    names = {name: i for i, name in enumerate(header)}
    missing = sorted(set(RIG_HEADER) - set(names))
    if missing:
        raise ContractError("Missing required source columns: " + ", ".join(missing))
    return raw.select(
        *[F.col(f"_c{names[n]}").alias(n) for n in RIG_HEADER],
        "source_file",
        F.struct("source_file", "line_order").alias("record_order"),
    )


# --------------------------------------------------------------- latest file


def latest_file(spark: SparkSession, roots: Sequence[str], glob: str = "*") -> str:
    """Newest non-empty file under ``roots`` (recursive), by modification time.

    Only file metadata is read (the content column is never selected); the
    single winning path is returned.
    """
    frames = [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .load(r).select("path", "modificationTime", "length")
        for r in roots
    ]
    files = frames[0]
    for f in frames[1:]:
        files = files.unionByName(f)
    best = files.where(F.col("length") > 0).agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    ).collect()
    if not best or best[0]["path"] is None:
        raise FileNotFoundError(f"no non-empty file matching {glob} under {list(roots)}")
    return best[0]["path"]


# ------------------------------------------------------------------- sinks


def write_bronze_rows(rows: DataFrame, root: str, ingest_time: str, source_file: str) -> None:
    """Land parsed sheet rows as text, with lineage, under their ingest date."""
    out = rows.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns if c != "record_order"],
        F.lit(source_file).alias("source_file"),
        F.lit(ingest_time).cast("timestamp_ntz").alias("ingestion_time"),
    )
    out.withColumn("ingest_date", F.to_date("ingestion_time")).write.mode("append").partitionBy(
        "ingest_date").parquet(root)


def write_bronze_json(
    df: DataFrame, root: str, ingest_time_col: str = "ingestion_time", lines_per_file: int | None = None
) -> None:
    """Append landed documents under one folder per UTC ingest date.

    The job commit protocol publishes all files of the write or none. With
    ``lines_per_file`` the lines are compressed, so many to a file at most: a
    compressed file is one task's work wherever it is read.
    """
    writer = df.withColumn("ingest_date", F.to_date(F.col(ingest_time_col).cast("timestamp"))).write.mode("append")
    if lines_per_file:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", lines_per_file)
    writer.partitionBy("ingest_date").json(root)


def write_silver(
    df: DataFrame, path: str, sort_cols: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> Observation:
    """Overwrite a Silver table (K03), range partitioned and sorted by ``sort_cols`` (T01):
    files do not overlap in them, so a reader of one asset opens few files. Returns the
    observed number of ``rows`` written (F09), counted after the range partitioning,
    whose sampling reads its input a second time.

    With ``partition_by`` and dynamic partition overwrite, only the
    partitions present in ``df`` are replaced.
    """
    out = df.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols) if sort_cols else df
    out, seen = observe_rows(out, f"written-{uuid.uuid4().hex}")
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen


# Key columns that a stored Silver table must have and fill, by type.
_FORECAST_KEYS = {"asset_id": "text", "forecast_reference_time": "time", "forecast_valid_time": "time"}
SILVER_CONTRACTS = {
    "atmospheric": _FORECAST_KEYS,
    "marine": _FORECAST_KEYS,
    "risk": _FORECAST_KEYS,
    "price": {"timestamp": "time", "product_code": "text", "price_usd": "number"},
    "rig": {"observation_date": "time", "country": "text", "rig_count": "number"},
}


def silver_contract(df: DataFrame, keys: Mapping[str, str], what: str) -> DataFrame:
    """Key columns present (else an error naming the missing), coerced and trimmed
    again; rows without all of them are dropped (S08). Plan only, no job."""
    require_columns(df, list(keys), what)
    coerced = {
        "text": lambda c: X.trim_all(F.col(c).cast("string")),
        "time": lambda c: F.col(c) if isinstance(df.schema[c].dataType, T.TimestampNTZType) else X.to_utc_timestamp_ntz(F.col(c)),
        "number": lambda c: X.to_number(F.col(c), numeric_input=isinstance(df.schema[c].dataType, T.NumericType)),
    }
    out = df.select(*[coerced[keys[c]](c).alias(c) if c in keys else F.col(f"`{c}`") for c in df.columns])
    return out.dropna(subset=list(keys))


def read_silver(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored Silver table under its contract (S08, S13), as every loader reads it;
    an error if it has no row, or none with all keys."""
    stored = spark.read.parquet(path)
    rows = silver_contract(stored, SILVER_CONTRACTS[name], f"{name} Silver")
    if rows.isEmpty():
        require_non_empty(stored, f"{name} Silver is empty.")
        raise ContractError(f"{name} Silver contains no valid rows.")
    return rows
