"""Disk that the landed price records take: compressed lines, one part's join at a time,
no shuffle files kept, keep-last rows that hold a value once."""

import datetime as dt
import glob
import gzip
import json
import os
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import keep_last
from tidewatch.plans import registry
from tidewatch.plans.silver import silver_price
from tidewatch.sources import bronze
from tidewatch.sources import testtables as TT

LINES = 3_000


@pytest.fixture(scope="module")
def tables(spark):
    d = tempfile.mkdtemp(prefix="tw-price-")
    day = dt.datetime(1998, 1, 1)
    lines = [(None if i % 97 == 0 else i // 3, i % 40, i % 11, i % 7, float(i) + 0.25, "RAN"[i % 3], "FO"[i % 2], day + dt.timedelta(days=i % 20))
             for i in range(LINES)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, f"part {k}", f"Brand#{k % 5}") for k in range(40)],
                          "p_partkey long, p_name string, p_brand string").write.parquet(f"{d}/part.parquet")
    return d


def _rows(df):
    return sorted(map(str, df.collect()))


def test_parts_hold_every_price_record_once(spark, tables):
    whole = TT.price_records(spark, tables)
    parts = TT.price_record_parts(spark, tables, lines=100, most=4)
    assert len(parts) == 4 and all(LINES / 8 < p.count() < LINES / 2 for p in parts)
    assert sorted(r for p in parts for r in _rows(p)) == _rows(whole)
    assert len(TT.price_record_parts(spark, tables)) == 1


def test_parts_of_lines_without_order_keys(spark, tables):
    d = tempfile.mkdtemp(prefix="tw-price-")
    for name in ("lineitem", "part"):
        rows = TT.table(spark, tables, name)
        (rows.withColumn("l_orderkey", F.lit(None).cast("long")) if name == "lineitem" else rows).write.parquet(f"{d}/{name}.parquet")
    assert sum(p.count() for p in TT.price_record_parts(spark, d, lines=100)) == LINES


def test_landed_price_records_are_compressed_whole_and_leave_no_shuffle_files(spark, tables, monkeypatch):
    root = f"{tempfile.mkdtemp(prefix='tw-price-')}/landed-{uuid.uuid4().hex}"
    monkeypatch.setattr(registry, "_landing", lambda spark: root)
    monkeypatch.setattr(bronze, "PRICE_LINES_PER_FILE", 500)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {n for n in (f.getName() for f in _java_list(spark, blocks.getAllFiles())) if n.startswith("shuffle_") and n.endswith(".data")}

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(bronze, "read_landed", lambda spark, folder: (_ for _ in ()).throw(StopIteration(folder)))
    before = shuffled()
    try:
        with pytest.raises(StopIteration):  # landed, not yet read
            registry.QUERIES["silver_price_landed"](spark, tables)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    files = glob.glob(f"{root}/ingest_date=2024-02-01/part-*")
    texts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert sum(map(len, texts)) == LINES and max(map(len, texts)) <= 500
    plain = sum(len(line) + 1 for t in texts for line in t)
    assert sum(map(os.path.getsize, files)) < plain / 3
    assert set(json.loads(texts[0][0])) == {"dataset", "ingestion_time", "source_file", "file_time", "pos", "entry"}


def _java_list(spark, seq):
    return spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(seq)


def test_landed_silver_equals_silver_of_the_records(spark, tables):
    landed = registry.queries()["silver_price_landed"](spark, tables)
    assert _rows(landed) == _rows(silver_price(TT.price_records(spark, tables)).drop("record_order"))


def test_order_texts_sort_like_their_values(spark):
    keys = [(None, 1, 1, 1, 1.0), (0, 1, 1, 1, 1.0), (7, 2, None, 1, 1.0), (7, 2, 3, 1, None), (7, 2, 3, 1, 0.0), (7, 2, 3, 1, 9.5),
            (7, 2, 3, 1, 10.25), (7, 10, 1, 1, 1.0), (100, 1, 1, 1, 1.0), (2_000_000_000, 1, 1, 1, 1.0)]
    rows = spark.createDataFrame([(i, (*k, "R", "F", None)) for i, k in enumerate(keys)], "i int, record_order struct<" + ", ".join(
        f"{c}:{t}" for c, t in zip(TT.PRICE_RECORD_ORDER, ["long", "int", "long", "long", "double", "string", "string", "timestamp_ntz"])) + ">")
    texts = [r.t for r in rows.select("i", F.concat_ws("-", *registry._order_texts()).alias("t")).orderBy("i").collect()]
    assert texts == sorted(texts) and len(set(texts)) == len(keys)
    assert texts[-5] == "000000000007-000000002-000000000003-000000000001-000000000000009.5000-R-F"
    asked = "format_string('%012d-%09d-%012d-%012d-%020.4f-%s-%s', " + ", ".join(f"record_order.{c}" for c in TT.PRICE_RECORD_ORDER[:7]) + ")"
    assert texts == [r.t for r in rows.selectExpr("i", f"{asked} t").orderBy("i").collect()]


def test_keep_last_of_whole_rows_holds_the_order_once(spark):
    rows = spark.createDataFrame([("k", (1, "b"), "x"), ("k", (1, "c"), None), ("k", (1, None), "z"), (None, (0, "a"), "n")],
                                 "k string, o struct<n:int,s:string>, v string")
    last = keep_last(rows, ["k"], ["o"], whole=True)
    assert last.columns == rows.columns and sorted(map(tuple, last.collect()), key=str) == [("k", (1, "c"), None), (None, (0, "a"), "n")]
    assert "max_by" not in last._jdf.queryExecution().executedPlan().toString()


def test_records_of_many_files_are_read_by_tasks_of_many_records(spark, monkeypatch):
    entry = json.dumps({"period": "2024-01-01", "product": "P", "product-name": "Oil", "value": "1.5", "series": "S", "units": "$"})
    landed = spark.range(400).select(
        F.lit("prices").alias("dataset"), F.lit("2024-01-01").alias("ingestion_time"), F.lit("f").alias("source_file"),
        F.lit(None).cast("timestamp").alias("file_time"), F.col("id").cast("int").alias("pos"), F.lit(entry).alias("entry")).repartition(40)
    assert bronze.landed_price_records(landed).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(bronze, "PRICE_RECORDS_PER_TASK", 20)
    found = bronze.landed_price_records(landed)
    assert found.rdd.getNumPartitions() == 20 and found.count() == 400
