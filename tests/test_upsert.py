import pytest
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError, assert_keys_resolve, assert_unique, require_columns
from tidewatch.operators.upsert import align_schema, empty_like, insert_ignore, upsert, upsert_with_lookup
from pyspark.sql import types as T

SCHEMA = "id string, name string, kind string, created_at string, updated_at string"
UPD = ["name", "updated_at"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_into_empty_target(spark):
    target = empty_like(spark, T.StructType.fromDDL(SCHEMA))
    batch = spark.createDataFrame([("1", "a", "x", "t1", "t1")], SCHEMA)
    assert rows(upsert(target, batch, ["id"], UPD)) == [("1", "a", "x", "t1", "t1")]


def test_upsert_updates_named_columns_only_and_inserts_new(spark):
    target = spark.createDataFrame([("1", "a", "x", "t0", "t0"), ("2", "b", "y", "t0", "t0")], SCHEMA)
    batch = spark.createDataFrame([("1", "A", "CHANGED", "t1", "t1"), ("3", "c", "z", "t1", "t1")], SCHEMA)
    out = rows(upsert(target, batch, ["id"], UPD))
    # kind is outside update_cols and created_at is preserved for existing keys
    assert out == [("1", "A", "x", "t0", "t1"), ("2", "b", "y", "t0", "t0"), ("3", "c", "z", "t1", "t1")]


def test_same_key_twice_in_batch_last_wins(spark):
    target = empty_like(spark, T.StructType.fromDDL(SCHEMA))
    batch = spark.createDataFrame([("1", "first", "x", "t1", "t1", 1), ("1", "second", "x", "t1", "t1", 2)],
                                  SCHEMA + ", ord long")
    target = target.withColumn("ord", F.lit(None).cast("long"))
    out = upsert(target, batch, ["id"], UPD, order_by=["ord"]).drop("ord")
    assert rows(out) == [("1", "second", "x", "t1", "t1")]


def test_same_batch_twice_only_load_time_changes(spark):
    target = empty_like(spark, T.StructType.fromDDL(SCHEMA))
    b1 = spark.createDataFrame([("1", "a", "x", "t1", "t1"), ("2", "b", "y", "t1", "t1")], SCHEMA)
    first = upsert(target, b1, ["id"], UPD)
    b2 = b1.withColumn("created_at", F.lit("t2")).withColumn("updated_at", F.lit("t2"))
    second = rows(upsert(first, b2, ["id"], UPD))
    assert second == [("1", "a", "x", "t1", "t2"), ("2", "b", "y", "t1", "t2")]


def test_insert_ignore_keeps_existing_and_first_of_batch(spark):
    target = spark.createDataFrame([("1", "old")], "k string, v string")
    batch = spark.createDataFrame([("1", "new", 1), ("2", "first", 1), ("2", "second", 2)], "k string, v string, o long")
    out = insert_ignore(target, batch.drop("o"), ["k"], order_by=None)
    got = dict(rows(out))
    assert got["1"] == "old" and got["2"] in {"first", "second"}
    ordered = insert_ignore(target.withColumn("o", F.lit(0).cast("long")), batch, ["k"], order_by=["o"])
    assert dict((k, v) for k, v, _ in rows(ordered)) == {"1": "old", "2": "first"}


def test_upsert_with_lookup_skips_unknown_location(spark):
    target = spark.createDataFrame([], "asset_id string, location_key long, name string")
    locs = spark.createDataFrame([("L1", 10)], "location_id string, location_key long")
    batch = spark.createDataFrame([("A", "L1", "a"), ("B", "L9", "b")], "asset_id string, location_id string, name string")
    out = rows(upsert_with_lookup(target, batch, locs, "location_id", ["asset_id"], ["name", "location_key"]))
    assert out == [("A", 10, "a")]


def test_missing_key_error_names_up_to_five(spark):
    facts = spark.createDataFrame([(f"x{i}",) for i in range(8)] + [("ok",)], "asset_id string")
    dim = spark.createDataFrame([("ok",)], "asset_id string")
    with pytest.raises(ContractError) as err:
        assert_keys_resolve(facts, dim, "asset_id", "asset_key")
    assert str(err.value).count("x") == 5


def test_contracts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long")
    with pytest.raises(ContractError, match="not unique"):
        assert_unique(df, ["k"], "limits")
    with pytest.raises(ContractError, match="b, c"):
        require_columns(df, ["k", "c", "b"])


def test_align_schema_adds_defaults_and_casts(spark):
    df = spark.createDataFrame([("1", "2.5")], "id string, x string")
    schema = T.StructType.fromDDL("id string, x double, is_active boolean")
    out = align_schema(df, schema, {"is_active": True}).collect()[0]
    assert out.x == 2.5 and out.is_active is True
