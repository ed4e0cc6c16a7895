import random

from tidewatch.operators.dedupe import earliest_per_group, keep_last, latest_per_group, rows_at_group_max


def test_keep_last_follows_input_order_not_physical_order(spark):
    rows = [(k, pos, f"v{pos}") for pos, k in enumerate(["a", "b", "a", "c", "a", "b"])]
    random.Random(7).shuffle(rows)  # physical order must not matter
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(3)
    out = {r.k: r.v for r in keep_last(df, ["k"], ["pos"]).collect()}
    assert out == {"a": "v4", "b": "v5", "c": "v3"}


def test_keep_last_with_null_key_and_composite_order(spark):
    df = spark.createDataFrame([(None, 1, 2, "x"), (None, 1, 3, "y"), ("k", 2, 0, "z")],
                               "k string, f long, p long, v string")
    out = {r.k: r.v for r in keep_last(df, ["k"], ["f", "p"]).collect()}
    assert out == {None: "y", "k": "z"}


def test_latest_and_earliest_per_group(spark):
    df = spark.createDataFrame([("p", 1, 10.0), ("p", 3, 30.0), ("q", 2, 20.0)], "g string, d long, x double")
    assert {r.g: r.x for r in latest_per_group(df, ["g"], ["d"]).collect()} == {"p": 30.0, "q": 20.0}
    assert {r.g: r.x for r in earliest_per_group(df, ["g"], ["d"]).collect()} == {"p": 10.0, "q": 20.0}


def test_rows_at_group_max_keeps_all_rows_of_the_latest_run(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 2), ("b", 1, 5)], "a string, run long, h long")
    out = sorted((r.a, r.run, r.h) for r in rows_at_group_max(df, ["a"], "run").collect())
    assert out == [("a", 2, 1), ("a", 2, 2), ("b", 1, 5)]


def test_keep_last_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, p long, v string")
    plan = keep_last(df, ["k"], ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_keep_last_combines_map_side_under_skew(spark):
    # one key holds a third of all rows: the partial aggregate reduces it to
    # one row per map task before the shuffle, and the result is still exact
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(8)
    out = keep_last(df, ["k"], ["pos"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    got = {r.k: r.v for r in out.collect()}
    assert got["hot"] == "v2997" and len(got) == 2001
