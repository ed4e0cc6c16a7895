import datetime as dt
import math

from pyspark.sql import functions as F

from tidewatch.functions import scalars as X


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_to_number_matches_pandas_coercion(spark):
    out = col_values(spark, ["12", " 12.5 ", "12d", "NaN", "inf", "-1e3", "", None, "abc", "+.5"], X.to_number)
    assert out[:2] == [12.0, 12.5]
    assert out[2] is None and out[3] is None  # 12d and NaN become NULL
    assert math.isinf(out[4])
    assert out[5:] == [-1000.0, None, None, None, 0.5]


def test_nan_to_null(spark):
    out = col_values(spark, [float("nan"), 1.0, None], X.nan_to_null, "double")
    assert out == [None, 1.0, None]


def test_to_utc_folds_offsets(spark):
    out = col_values(spark, ["2024-01-01T10:00", "2024-01-01T10:00+02:00", "bad", None], X.to_utc_timestamp_ntz)
    assert out == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 8), None, None]


def test_title_case_like_python(spark):
    words = ["non-opec", "O'NEIL", "3rd party", "  land", "GAS", "", None, "middle east"]
    out = col_values(spark, words, X.title_case)
    assert out == [w.title() if w is not None else None for w in words]


def test_commodity_type_rule_order(spark):
    names = ["Ultra Low Sulfur Diesel", "Brent Crude", "WTI", "Henry Hub Natural Gas", "Propane",
             "Diesel and crude blend"]
    out = col_values(spark, names, X.commodity_type)
    assert out == ["REFINED_PRODUCT", "CRUDE_OIL", "CRUDE_OIL", "NATURAL_GAS", "ENERGY_COMMODITY", "REFINED_PRODUCT"]


def test_season(spark):
    out = col_values(spark, list(range(1, 13)), X.season, "int")
    assert out == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                   "Autumn", "Autumn", "Autumn", "Winter"]


def test_horizon_floor_and_clamp(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 30), dt.datetime(2024, 1, 1, 10)),
         (dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 10)),
         (dt.datetime(2024, 1, 2, 9, 59), dt.datetime(2024, 1, 1, 10))],
        "v timestamp_ntz, r timestamp_ntz")
    assert [r[0] for r in df.select(X.horizon_hours("v", "r")).collect()] == [0, 0, 23]


def test_percent_and_change_round_half_away(spark):
    df = spark.createDataFrame([(1, 8, 3.0, 2.0), (1, 0, 1.0, 0.0), (1, 800, 1.0, None)],
                               "p long, n long, c double, q double")
    rows = df.select(X.percent_of("p", "n").cast("double"), X.change_percent(
        F.col("c").cast("decimal(12,4)"), F.col("q").cast("decimal(12,4)")).cast("double")).collect()
    assert rows[0][0] == 12.5 and rows[1][0] is None and rows[2][0] == 0.13
    assert rows[0][1] == 50.0 and rows[1][1] is None and rows[2][1] is None


def test_number_format_and_levels(spark):
    out = col_values(spark, [1234.5678, None], lambda c: X.format_number_or_dash(c, 1), "double")
    assert out == ["1,234.6", "—"]
    out = col_values(spark, [None, "red", "Amber"], X.clean_level)
    assert out == ["UNKNOWN", "RED", "AMBER"]
