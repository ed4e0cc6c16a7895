from tidewatch.plans.risk import operational_risk

# FIXTURES §3: limits wind 35, gust 50, wave 3.0, visibility 2000.
TRUTH = [
    (10, 20, 1.0, 9000, "GREEN GREEN GREEN GREEN", "GREEN", None),
    (28, 20, 1.0, 9000, "AMBER GREEN GREEN GREEN", "AMBER", "wind_speed"),
    (35, 50, 3.0, 2000, "AMBER AMBER AMBER AMBER", "AMBER", "wind_speed"),
    (35.1, 50.1, 3.1, 1999, "RED RED RED RED", "RED", "wind_speed"),
    (10, 50.1, 3.1, 9000, "GREEN RED RED GREEN", "RED", "wind_gust"),
    (10, 20, 2.4, 9000, "GREEN GREEN GREEN GREEN", "GREEN", None),
    (10, 20, 1.0, 2500, "GREEN GREEN GREEN AMBER", "AMBER", "visibility"),
    (None, 20, 1.0, 9000, "UNKNOWN GREEN GREEN GREEN", "GREEN", None),
    (None, None, None, None, "UNKNOWN UNKNOWN UNKNOWN UNKNOWN", "UNKNOWN", "wind_speed"),
]


def test_truth_table(spark):
    rows = []
    def f(x):
        return None if x is None else float(x)

    for i, (w, g, h, v, *_rest) in enumerate(TRUTH):
        rows.append((str(i), f(w), f(g), f(h), f(v)))
    rows.append(("nolimits", 99.0, 99.0, 9.9, 1.0))
    atm = spark.createDataFrame(
        [(a, "2024-01-01 00:00:00", "2024-01-01 01:00:00", w, g, v) for a, w, g, h, v in rows],
        "asset_id string, forecast_reference_time string, forecast_valid_time string, "
        "wind_speed_kmh double, wind_gust_kmh double, visibility_m double",
    ).selectExpr("asset_id", "cast(forecast_reference_time as timestamp_ntz) forecast_reference_time",
                 "cast(forecast_valid_time as timestamp_ntz) forecast_valid_time", "wind_speed_kmh",
                 "wind_gust_kmh", "visibility_m")
    mar = spark.createDataFrame([(a, h) for a, w, g, h, v in rows], "asset_id string, wave_height_m double") \
        .join(atm.select("asset_id", "forecast_reference_time", "forecast_valid_time"), "asset_id")
    lim = spark.createDataFrame(
        [(str(i), 35.0, 50.0, 3.0, 2000.0) for i in range(len(TRUTH))] + [("nolimits", None, None, None, None)],
        "asset_id string, max_wind_kmh double, max_gust_kmh double, max_wave_height_m double, minimum_visibility_m double")
    out = {r["asset_id"]: r for r in operational_risk(atm, mar, lim, validate=True).collect()}
    for i, (_w, _g, _h, _v, levels, overall, param) in enumerate(TRUTH):
        r = out[str(i)]
        got = " ".join([r.wind_risk_level, r.gust_risk_level, r.wave_risk_level, r.visibility_risk_level])
        assert got == levels, (i, got)
        assert r.overall_risk_level == overall and r.limiting_parameter == param, i
    assert out["nolimits"].overall_risk_level == "GREEN" and out["nolimits"].limiting_parameter is None
    assert out["3"].operation_recommendation == "Suspend weather-sensitive operations; limiting parameter: wind_speed."
    assert out["8"].operation_recommendation == "Insufficient data for a complete operational assessment."
