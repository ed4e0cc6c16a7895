"""Operational weather risk rules as native column expressions.

All comparisons run on doubles: ``2.4 >= 3.0 * 0.8`` is false in IEEE
doubles (0.8 * 3.0 = 2.4000000000000004) and the rules must keep that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.scalars import ColumnOrName, _col

# Fixed values of the rules.
UNKNOWN, GREEN, AMBER, RED = "UNKNOWN", "GREEN", "AMBER", "RED"
LEVELS = [UNKNOWN, GREEN, AMBER, RED]  # ascending priority, score = index
UPPER_AMBER_FACTOR = 0.80
MINIMUM_AMBER_FACTOR = 1.25
# Parameters in tie-break order for the limiting parameter.
PARAMETERS = ["wind_speed", "wind_gust", "wave_height", "visibility"]
RECOMMENDATION_RED = "Suspend weather-sensitive operations; limiting parameter: {}."
RECOMMENDATION_AMBER = "Proceed with caution and enhanced monitoring; limiting parameter: {}."
RECOMMENDATION_GREEN = "Conditions are within configured operational limits."
RECOMMENDATION_UNKNOWN = "Insufficient data for a complete operational assessment."


def _double(c: ColumnOrName) -> Column:
    return _col(c).cast("double")


def classify_upper_limit(value: ColumnOrName, limit: ColumnOrName) -> Column:
    """NULL -> UNKNOWN; above limit -> RED; >= 80 % of it -> AMBER; else GREEN.

    A NULL limit makes both comparisons NULL, so the value falls through to
    GREEN, as an asset without a configured limit does in the reference.
    """
    v, lim = _double(value), _double(limit)
    return (
        F.when(v.isNull(), UNKNOWN)
        .when(v > lim, RED)
        .when(v >= lim * F.lit(UPPER_AMBER_FACTOR).cast("double"), AMBER)
        .otherwise(GREEN)
    )


def classify_minimum_limit(value: ColumnOrName, minimum: ColumnOrName) -> Column:
    """NULL -> UNKNOWN; below minimum -> RED; <= 125 % of it -> AMBER; else GREEN."""
    v, lim = _double(value), _double(minimum)
    return (
        F.when(v.isNull(), UNKNOWN)
        .when(v < lim, RED)
        .when(v <= lim * F.lit(MINIMUM_AMBER_FACTOR).cast("double"), AMBER)
        .otherwise(GREEN)
    )


def risk_score(level: ColumnOrName) -> Column:
    """Level -> 0..3 (UNKNOWN 0, GREEN 1, AMBER 2, RED 3); other or NULL -> 0."""
    lvl = _col(level)
    expr = F.when(lvl == LEVELS[1], 1)
    for score, name in enumerate(LEVELS[2:], start=2):
        expr = expr.when(lvl == name, score)
    return expr.otherwise(0)


def score_to_level(score: ColumnOrName) -> Column:
    s = _col(score)
    return F.element_at(F.array(*[F.lit(x) for x in LEVELS]), s + 1)


def highest_risk(*levels: ColumnOrName) -> Column:
    """Highest level by priority; UNKNOWN only when every input is UNKNOWN."""
    return score_to_level(F.greatest(*[risk_score(x) for x in levels]))


def limiting_parameter(
    wind: ColumnOrName, gust: ColumnOrName, wave: ColumnOrName, visibility: ColumnOrName
) -> Column:
    """First parameter (in PARAMETERS order) with the top score; NULL if GREEN."""
    scores = [risk_score(x) for x in (wind, gust, wave, visibility)]
    top = F.greatest(*scores)
    expr = F.when(scores[0] == top, PARAMETERS[0])
    for name, s in zip(PARAMETERS[1:], scores[1:]):
        expr = expr.when(s == top, name)
    return F.when(top == 1, F.lit(None).cast("string")).otherwise(expr)


def recommendation(overall: ColumnOrName, parameter: ColumnOrName) -> Column:
    """Recommendation text, naming the limiting parameter for RED and AMBER."""
    lvl, param = _col(overall), F.coalesce(_col(parameter), F.lit("None"))
    red_head, red_tail = RECOMMENDATION_RED.split("{}")
    amber_head, amber_tail = RECOMMENDATION_AMBER.split("{}")
    return (
        F.when(lvl == RED, F.concat(F.lit(red_head), param, F.lit(red_tail)))
        .when(lvl == AMBER, F.concat(F.lit(amber_head), param, F.lit(amber_tail)))
        .when(lvl == GREEN, F.lit(RECOMMENDATION_GREEN))
        .otherwise(F.lit(RECOMMENDATION_UNKNOWN))
    )
