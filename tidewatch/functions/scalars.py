"""Column -> Column scalar functions.

Every function returns a native Spark expression, so it stays inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column as _Column

ColumnOrName = _Column | str

# Fixed values that results depend on: season of a month, commodity class
# rules (checked in this order, first match wins), the placeholder shown
# for a missing number.
SEASON_BY_MONTHS = [
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
]
SEASON_OTHERWISE = "Autumn"
COMMODITY_RULES = [
    ("REFINED_PRODUCT", ("DIESEL", "GASOLINE", "JET FUEL")),
    ("CRUDE_OIL", ("BRENT", "WTI", "CRUDE")),
    ("NATURAL_GAS", ("NATURAL GAS",)),
]
COMMODITY_OTHERWISE = "ENERGY_COMMODITY"
MISSING_NUMBER = "—"
# The characters Python's str.strip() removes (Unicode White_Space plus the
# ASCII separators 0x1c-0x1f), so trimming matches pandas' .str.strip().
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A number as pandas' to_numeric accepts it: optional sign, digits with an
# optional fraction, optional exponent, or inf / infinity.
_NUMERIC_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: ColumnOrName) -> Column:
    """Strip leading and trailing whitespace as Python does.

    ``btrim`` with the fixed character set: no regular expression per value.
    """
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def to_number(c: ColumnOrName, numeric_input: bool = False) -> Column:
    """Text (or number) -> double; unparseable text and NaN -> NULL.

    ``try_cast`` alone would accept forms like ``12d`` and ``NaN``; the
    guard keeps only plain decimal / exponent numbers and infinities, so
    what it lets through is never NaN and needs no second evaluation.
    """
    col = _col(c)
    if numeric_input:
        return nan_to_null(col.cast("double"))
    text = trim_all(col.cast("string"))
    return F.when(text.rlike(_NUMERIC_TEXT), text.try_cast("double"))


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN -> NULL, applied once at every ingest boundary (X24, hazard H1)."""
    col = _col(c)
    return F.when(~F.isnan(col), col)


def to_utc_timestamp_ntz(c: ColumnOrName) -> Column:
    """Text -> UTC wall-clock TIMESTAMP_NTZ; bad text -> NULL.

    A value with an offset is first read as an instant, so the offset is
    folded into UTC (the session time zone), and only then is the zone
    dropped.  Casting text straight to TIMESTAMP_NTZ would ignore it.
    """
    text = trim_all(_col(c).cast("string"))
    # Spark wants seconds before a zone ("10:00+02:00" -> "10:00:00+02:00");
    # the rewrite only runs for values the direct cast rejects
    fixed = F.regexp_replace(text, r"([T ]\d{2}:\d{2})([Zz]|[+-]\d{2}(:?\d{2})?)$", "$1:00$2")
    return F.coalesce(text.try_cast("timestamp"), fixed.try_cast("timestamp")).cast("timestamp_ntz")


def title_case(c: ColumnOrName) -> Column:
    """Capitalise the first letter after any non-letter.

    ``initcap`` only starts words after a space, so ``non-opec`` would stay
    ``Non-opec``; here the text is split into runs of letters and runs of
    other characters and every letter run is capitalised.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")


def commodity_type(product_name: ColumnOrName) -> Column:
    """Commodity class from the product name by ordered substring rules."""
    upper = F.upper(_col(product_name))
    expr = None
    for label, needles in COMMODITY_RULES:
        cond = None
        for needle in needles:
            hit = upper.contains(needle)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(COMMODITY_OTHERWISE)


def season(month: ColumnOrName) -> Column:
    """Meteorological season of a month number."""
    m = _col(month)
    expr = None
    for label, months in SEASON_BY_MONTHS:
        cond = m.isin(*months)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SEASON_OTHERWISE)


def unix_micros_ntz(c: ColumnOrName) -> Column:
    """Microseconds since the epoch of a UTC wall-clock TIMESTAMP_NTZ."""
    return F.unix_micros(_col(c).cast("timestamp"))


def horizon_hours(valid: ColumnOrName, reference: ColumnOrName) -> Column:
    """Whole hours from the forecast run to the forecast hour, never < 0."""
    diff = unix_micros_ntz(valid) - unix_micros_ntz(reference)
    return F.greatest(F.floor(diff / F.lit(3_600_000_000)), F.lit(0)).cast("int")


def elapsed_seconds(finished: ColumnOrName, started: ColumnOrName) -> Column:
    """Seconds between two timestamps as NUMERIC(12,3)."""
    diff = unix_micros_ntz(finished) - unix_micros_ntz(started)
    return (diff.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(12,3)")


def percent_of(part: ColumnOrName, total: ColumnOrName, decimals: int = 2) -> Column:
    """ROUND(part / NULLIF(total, 0) * 100, d) in exact decimal arithmetic.

    Rounding is half away from zero on the exact ratio, as SQL NUMERIC does;
    a zero total gives NULL instead of an error.
    """
    p = _col(part).cast("decimal(20,0)")
    t = F.nullif(_col(total).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(p * 100 / t, decimals)


def change_percent(current: ColumnOrName, previous: ColumnOrName, decimals: int = 2) -> Column:
    """(current - previous) / previous * 100, NULL when previous is NULL or 0."""
    cur = _col(current)
    prev = _col(previous)
    return F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(
        F.round((cur - prev) / prev * 100, decimals)
    )


def format_number_or_dash(c: ColumnOrName, decimals: int = 1) -> Column:
    """Thousands-separated number, placeholder for NULL."""
    return F.coalesce(F.format_number(_col(c).cast("double"), decimals), F.lit(MISSING_NUMBER))


def format_integer_or_dash(c: ColumnOrName) -> Column:
    """Integer display with Python-style banker's rounding."""
    rounded = F.bround(_col(c).cast("double"), 0)
    return F.coalesce(F.format_number(rounded, 0), F.lit(MISSING_NUMBER))


def clean_level(c: ColumnOrName) -> Column:
    """Risk level clean-up: NULL -> UNKNOWN, upper-cased."""
    return F.upper(F.coalesce(_col(c).cast("string"), F.lit("UNKNOWN")))


def value_to_text(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Check value -> text; structs, maps and arrays (by ``dtype``) as JSON."""
    if isinstance(dtype, T.StructType | T.MapType | T.ArrayType):
        return F.to_json(_col(c))
    return _col(c).cast("string")


def empty_to_null(c: ColumnOrName) -> Column:
    """Falsy details -> NULL."""
    col = _col(c)
    return F.when(col.isNotNull() & (col != ""), col)
