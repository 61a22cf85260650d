"""Domain rules as native Column expressions: code labels, validity gate,
reject reasons.  No Python UDFs: everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config

# --- fixed values (must equal the reference's for equal results) -------------
# WMO weather code -> condition label; anything else (or null / non-numeric) is
# "Unknown".  Fractional codes truncate toward zero before the lookup.
CODE_LABELS = [
    ("Clear", [0]),
    ("Cloudy", [1, 2, 3]),
    ("Fog", [45, 48]),
    ("Drizzle", [51, 53, 55, 56, 57]),
    ("Rain", [61, 63, 65, 66, 67]),
    ("Snow", [71, 73, 75, 77]),
    ("Rain showers", [80, 81, 82]),
    ("Snow showers", [85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]
UNKNOWN = "Unknown"

# Condition label -> display emoji; unmatched labels get the default.
EMOJI = {
    "Clear": "☀️", "Cloudy": "☁️", "Rain": "🌧️", "Rain showers": "🌧️",
    "Drizzle": "🌦️", "Thunderstorm": "⛈️", "Fog": "🌫️", "Snow": "❄️",
    "Snow showers": "🌨️", "Unknown": "❓",
}
EMOJI_DEFAULT = "🌡️"

# Polled cities -> (latitude, longitude).
CITIES = {
    "Delhi": (28.61, 77.21),
    "Mumbai": (19.076, 72.877),
    "Bengaluru": (12.97, 77.59),
    "Chennai": (13.08, 80.27),
    "Kolkata": (22.57, 88.36),
    "Gurugram": (28.46, 77.03),
}

# Daily flag labels.
FLAG_TRUE = "Heatwave >40°"
FLAG_FALSE = "Normal"
# ------------------------------------------------------------------------------


def condition_from_code(code: Column) -> Column:
    """Label of a numeric (DOUBLE) code column; truncation via try_cast to INT,
    so NaN, infinities and out-of-range values become null -> Unknown."""
    c = code.try_cast("int")
    expr = None
    for label, codes in CODE_LABELS:
        cond = c.isin(codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN))


def _finite_or_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def is_valid_reading(t: Column, h: Column, w: Column, cfg: Config = DEFAULT) -> Column:
    """Validity gate; null in any input gives null, which a filter drops.
    NaN sorts above every number in Spark, so it is turned into null first."""
    t, h, w = _finite_or_null(t), _finite_or_null(h), _finite_or_null(w)
    return (t.between(cfg.temp_min, cfg.temp_max)
            & h.between(cfg.humidity_min, cfg.humidity_max)
            & (w >= F.lit(cfg.wind_min)))


def reject_reason(key: Column, t: Column, h: Column, w: Column, cfg: Config = DEFAULT) -> Column:
    """First failed check, or null for a row that passes (F1 then F2)."""
    t, h, w = _finite_or_null(t), _finite_or_null(h), _finite_or_null(w)
    return (F.when(key.isNull(), F.lit("missing_key"))
            .when(~F.coalesce(t.between(cfg.temp_min, cfg.temp_max), F.lit(False)),
                  F.lit("temperature"))
            .when(~F.coalesce(h.between(cfg.humidity_min, cfg.humidity_max), F.lit(False)),
                  F.lit("humidity"))
            .when(~F.coalesce(w >= F.lit(cfg.wind_min), F.lit(False)), F.lit("wind")))


def flag_label(flag: Column) -> Column:
    """Boolean -> display label; null stays null."""
    return F.when(flag, F.lit(FLAG_TRUE)).when(~flag, F.lit(FLAG_FALSE))


def condition_case_sql(code_sql: str) -> str:
    """The label rule as a SQL CASE over an INTEGER expression (for SQL users
    and oracle queries)."""
    parts = [f"WHEN {code_sql} IN ({', '.join(str(c) for c in codes)}) THEN '{label}'"
             for label, codes in CODE_LABELS]
    return "CASE " + " ".join(parts) + f" ELSE '{UNKNOWN}' END"


def register_sql_functions(spark: SparkSession, cfg: Config = DEFAULT) -> None:
    """Offer the rules to SQL users as temporary SQL functions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION code_to_condition(code DOUBLE) "
        f"RETURNS STRING RETURN {condition_case_sql('try_cast(code AS INT)')}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_valid_reading("
        "t DOUBLE, h DOUBLE, w DOUBLE) RETURNS BOOLEAN RETURN "
        f"coalesce(NOT isnan(t) AND NOT isnan(h) AND NOT isnan(w) "
        f"AND t BETWEEN {cfg.temp_min} AND {cfg.temp_max} "
        f"AND h BETWEEN {cfg.humidity_min} AND {cfg.humidity_max} "
        f"AND w >= {cfg.wind_min}, false)"
    )
