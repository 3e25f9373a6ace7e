"""Sink types from column names and types: S11-S13, S15, S16."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_INTS = ("year", "trend_score", "aqi")  # fixed values
RATIO_TOKENS = (
    "per", "pbr", "roe", "margin", "ratio", "chg", "z_score", "yield", "err", "growth", "contrib", "value",
    "pm25", "pm10", "o3", "no2", "so2", "co", "temp",
)  # fixed values
CODE_COLUMNS = ("ibes_code", "ds_code", "instrument")  # fixed values
META_COLUMNS = ("name", "gics_code", "index_group", "TickerFull")  # fixed values
WIDE_FACTS = ("eci_dy",)  # fixed values

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _mart_type(field: T.StructField) -> str:
    name, kind = field.name.lower(), field.dataType
    if name == "date":
        return "date"
    if "score" in name:
        return "float"
    if name == "id" or name.endswith("_id"):
        return "bigint"
    if isinstance(kind, TIMES):
        return "timestamp_ntz"
    if isinstance(kind, INTEGERS):
        return "bigint"
    if isinstance(kind, FLOATS):
        return "double"
    return "string"


def _fact_type(field: T.StructField) -> str:
    name, kind = field.name.lower(), field.dataType
    if name == "date":
        return "date"
    if isinstance(kind, TIMES):
        return "timestamp_ntz"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, INTEGERS):
        return "smallint" if name in SMALL_INTS else "bigint"
    if isinstance(kind, FLOATS):
        return "float" if any(token in name for token in RATIO_TOKENS) else "double"
    return "string"


def _extract_type(field: T.StructField) -> str:
    kind = field.dataType
    if isinstance(kind, INTEGERS + FLOATS):
        return "double"
    if isinstance(kind, TIMES):
        return "timestamp_ntz"
    return "boolean" if isinstance(kind, T.BooleanType) else "string"


def _cast(df: DataFrame, rule) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").try_cast(rule(f)).alias(f.name) for f in df.schema])


def cast_for_sink(df: DataFrame) -> DataFrame:
    """`date` is a date, names with 'score' are real, ids are big integers, the rest
    follows the type."""
    return _cast(df, _mart_type)


def cast_for_fact(df: DataFrame) -> DataFrame:
    """Small integers for years, real for ratios, double for amounts."""
    return _cast(df, _fact_type)


def cast_for_extract(df: DataFrame) -> DataFrame:
    """Every number a double, NaN as null."""
    doubles = _cast(df, _extract_type)
    return doubles.select(*[
        F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast("double")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in doubles.schema
    ])


def master_table(df: DataFrame) -> DataFrame:
    """A metadata table is all text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def master_key_conflicts(df: DataFrame) -> DataFrame:
    """Values of the code columns that occur more than once: (column, value, n)."""
    codes = [c for c in df.columns if c.lower() in CODE_COLUMNS]
    if not codes:
        raise ValueError("no code column")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in codes
    ])).alias("p")).select("p.*")
    return pairs.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    ).where(F.col("n") > 1)


def slim_fact(df: DataFrame, table: str) -> DataFrame:
    """A fact table without the columns its metadata table has."""
    return df if table.lower() in WIDE_FACTS else df.drop(*META_COLUMNS)
