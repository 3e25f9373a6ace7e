"""Base tables and year slices: S1, S9, P11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum import schemas

FIRST_YEAR = {"FRB": 2006, "BOJ": 2019}  # fixed values
DEFAULT_FIRST_YEAR = 2000

TABLES = {
    "speeches": schemas.SPEECHES,
    "analysis": schemas.ANALYSIS,
    "members": schemas.MEMBERS,
    "stage_runs": schemas.STAGE_RUNS,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One base table with its declared schema; no inference pass over the data."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Any Parquet input, with a declared schema where there is one."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def in_years(date: Column, start_year: int | None, end_year: int | None) -> Column:
    """A range of whole years, as a range on the typed date so that it is pushed
    to the scan and prunes files; null dates are out."""
    ok = date.isNotNull()
    if start_year is not None:
        ok = ok & (date >= F.lit(f"{start_year}-01-01").cast("date"))
    if end_year is not None:
        ok = ok & (date <= F.lit(f"{end_year}-12-31").cast("date"))
    return ok


def year_slices(df: DataFrame, end_year: int, start_year: int | None = None) -> DataFrame:
    """Rows from the first year of their bank's archive up to `end_year`.

    `start_year` replaces the first year of every bank.
    """
    if start_year is not None:
        return df.where(in_years(F.col("date"), start_year, end_year))
    first = F.lit(f"{DEFAULT_FIRST_YEAR}-01-01")
    for bank, year in FIRST_YEAR.items():
        first = F.when(F.col("bank_code") == bank, F.lit(f"{year}-01-01")).otherwise(first)
    earliest = min([DEFAULT_FIRST_YEAR, *FIRST_YEAR.values()])
    return df.where(in_years(F.col("date"), earliest, end_year) & (F.col("date") >= first.cast("date")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Work on long texts over every core, also where the input is one small file.

    A table with at least as many splits as cores stays as it is, which is every table of
    real size; the check looks at the plan, not at the data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
