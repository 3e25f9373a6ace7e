"""Column expressions used by the mapping views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus_days(column: str, days: str) -> Column:
    """A zone-free time plus a number of days."""
    return F.expr(f"{column} + make_dt_interval(cast({days} AS int))")
