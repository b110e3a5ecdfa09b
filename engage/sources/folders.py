"""Which folders or files are still to do."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def unprocessed(found: DataFrame, done: DataFrame, name: str) -> DataFrame:
    """Names found and not done yet, in order.  The done names are made distinct before the anti join."""
    return found.join(done.select(name).distinct(), name, "left_anti").orderBy(name)


def lagged(df: DataFrame, folder_date: str, run_date: dt.date | str | Column, days: int | Column) -> DataFrame:
    """Rows whose dated folder lies ``days`` before the run date."""
    run = run_date if isinstance(run_date, Column) else F.to_date(F.lit(run_date))
    return df.where(F.to_date(folder_date) == F.date_sub(run, days))
