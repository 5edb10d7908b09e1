"""What a batch has to read of the ready table: dates that have changed, and keys left over."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.schemas import DELIVERY_KEY


def rows_per_date(ready: DataFrame) -> DataFrame:
    """Visible rows per date.  No column is read, so the files' footers answer."""
    return ready.groupBy("queued_date").agg(F.count(F.lit(1)).alias("n_rows"))


def changed_dates(now: DataFrame, before: DataFrame) -> list[date | None]:
    """Dates whose number of visible rows is not what it was.

    The table only grows, so equal numbers are the same rows.  A calendar bounds the list.
    """
    known = before.select(F.col("queued_date").alias("_date"), F.col("n_rows").alias("_rows"))
    joined = now.join(known, F.col("queued_date").eqNullSafe(F.col("_date")), "left")
    fresh = joined.where(F.col("_rows").isNull() | (F.col("n_rows") != F.col("_rows")))
    return [row.queued_date for row in fresh.select("queued_date").collect()]


def on_dates(dates: Sequence[date | None]) -> Column:
    """Rows of the given dates, as literals, so that the scan skips all other folders."""
    held = F.col("queued_date").isin([d for d in dates if d is not None])
    found = held | F.col("queued_date").isNull() if None in dates else held
    return F.coalesce(found, F.lit(False))


def keys_per_date(keyed: DataFrame) -> DataFrame:
    """One row per key and date: how often it occurs there, and its earliest queue time."""
    return keyed.groupBy(*DELIVERY_KEY, "queued_date").agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.min("queued_at").alias("queued_at"),
        F.min("effective_datetime").alias("effective_datetime"),
        F.min("effective_date").alias("effective_date"),
    )


def fold_dates(per_date: DataFrame) -> DataFrame:
    """One row per key over all its dates."""
    return per_date.groupBy(*DELIVERY_KEY).agg(
        F.sum("occurrences").alias("occurrences"),
        F.min("queued_at").alias("queued_at"),
        F.min("effective_datetime").alias("effective_datetime"),
        F.min("effective_date").alias("effective_date"),
    )
