"""High watermarks of a batch load.

Watermarks are read from the target in one scan of two columns with a map-side maximum; at most one row per
source system reaches the driver. They return as literals, so the source filter is pushed into the file scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import timestamp_literal
from ledgerspark.settings import EPOCH, Settings

MODIFIED = "last_modified_date"


def watermarks_by_source(target: DataFrame, modified: str = MODIFIED) -> DataFrame:
    """Newest modification time per source system; 1900-01-01 where a system has no time at all."""
    newest = F.coalesce(F.max(modified), timestamp_literal(EPOCH))
    return target.groupBy("source_system").agg(newest.alias("watermark"))


def high_watermarks(target: DataFrame, systems, modified: str = MODIFIED) -> dict[str, datetime]:
    """The watermark of each named system; 1900-01-01 for a system without rows in the target."""
    systems = [s.upper() for s in systems]
    rows = watermarks_by_source(target.where(F.col("source_system").isin(systems)), modified).collect()
    return {system: EPOCH for system in systems} | {r["source_system"]: r["watermark"] for r in rows}


def high_watermark(target: DataFrame, modified: str = MODIFIED) -> datetime:
    """The newest modification time of the whole target, over all systems."""
    (row,) = target.agg(F.max(modified).alias("newest")).collect()
    return row["newest"] or EPOCH


def newer_than(modified: str, watermark: datetime) -> Column:
    """Strictly newer than the watermark; rows without a time never pass."""
    return F.col(modified) > timestamp_literal(watermark)


def within_lookback(modified: str, watermark: datetime, days: int | None = None,
                    settings: Settings = Settings()) -> Column:
    """Not older than ``days`` before the watermark (the configured number of days by default)."""
    days = settings.lookback_days if days is None else days
    return F.col(modified) >= timestamp_literal(watermark - timedelta(days=days))


def recent_rows(df: DataFrame, modified: str, run_ts: datetime, days: int = 3) -> DataFrame:
    """Rows of the last ``days`` days before ``run_ts``."""
    return df.where(F.col(modified) >= timestamp_literal(run_ts - timedelta(days=days)))
