"""Run settings. Everything is a plain argument; nothing is read from the environment."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

NETSUITE = "NETSUITE"
SAGE = "SAGE"

# The watermark of a system that has no rows in the target yet.
EPOCH = datetime(1900, 1, 1)


@dataclass(frozen=True)
class Settings:
    """Where things are and what runs do. Without a database the session's current catalog is meant."""

    source_database: str | None = None
    netsuite_gold_schema: str = "gold_netsuite"
    netsuite_silver_schema: str = "silver_netsuite"
    sage_gold_schema: str = "gold_sage"
    sage_silver_schema: str = "silver_sage"
    mapping_schema: str = "account_mapping"
    target_database: str | None = None
    reporting_schema: str | None = "reporting"
    snapshot_schema: str | None = "history"
    lookback_days: int = 3
    default_currency: str = "USD"
    enable_soft_deletes: bool = True


@dataclass(frozen=True)
class RunContext:
    """The values of one run that would otherwise change from call to call."""

    run_ts: datetime
    run_id: str
    as_of_date: date

    @classmethod
    def start(cls) -> RunContext:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return cls(run_ts=now, run_id=str(uuid.uuid4()), as_of_date=now.date())


# What the jobs expect of a session; sizes such as shuffle partitions are the cluster's to choose.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Models that run side by side share the cores, each in a pool of its own.
    "spark.scheduler.mode": "FAIR",
    # Bucketed writes keep a few files open instead of sorting their rows by bucket.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Models have many columns; looking up the Python line of each one takes a third of the planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
