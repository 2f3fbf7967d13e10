"""History snapshot by modification time: one row per version with its validity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.contracts import ContractError
from ledgerspark.functions import timestamp_literal
from ledgerspark.operators.upsert import DuplicateKeyError

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def require_one_row_per_key(current: DataFrame, key: str) -> None:
    """Refuse repeated keys, which would multiply versions, and null keys, which match nothing."""
    wrong = current.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | F.col(key).isNull())
    if examples := [row[key] for row in wrong.take(3)]:
        raise DuplicateKeyError(f"{key} is repeated or null, for example {examples}")


def _alike(open_versions: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the history's columns first and new ones last."""
    new = {f.name.lower(): f for f in fresh.schema}
    if missing := [c for c in open_versions.columns if c.lower() not in new]:
        raise ContractError(f"the new rows lack the columns {missing} of the history")
    old = {c.lower() for c in open_versions.columns}
    added = [f for name, f in new.items() if name not in old]
    open_versions = open_versions.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    return open_versions, fresh.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in open_versions.schema))


def next_versions(open_versions: DataFrame | None, current: DataFrame, key: str, updated_at: str, run_ts: datetime,
                  close_deleted: bool = True) -> DataFrame:
    """What the open versions become after seeing ``current``; closed versions are not needed for it.

    A column that only ``current`` has comes last and is null in versions from before; one that ``current`` lacks is an
    error. Shared columns keep the history's types.
    """
    require_one_row_per_key(current, key)
    when_type = "timestamp_ntz"
    fresh = current.withColumns({
        VALID_FROM: F.col(updated_at).cast(when_type),
        VALID_TO: F.lit(None).cast(when_type),
    })
    if open_versions is None:
        return fresh
    open_versions, fresh = _alike(open_versions, fresh)
    columns = fresh.columns
    old = open_versions.select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    new = fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))

    old_row, new_row = F.col("old"), F.col("new")
    closed_by = lambda moment: old_row.withField(VALID_TO, moment)
    gone = closed_by(timestamp_literal(run_ts)) if close_deleted else old_row
    versions = (
        F.when(old_row.isNull(), F.array(new_row))
        .when(new_row.isNull(), F.array(gone))
        .when(F.col(f"new.{VALID_FROM}") > F.col(f"old.{VALID_FROM}"),
              F.array(closed_by(F.col(f"new.{VALID_FROM}")), new_row))
        .otherwise(F.array(old_row))
    )
    return old.join(new, "_key", "full_outer").select(F.inline(versions))


def snapshot_scd2(history: DataFrame | None, current: DataFrame, key: str, updated_at: str, run_ts: datetime,
                  close_deleted: bool = True) -> DataFrame:
    """The history after seeing ``current``, which must hold one row per key and no null key (this is checked).

    * a new key, or one whose versions are all closed, opens a version at its ``updated_at``;
    * a newer ``updated_at`` closes the open version there and opens another; an equal or older one changes nothing;
    * an open version whose key is gone is closed at ``run_ts`` unless ``close_deleted`` is off.

    Closed versions only pass through. Open ones meet the current rows in one join on the key, and the one or two
    resulting versions come out of the joined row, so nothing is joined or shuffled twice.
    """
    if history is None:
        return next_versions(None, current, key, updated_at, run_ts, close_deleted)
    is_open = F.col(VALID_TO).isNull()
    live = next_versions(history.where(is_open), current, key, updated_at, run_ts, close_deleted)
    return history.where(~is_open).unionByName(live, allowMissingColumns=True)
