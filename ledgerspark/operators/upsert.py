"""Keyed merge: matched rows take the update, unmatched updates are inserted, new columns are appended.

``upsert`` is a pure function from two tables to one. ``sources.targets`` writes; it stages the updates first and
so uses the steps below one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.watermark import MODIFIED

POLICIES = ("latest", "error", "keep_all")


class DuplicateKeyError(ValueError):
    """A batch holds several rows for one key where only one is allowed."""


def latest_per_key(df: DataFrame, key: str, modified: str = MODIFIED) -> DataFrame:
    """One row per key: the newest, then the greatest in the other columns, nulls last.

    The order covers every column, so the winner never depends on partitioning or on retried tasks. Spark keeps
    only each task's best row per key before the shuffle, so a hot key shuffles one row per task.
    """
    others = [c for c in df.columns if c not in (key, modified)]
    order = [F.col(c).desc_nulls_last() for c in ([modified] if modified in df.columns else []) + others]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once; rows are counted per task before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Return ``df`` unchanged, or raise when a key occurs twice."""
    _raise_if_any(repeated_keys(df, key), key)
    return df


def _raise_if_any(repeated: DataFrame, key: str) -> None:
    examples = [row[key] for row in repeated.take(3)]
    if examples:
        raise DuplicateKeyError(f"{key} is not unique, for example {examples}")


def require_policy(on_duplicate: str) -> None:
    if on_duplicate not in POLICIES:
        raise ValueError(f"on_duplicate is one of {POLICIES}, not {on_duplicate!r}")


def settle(updates: DataFrame, key: str, on_duplicate: str, modified: str = MODIFIED) -> DataFrame:
    """Apply the policy for several updates of one key."""
    require_policy(on_duplicate)
    if on_duplicate == "latest":
        return latest_per_key(updates, key, modified)
    return require_unique(updates, key) if on_duplicate == "error" else updates


def upsert(target: DataFrame, updates: DataFrame, key: str, on_duplicate: str, modified: str = MODIFIED,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """The target after merging ``updates`` on ``key``.

    * Columns only the updates have are appended; old rows hold null there.
    * Columns only the target has keep their value on a matched row and are null on an inserted one.
    * ``latest`` and ``error`` leave one row per updated key. ``keep_all`` is for targets loaded with repeated
      keys: every target row of a key takes the update, and several updates of a matched key are an error.
    * Columns named in ``keep``, such as the time of creation, keep a matched row's value.
    """
    settled = settle(updates, key, on_duplicate, modified)
    if on_duplicate == "keep_all":
        return update_every_row(target, settled, key, keep=keep)
    return replace_rows(target, settled, updates.select(key).distinct(), key, keep)


def replace_rows(target: DataFrame, updates: DataFrame, keys: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target rows whose key is not among ``keys``, and all ``updates`` (one per key).

    The target is only filtered. If it is bucketed by the key it is not shuffled, and it is read once unless it
    has columns that the updates lack, or columns to ``keep``.
    """
    updates = _in_types_of(target, updates)
    names = {c.lower(): c for c in updates.columns}
    kept = [c for c in target.columns if c.lower() in {k.lower() for k in keep} and c.lower() in names]
    target_only = [c for c in target.columns if c.lower() not in names]
    if target_only or kept:
        old = target.select(F.col(key).alias("_key"), F.lit(True).alias("_matched"), *target_only,
                            *[F.col(c).alias(f"_old_{i}") for i, c in enumerate(kept)])
        joined = updates.join(old, F.col(key) == F.col("_key"), "left")
        for i, c in enumerate(kept):
            joined = joined.withColumn(names[c.lower()], F.when(F.col("_matched"), F.col(f"_old_{i}")).otherwise(F.col(names[c.lower()])))
        updates = joined.select(*updates.columns, *target_only)
    return target.join(keys, key, "left_anti").unionByName(updates, allowMissingColumns=True)


def keys_present(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The updates' keys that the target holds: one read of the target's key column, no larger than the batch.

    Both key columns are grouped together, and each task hands on a key once. Repeated keys compress so well that Spark takes
    the column for small; a join would broadcast every row of it to every task.
    """
    sides = [df.select(F.col(key), F.lit(updated).alias("_updated")) for df, updated in ((updates, True), (target, False))]
    held = sides[0].union(sides[1]).where(F.col(key).isNotNull()).groupBy(key)
    both = held.agg(F.max("_updated").alias("_new"), F.min("_updated").alias("_old")).where("_new AND NOT _old")
    return both.select(F.col(key).cast(updates.select(key).schema[0].dataType).alias(key))


def update_every_row(target: DataFrame, updates: DataFrame, key: str, present: DataFrame | None = None,
                     keep: tuple[str, ...] = (), few: bool = False) -> DataFrame:
    """The merge for a target with repeated keys: each of its rows of an updated key takes the update's values.

    One left join, whose hot groups are on the side that can be split. ``present`` are the updates' keys that the
    target holds, if the caller has them written already; they serve the check, the update and the insert. With ``few``,
    for a caller that has counted them, they and their rows are broadcast, and neither target nor updates are moved.
    """
    updates = _in_types_of(target, updates)
    present = keys_present(target, updates, key) if present is None else present
    present = F.broadcast(present) if few else present
    matched = updates.join(present, key, "left_semi")
    _raise_if_any(repeated_keys(matched, key), key)
    added = updates.join(present, key, "left_anti")
    matched = F.broadcast(matched) if few else matched

    kept = {c.lower() for c in keep} & {c.lower() for c in target.columns}
    values = {c.lower(): c for c in updates.columns if c.lower() != key.lower() and c.lower() not in kept}
    joined = target.join(matched.select(key, F.struct(*values.values()).alias("_new")), key, "left")
    columns = []
    for name in target.columns:
        value = F.col(name)
        if name.lower() in values:
            value = F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(value)
        columns.append(value.alias(name))
    present_names = {c.lower() for c in target.columns}
    columns += [F.col(f"_new.{name}").alias(name) for lower, name in values.items() if lower not in present_names]
    return joined.select(*columns).unionByName(added, allowMissingColumns=True)


def _in_types_of(target: DataFrame, updates: DataFrame) -> DataFrame:
    """The updates with shared columns cast to the target's types, which a merge never changes."""
    wanted = {f.name.lower(): f.dataType for f in target.schema}
    casts = {
        f.name: F.col(f.name).cast(wanted[f.name.lower()])
        for f in updates.schema
        if wanted.get(f.name.lower(), f.dataType) != f.dataType
    }
    return updates.withColumns(casts) if casts else updates


def merge_into(table: str, updates: DataFrame, key: str, on_duplicate: str, modified: str = MODIFIED) -> None:
    """The same merge run by a catalog that has row-level updates; it then rewrites only what it must."""
    settled = settle(updates, key, on_duplicate, modified).alias("u")
    (
        settled.mergeInto(table, F.col(f"{table.rpartition('.')[2]}.{key}") == F.col(f"u.{key}"))
        .withSchemaEvolution()
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )
