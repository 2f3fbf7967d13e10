"""Where model outputs are written.

A ``TableTarget`` is a stable view over the newest version of a table. A version is written completely and then
the view is repointed, so readers see either the old or the new state, a failed run leaves the old one, and a
table is never overwritten while it is read. Large targets are bucketed by the key: a merge then shuffles its
updates, not the target. It rewrites the whole table, as keys are hashes and even a small batch touches nearly
every file.

A ``PartitionedTarget`` reads and writes only the months that a batch touches. A ``HistoryTarget``
rewrites open versions only. Where the catalog has row-level updates, a ``RowLevelTarget`` leaves it all to the catalog.
"""

from __future__ import annotations

import logging
import math
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.operators.snapshot import VALID_TO, next_versions
from ledgerspark.operators.upsert import (
    DuplicateKeyError,
    keys_present,
    latest_per_key,
    merge_into,
    replace_rows,
    require_policy,
    repeated_keys,
    require_unique,
    settle,
    update_every_row,
)
from ledgerspark.operators.watermark import MODIFIED, high_watermark, high_watermarks
from ledgerspark.settings import EPOCH

KEPT_WATERMARK = "watermark."
CREATED_AT = "_created_at"
# Keys are hex text, which a codec without entropy coding leaves twice as long as it need be.
COMPRESSION = "zstd"
# Up to so many keys a merge broadcasts those it has found, in place of moving the rows they are looked up in.
FEW_KEYS = 100_000
# A bucket of so many wide rows is sorted in a task's memory.
ROWS_PER_BUCKET = 250_000
# Files of one bucket, above which a batch is dealt by bucket once more before it is written.
FILES_PER_BUCKET = 8
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
_cleaners: list[str | None] = []
_log = logging.getLogger("ledgerspark")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and re.match(r"(file:)?/+tmp(/|$)", folder):
            raise RuntimeError(f"spark.checkpoint.dir is {folder}, which each machine of a cluster has for itself")
        return folder.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def write_table(df: DataFrame, table: str) -> None:
    """Plain materialisation: replace the table by ``df``."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def full_refresh(df: DataFrame, target: TableTarget) -> DataFrame:
    """First load or reload: the rows as they are, without removing duplicates."""
    return target.replace(df)


def remove_files(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def removing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write go as soon as it ends, so that the disk holds those of one step at a time.

    Models that run side by side share the setting: the first one sets it, the last one puts it back.
    """
    with _cleaning:
        _cleaners.append(spark.conf.get(_CLEANUP, None) if not _cleaners else _cleaners[0])
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning:
            before = _cleaners.pop()
            if not _cleaners:
                spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def add_columns(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Give a table the columns that only the rows have; they are null in what it holds already."""
    have = {c.lower() for c in spark.table(table).columns}
    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in have)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


def shuffle_partitions(spark: SparkSession) -> int:
    """Into how many partitions Spark deals rows by a key, before it joins small ones."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(spark: SparkSession, rows: int, least: int = 1) -> int:
    """Buckets for a target of so many rows: ``least`` while they hold them, else a multiple of the shuffle partitions, so
    that rows dealt by the key already lie as their buckets do."""
    wanted = math.ceil(rows / ROWS_PER_BUCKET)
    partitions = shuffle_partitions(spark)
    return least if wanted <= least else partitions * math.ceil(wanted / partitions)


def in_buckets(rows: DataFrame, buckets: int | None, key: str, on_duplicate: str) -> DataFrame:
    """Rows under their policy, dealt for a write in buckets.

    ``latest`` has dealt them by the hash that buckets are made from. A partition then holds rows of few buckets where the two
    numbers share large factors, and the rows are not moved a second time.
    """
    if not buckets:
        return rows
    partitions = shuffle_partitions(rows.sparkSession)
    if on_duplicate == "latest" and math.lcm(partitions, buckets) <= FILES_PER_BUCKET * max(partitions, buckets):
        return rows
    return rows.repartition(buckets, key)


class Staging:
    """Batches that are computed and settled once, as managed tables that go when the merge ends either way."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self.tables: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table} PURGE")

    def stage(self, df: DataFrame, buckets: int | None = None, key: str | None = None) -> DataFrame:
        table = f"{self.name}__staged_{uuid.uuid4().hex}"
        self.tables.append(table)
        writer = df.write.format("parquet").option("compression", COMPRESSION)
        with removing_shuffles(self.spark):
            (writer.bucketBy(buckets, key) if buckets else writer).saveAsTable(table)
        return self.spark.table(table)

    def settled(self, df: DataFrame, key: str, on_duplicate: str, modified: str,
                buckets: int | None = None) -> tuple[DataFrame, int]:
        """The rows under the policy, written once, and how many rows the policy removed.

        Under ``error`` the check reads what was written, so the batch is not computed for it a second time.
        """
        rows, removed = _under_policy(df, key, on_duplicate, modified, self.name)
        batch = self.stage(in_buckets(rows, buckets, key, on_duplicate), buckets, key)
        if on_duplicate == "error":
            require_unique(batch, key)
        return batch, removed()

    def settled_in_place(self, df: DataFrame, key: str, on_duplicate: str, modified: str) -> tuple[DataFrame, int]:
        """The same where nothing is bucketed: under ``latest`` only rows of repeated keys are moved, if these are few.

        The batch is written as it comes, its keys are counted, and the keys that repeat are taken out and settled.
        """
        if on_duplicate != "latest":
            return self.settled(df, key, on_duplicate, modified)
        raw = self.stage(df)
        return self.without_repeats(raw, raw.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, modified)

    def without_repeats(self, rows: DataFrame, counted: DataFrame, key: str, modified: str,
                        dealt: Callable[[DataFrame], DataFrame] = lambda moved: moved) -> tuple[DataFrame, int]:
        """Stored rows under ``latest``, and how many it removed; ``counted`` has the rows of each key as ``_n``.

        While the keys that repeat are few, the other rows stay where they are; ``dealt`` deals the rows that are moved.
        """
        repeated = self.stage(counted.where("_n > 1").select(F.col(key).alias("_key"), "_n"))
        keys, n = repeated.agg(F.count(F.lit(1)), F.sum("_n")).first()
        if not keys:
            return rows, 0
        if keys > FEW_KEYS:
            settled, removed = self.settled(rows, key, "latest", modified)
            return dealt(settled), removed
        _log.warning("%s: the policy %s removed %d rows of repeated keys", self.name, "latest", n - keys)
        several = F.broadcast(repeated.select("_key"))
        same = F.col(key).eqNullSafe(F.col("_key"))
        newest = latest_per_key(rows.join(several, same, "left_semi"), key, modified)
        return rows.join(several, same, "left_anti").unionByName(dealt(newest)), n - keys


def _under_policy(df: DataFrame, key: str, on_duplicate: str, modified: str, name: str) -> tuple[DataFrame, Callable[[], int]]:
    """The rows under ``latest``, else as they are, and a function that tells, once they are written, how many went."""
    require_policy(on_duplicate)
    before, after = Observation(), Observation()
    one = F.count(F.lit(1)).alias("rows")
    rows = df.observe(before, one)
    if on_duplicate == "latest":
        rows = settle(rows, key, on_duplicate, modified)

    def removed() -> int:
        n = before.get["rows"] - after.get["rows"]
        if n:
            _log.warning("%s: the policy %s removed %d rows of repeated keys", name, on_duplicate, n)
        return n

    return rows.observe(after, one), removed


class TableTarget:
    """A merge target held as versioned Parquet tables behind a view.

    Give large targets ``buckets``, so many that one bucket suits one task. The number is used when the target is
    loaded and then kept with it; ``rebucket`` changes it. Small targets need none. ``folder`` makes
    the versions external tables below it; otherwise they are managed. A target has one writer at a time.

    For the named source ``systems`` the newest modification time is taken while a version is written and kept as
    a table property, so that an incremental run need not scan the target for its watermarks. ``removed_rows`` tells
    how many rows of the last batch the duplicate policy removed.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int | None = None,
                 folder: str | None = None, systems: tuple[str, ...] = ()):
        self.spark = spark
        self.name = name
        self.key = key
        self.buckets = buckets
        self.folder = folder
        self.systems = tuple(system.upper() for system in systems)
        self.removed_rows = 0

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def watermarks(self, systems) -> dict[str, datetime]:
        """The newest time of each system in the target: as kept with the version, else by a scan."""
        kept = self._kept_watermarks()
        wanted = [system.upper() for system in systems]
        if set(wanted) <= set(kept):
            return {system: kept[system] for system in wanted}
        return high_watermarks(self.read(), wanted)

    def newest(self) -> datetime:
        """The newest time in the whole target, which holds rows of its systems only."""
        kept = self._kept_watermarks()
        return max(kept.values()) if self.systems and set(self.systems) == set(kept) else high_watermark(self.read())

    def replace(self, df: DataFrame) -> DataFrame:
        """Write the rows as they are, repeated keys included, as the next version."""
        return self._publish(self._write_version(df, None))

    def load(self, df: DataFrame, on_duplicate: str, modified: str = MODIFIED) -> DataFrame:
        """First load under a duplicate policy. Repeated keys stay unbucketed, since a bucket cannot split a hot key."""
        buckets = None if on_duplicate == "keep_all" else self.buckets
        if on_duplicate == "keep_all":
            self.removed_rows = 0
            return self._publish(self._write_version(df, None, modified))
        # Until the version is published nobody reads it, so the rows need not be staged.
        rows, removed = _under_policy(df, self.key, on_duplicate, modified, self.name)
        version = self._write_version(in_buckets(rows, buckets, self.key, on_duplicate), buckets, modified)
        if on_duplicate == "error":
            try:
                require_unique(self.spark.table(version), self.key)
            except DuplicateKeyError:
                self._drop(version)
                raise
        self.removed_rows = removed()
        return self._publish(version)

    def merge(self, updates: DataFrame, on_duplicate: str, modified: str = MODIFIED,
              keep_created: bool = False) -> DataFrame:
        """Merge a batch into the newest version.

        The batch is computed, settled and written once, in the target's buckets; the merge then joins bucket to
        bucket without a shuffle, and a lost executor costs a re-read instead of the batch's whole lineage. Spark picks
        the join; without a broadcast it is a sort-merge join, which can spill. With ``keep_created`` matched rows
        keep their time of creation.
        """
        keep = (CREATED_AT,) if keep_created else ()
        buckets = None if on_duplicate == "keep_all" else self._live_buckets()
        with Staging(self.spark, self.name) as staging:
            batch, self.removed_rows = staging.settled(updates, self.key, on_duplicate, modified, buckets)
            if on_duplicate == "keep_all":
                # One read of the target's keys serves the check, the update and the insert.
                present = staging.stage(keys_present(self.read(), batch, self.key))
                few = present.count() <= FEW_KEYS
                merged = update_every_row(self.read(), batch, self.key, present, keep, few)
            else:
                merged = replace_rows(self.read(), batch, batch.select(self.key), self.key, keep)
            return self._publish(self._write_version(merged, buckets, modified))

    def rebucket(self, buckets: int | None) -> DataFrame:
        """Split the target anew; its keys must not repeat."""
        self.buckets = buckets
        rows = self.read().repartition(buckets, self.key) if buckets else self.read()
        return self._publish(self._write_version(rows, buckets))

    def drop_old_versions(self) -> list[str]:
        """Drop every version but the newest, files included; call it when no reader uses the older ones any more."""
        namespace, _, short = self.name.rpartition(".")
        live = self._live_version()
        listed = self.spark.sql(f"SHOW TABLES {f'IN {namespace} ' if namespace else ''}LIKE '{short}__*'").collect()
        tables = [f"{namespace}.{row['tableName']}" if namespace else row["tableName"] for row in listed]
        version = re.compile(rf"{re.escape(short)}__[0-9a-f]{{32}}", re.IGNORECASE)
        old = [table for table in tables if table.lower() != live.lower() and version.fullmatch(table.rpartition(".")[2])]
        for table in old:
            self._drop(table)
        return old

    def _drop(self, table: str) -> None:
        """Drop a version, files included."""
        described = self.spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name IN ('Location', 'Type')").collect()
        about = {row["col_name"]: row["data_type"] for row in described}
        self.spark.sql(f"DROP TABLE {table}")
        if about.get("Type") == "EXTERNAL":
            remove_files(self.spark, about["Location"])

    def _publish(self, version: str) -> DataFrame:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {version}")
        return self.read()

    def _live_version(self) -> str:
        """The table the view points at."""
        namespace, _, short = self.name.rpartition(".")
        definition = self.spark.sql(f"SHOW CREATE TABLE {self.name}").first()[0]
        version = re.search(rf"{re.escape(short)}__[0-9a-f]{{32}}", definition, re.IGNORECASE).group()
        return f"{namespace}.{version}" if namespace else version

    def _live_buckets(self) -> int | None:
        """How many buckets the newest version has."""
        described = self.spark.sql(f"DESCRIBE EXTENDED {self._live_version()}").where("col_name = 'Num Buckets'").first()
        return int(described["data_type"]) if described else None

    def _kept_watermarks(self) -> dict[str, datetime]:
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self._live_version()}").collect()
        return {
            row["key"].removeprefix(KEPT_WATERMARK): datetime.fromisoformat(row["value"])
            for row in properties
            if row["key"].startswith(KEPT_WATERMARK)
        }

    def _write_version(self, df: DataFrame, buckets: int | None, modified: str = MODIFIED) -> str:
        """Write a version and keep its watermarks with it."""
        if not self.systems or not {"source_system", modified} <= set(df.columns):
            return self._write(df, buckets)
        seen = Observation()
        newest = [F.max(F.when(F.col("source_system") == s, F.col(modified))).alias(s) for s in self.systems]
        name = self._write(df.observe(seen, *newest), buckets)
        kept = ", ".join(f"'{KEPT_WATERMARK}{s}' = '{(seen.get[s] or EPOCH).isoformat()}'" for s in self.systems)
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({kept})")
        return name

    def _write(self, df: DataFrame, buckets: int | None) -> str:
        """Write ``df`` as a new table and return its name."""
        name = f"{self.name}__{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("compression", COMPRESSION)
        if buckets:
            writer = writer.bucketBy(buckets, self.key)
        if self.folder:
            writer = writer.option("path", f"{self.folder}/{name}")
        with removing_shuffles(self.spark):
            writer.saveAsTable(name)
        return name


class PartitionedTarget:
    """A merge target partitioned by the month of a date column; a merge reads and writes touched months only.

    Every merge writes partitions of its own version number: the new content of the months whose rows it matches, and the rows
    that it only adds to others; the view then names the versions of each month that hold. A month that merges have
    added to is one version again when a merge matches one of its rows. Readers so see all of a merge or nothing, and a
    merge that fails leaves partitions that nobody reads and the next merge drops.

    A narrow table beside the rows tells the months of each key. It is bucketed by the key: a merge finds the months of
    matched rows by shuffling its batch and not the target's keys. A merge appends its keys there and rewrites
    nothing; a key that moved keeps its former month too, which at worst has a month rewritten that need not be, until
    ``compact`` writes the table anew. The number of ``buckets`` is used at the first load (by default that of shuffle
    partitions) and then kept. The newest time of each system is kept per month, taken from the months a merge wrote, so
    watermarks need no scan of the target.

    ``keep_all`` keeps repeated keys: every row of an updated key takes the update, whatever its month. Months reach the
    driver: a few values for each month of the calendar. One writer at a time.
    """

    MONTH, VERSION = "_month", "_version"

    def __init__(self, spark: SparkSession, name: str, key: str, date_column: str, buckets: int | None = None):
        self.spark = spark
        self.name = name
        self.key = key
        self.date_column = date_column
        self.buckets = buckets
        self.rows_table = f"{name}_rows"
        self.places_table = f"{name}_places"
        self.removed_rows = 0

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def watermarks(self, systems) -> dict[str, datetime]:
        kept = _PartitionedState.of(self).newest
        if kept is None:
            return high_watermarks(self.read(), systems)
        by_system = {system.upper(): EPOCH for system in systems}
        for (system, _), newest in kept.items():
            if system in by_system:
                by_system[system] = max(by_system[system], newest)
        return by_system

    def newest(self) -> datetime:
        kept = _PartitionedState.of(self).newest
        return high_watermark(self.read()) if kept is None else max(kept.values(), default=EPOCH)

    def load(self, df: DataFrame, on_duplicate: str, modified: str = MODIFIED) -> DataFrame:
        """Rows go straight into the next version: until that is published nobody reads it, so repeated keys are looked for there.

        Under ``latest`` the months that hold repeated keys, and only these, are then written once more without them.
        """
        state = _PartitionedState.of(self) if self.exists() else _PartitionedState()
        state.buckets = state.buckets or self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        require_policy(on_duplicate)
        state.live, state.newest = {}, {}
        state.first_places = state.version + 1
        self.removed_rows = 0
        with Staging(self.spark, self.name) as staging:
            written = self._write(self._by_month(self._with_month(df)), state)
            if on_duplicate == "error":
                require_unique(written, self.key)
            pairs = self._pairs(written, state)
            if on_duplicate == "latest":
                pairs = staging.stage(pairs, state.buckets, self.key)
                written = self._settled_months(staging, written, df.columns, pairs, state, modified)
            self._append_places(pairs, state)
            return self._hold(written, state, [], modified)

    def merge(self, updates: DataFrame, on_duplicate: str, modified: str = MODIFIED,
              keep_created: bool = False) -> DataFrame:
        require_policy(on_duplicate)
        keep = (CREATED_AT,) if keep_created else ()
        state = _PartitionedState.of(self)
        with Staging(self.spark, self.name) as staging:
            if on_duplicate == "latest":
                # The months of the keys also count their rows, so the keys are moved once.
                batch = staging.stage(updates)
                pairs = staging.stage(self._pairs(batch, state), state.buckets, self.key)
                batch, self.removed_rows = staging.without_repeats(batch, self._counted(pairs), self.key, modified)
            else:
                batch, self.removed_rows = staging.settled(updates, self.key, on_duplicate, modified)
                pairs = staging.stage(self._pairs(batch, state), state.buckets, self.key)
            if pairs.isEmpty():
                return self.read()
            # Months that the batch only adds to are neither read nor written anew.
            matched = sorted(row[0] for row in self.matched_months(pairs).collect())
            # Both are bucketed by the key, so finding the keys that match moves no rows.
            keys = pairs.select(self.key).distinct()
            present = staging.stage(keys.join(self.places().select(self.key), self.key, "left_semi"))
            # Old rows that only meet a few keys stay in the order of their files, which is by month.
            few = present.count() <= FEW_KEYS
            old = self._rows(state, matched, with_month=True)
            new = self._by_month(self._with_month(batch)) if few else self._with_month(batch)
            if on_duplicate == "keep_all":
                merged = update_every_row(old, new, self.key, present, keep, few)
            else:
                merged = replace_rows(old, new, F.broadcast(present) if few else present, self.key, keep)
            merged = self._with_month(merged)
            written = self._write(merged if few else self._by_month(merged), state)
            self._append_places(pairs, state)
            return self._hold(written, state, matched, modified)

    def _settled_months(self, staging: Staging, written: DataFrame, columns: list[str], pairs: DataFrame, state: _PartitionedState,
                        modified: str) -> DataFrame:
        """What was written, with the months that hold repeated keys written anew under ``latest``, in place of the former ones."""
        rows_of_key = F.sum("_n").over(Window.partitionBy(self.key))
        repeats = pairs.select(self.MONTH, rows_of_key.alias("_all")).where("_all > 1")
        months = sorted(row[0] for row in repeats.select(self.MONTH).distinct().collect())
        if not months:
            return written
        former, at = state.version, F.col(self.MONTH).isin(months)
        rows = written.where(at).select(*columns, self.MONTH)
        rows, self.removed_rows = staging.without_repeats(rows, self._counted(pairs), self.key, modified, self._by_month)
        settled = self._write(rows, state)
        self._drop_months((month, former) for month in months)
        return self.spark.table(self.rows_table).where((F.col(self.VERSION) == former) & ~at).unionByName(settled)

    def places(self) -> DataFrame:
        """(key, month) of the rows that hold, and of former ones; bucketed by the key."""
        state = _PartitionedState.of(self)
        return self.spark.table(self.places_table).where(F.col(self.VERSION).between(state.first_places, state.version))

    def matched_months(self, pairs: DataFrame) -> DataFrame:
        """The months of rows that a batch of (key, month) matches."""
        return self._matched(pairs).distinct()

    def touched_months(self, pairs: DataFrame) -> DataFrame:
        """The months of rows that a batch of (key, month) matches, and its own."""
        return self._matched(pairs).union(pairs.select(self.MONTH)).distinct()

    def _matched(self, pairs: DataFrame) -> DataFrame:
        return self.places().join(pairs.select(self.key), self.key, "left_semi").select(self.MONTH)

    def compact(self) -> None:
        """Write the table of months anew from the rows; worth it when many merges have added to it."""
        state = _PartitionedState.of(self)
        self._drop_unfinished(state)
        state.version += 1
        state.first_places = state.version
        pairs = self._rows(state, list(state.live), with_month=True).select(self.key, self.MONTH).distinct()
        self._append_places(pairs.repartition(state.buckets, self.key), state)
        state.publish(self)

    def drop_old_versions(self) -> list[str]:
        """Drop months that later versions replaced and former tables of months; call it when nobody reads them any more."""
        state = _PartitionedState.of(self)
        gone = [(month, version) for month, version in self._partitions() if version not in state.live.get(month, ())]
        self._drop_months(gone)
        for row in self.spark.sql(f"SHOW PARTITIONS {self.places_table}").collect():
            version = int(row[0].partition("=")[2])
            if not state.first_places <= version <= state.version:
                self.spark.sql(f"ALTER TABLE {self.places_table} DROP IF EXISTS PARTITION ({self.VERSION} = {version})")
        return [f"{month}/{version}" for month, version in gone]

    def _pairs(self, batch: DataFrame, state: _PartitionedState) -> DataFrame:
        """(key, month) of the rows, once each, with their number, dealt by bucket: rows of a key lie together, so grouping moves none."""
        dealt = self._with_month(batch).select(self.key, self.MONTH).repartition(state.buckets, self.key)
        return dealt.groupBy(self.key, self.MONTH).agg(F.count(F.lit(1)).alias("_n"))

    def _counted(self, pairs: DataFrame) -> DataFrame:
        """The rows of each key. Stored pairs are bucketed by the key, so this moves none."""
        return pairs.groupBy(self.key).agg(F.sum("_n").alias("_n"))

    def _with_month(self, df: DataFrame) -> DataFrame:
        month = F.date_format(F.col(self.date_column).cast("timestamp"), "yyyy-MM")
        return df.withColumn(self.MONTH, F.coalesce(month, F.lit("none")))

    def _by_month(self, rows: DataFrame) -> DataFrame:
        """Rows dealt by month, a large month over several tasks, so that a task writes few files."""
        return rows.hint("rebalance", F.col(self.MONTH))

    def _rows(self, state: _PartitionedState, months: list[str], with_month: bool = False) -> DataFrame:
        """The rows that hold of some months."""
        rows = self.spark.table(self.rows_table).where(state.holding(self, months))
        return rows.drop(self.VERSION) if with_month else rows.drop(self.MONTH, self.VERSION)

    def _partitions(self) -> list[tuple[str, int]]:
        found = (dict(x.split("=") for x in row[0].split("/")) for row in self.spark.sql(f"SHOW PARTITIONS {self.rows_table}").collect())
        return [(x[self.MONTH], int(x[self.VERSION])) for x in found]

    def _drop_unfinished(self, state: _PartitionedState) -> None:
        """Drop what a failed merge has written: it took the version that comes next."""
        if self.spark.catalog.tableExists(self.rows_table):
            self._drop_months((month, version) for month, version in self._partitions() if version > state.version)
        if self.spark.catalog.tableExists(self.places_table):
            self.spark.sql(f"ALTER TABLE {self.places_table} DROP IF EXISTS PARTITION ({self.VERSION} = {state.version + 1})")

    def _drop_months(self, gone: Iterable[tuple[str, int]]) -> None:
        for month, version in gone:
            self.spark.sql(f"ALTER TABLE {self.rows_table} DROP IF EXISTS PARTITION ({self.MONTH} = '{month}', {self.VERSION} = {version})")

    def _append_places(self, pairs: DataFrame, state: _PartitionedState) -> None:
        with removing_shuffles(self.spark):
            (pairs.select(self.key, self.MONTH, F.lit(state.version).alias(self.VERSION)).write.format("parquet")
             .option("compression", COMPRESSION).mode("append")
             .partitionBy(self.VERSION).bucketBy(state.buckets, self.key).saveAsTable(self.places_table))

    def _write(self, rows: DataFrame, state: _PartitionedState) -> DataFrame:
        """Write the new content of months as the next version, and return it as it was written."""
        self._drop_unfinished(state)
        state.version += 1
        rows = rows.withColumn(self.VERSION, F.lit(state.version))
        if self.spark.catalog.tableExists(self.rows_table):
            add_columns(self.spark, self.rows_table, rows)
            table = self.spark.table(self.rows_table)
            have = {c.lower() for c in rows.columns}
            missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if f.name.lower() not in have}
            with removing_shuffles(self.spark):
                rows.withColumns(missing).select(*table.columns).write.mode("append").insertInto(self.rows_table)
        else:
            with removing_shuffles(self.spark):
                (rows.write.format("parquet").option("compression", COMPRESSION).partitionBy(self.MONTH, self.VERSION)
                 .saveAsTable(self.rows_table))
        return self.spark.table(self.rows_table).where(F.col(self.VERSION) == state.version)

    def _hold(self, written: DataFrame, state: _PartitionedState, former: list[str], modified: str) -> DataFrame:
        """Let what was written hold: in place of what the former months held, and beside what the others hold."""
        state.live = {month: versions for month, versions in state.live.items() if month not in former}
        known = state.newest is not None and {"source_system", modified} <= set(written.columns)
        newest = F.max(modified) if known else F.lit(None)
        by = [self.MONTH, self.VERSION, "source_system"] if known else [self.MONTH, self.VERSION]
        found = written.groupBy(*by).agg(newest.alias("newest")).collect()
        state.newest = {k: v for k, v in state.newest.items() if k[1] in state.live} if known else None
        for row in found:
            month, at = row[self.MONTH], row["newest"]
            state.live[month] = tuple(sorted({*state.live.get(month, ()), row[self.VERSION]}))
            if known and at:
                of = (row["source_system"] or "", month)
                state.newest[of] = max(at, state.newest.get(of, at))
        return state.publish(self)


@dataclass
class _PartitionedState:
    """What the view of a ``PartitionedTarget`` keeps: the versions of each month that hold, and the newest times by system and
    month (None where the rows have none)."""

    version: int = 0
    first_places: int = 1
    buckets: int = 0
    live: dict[str, tuple[int, ...]] = field(default_factory=dict)
    newest: dict[tuple[str, str], datetime] | None = field(default_factory=dict)

    @classmethod
    def of(cls, target: PartitionedTarget) -> _PartitionedState:
        kept = {row["key"]: row["value"] for row in target.spark.sql(f"SHOW TBLPROPERTIES {target.name}").collect()}
        state = cls(int(kept["version"]), int(kept["places"]), int(kept["buckets"]))
        state.live = {k.removeprefix("month."): tuple(map(int, v.split())) for k, v in kept.items() if k.startswith("month.")}
        state.newest = None if kept["watermarks"] == "none" else {
            tuple(k.removeprefix(KEPT_WATERMARK).rsplit(".", 1)): datetime.fromisoformat(v) for k, v in kept.items() if k.startswith(KEPT_WATERMARK)}
        return state

    def holding(self, target: PartitionedTarget, months: list[str]) -> str:
        """The condition for the partitions that hold of some months."""
        by_version: dict[int, list[str]] = {}
        for month in months:
            for version in self.live.get(month, ()):
                by_version.setdefault(version, []).append(f"'{month}'")
        parts = [f"({target.VERSION} = {v} AND {target.MONTH} IN ({', '.join(sorted(names))}))" for v, names in sorted(by_version.items())]
        return " OR ".join(parts) or "false"

    def publish(self, target: PartitionedTarget) -> DataFrame:
        kept = {"version": self.version, "places": self.first_places, "buckets": self.buckets,
                "watermarks": "none" if self.newest is None else "kept"}
        kept |= {f"month.{month}": " ".join(map(str, versions)) for month, versions in self.live.items()}
        kept |= {f"{KEPT_WATERMARK}{system}.{month}": time.isoformat() for (system, month), time in (self.newest or {}).items()}
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items())
        columns = ", ".join(f"`{c}`" for c in target.spark.table(target.rows_table).columns if c not in (target.MONTH, target.VERSION))
        target.spark.sql(f"CREATE OR REPLACE VIEW {target.name} TBLPROPERTIES ({properties}) AS SELECT {columns} "
                         f"FROM {target.rows_table} WHERE {self.holding(target, list(self.live))}")
        return target.read()


class StaleRunError(ValueError):
    """A history was asked to see a state that is older than one it has seen."""


class HistoryTarget:
    """A history table whose closed versions are never rewritten.

    Open versions are a ``TableTarget`` of their own. The versions that a run closes go into a partition of that run in a
    second table. Runs are numbered; the view keeps the number and the time of the newest finished run and shows the
    partitions up to it. A run that failed took the next number: it is not seen, and its partition goes when the next
    run starts. A run with the time of the newest one is a run like others; one with an older time is refused before
    anything is written, as its deletions would close versions before they began. A column that appears later is null in
    versions from before. One writer at a time.
    """

    RUN = "_run"

    def __init__(self, spark: SparkSession, name: str, key: str):
        self.spark = spark
        self.name = name
        self.key = key
        self.open = TableTarget(spark, f"{name}_open", key)
        self.closed = f"{name}_closed"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def last_run(self) -> tuple[int, datetime | None]:
        """Number and time of the newest finished run."""
        if not self.exists():
            return 0, None
        kept = {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if "run" not in kept:
            raise RuntimeError(f"{self.name} does not keep its runs by number; build it anew")
        return int(kept["run"]), datetime.fromisoformat(kept["run_ts"])

    def observe(self, current: DataFrame, updated_at: str, run_ts: datetime, close_deleted: bool = True) -> DataFrame:
        """Bring the history up to date with ``current``: one row per key, no null keys."""
        number, newest = self.last_run()
        if newest and run_ts < newest:
            raise StaleRunError(f"{self.name} has seen the state of {newest}; it cannot see that of {run_ts} after it")
        with Staging(self.spark, self.name) as staging:
            seen = staging.stage(current)
            before = self.spark.table(self._open_version()) if number else None
            versions = staging.stage(next_versions(before, seen, self.key, updated_at, run_ts, close_deleted))
            is_open = F.col(VALID_TO).isNull()
            self._close(versions.where(~is_open), number + 1)
            columns = ", ".join(f"`{c}`" for c in versions.columns)
            self.open.replace(versions.where(is_open))
            live = self.open._live_version()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} "
                       f"TBLPROPERTIES ('run' = '{number + 1}', 'run_ts' = '{run_ts.isoformat()}', 'open' = '{live}') "
                       f"AS SELECT {columns} FROM {live} UNION ALL SELECT {columns} FROM {self.closed} WHERE {self.RUN} <= {number + 1}")
        return self.read()

    def drop_old_versions(self) -> list[str]:
        """Drop open versions that earlier or failed runs left; closed ones stay."""
        self.open._publish(self._open_version())
        return self.open.drop_old_versions()

    def _open_version(self) -> str:
        """The open versions that the newest finished run wrote; a failed one may have written others after it."""
        kept = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where("key = 'open'").first()
        return kept["value"]

    def _close(self, closed: DataFrame, number: int) -> None:
        """Write the versions that a run closes into its partition, which no finished run has."""
        closed = closed.withColumn(self.RUN, F.lit(number))
        if not self.spark.catalog.tableExists(self.closed):
            closed.write.format("parquet").partitionBy(self.RUN).saveAsTable(self.closed)
            return
        self.spark.sql(f"ALTER TABLE {self.closed} DROP IF EXISTS PARTITION ({self.RUN} = {number})")
        add_columns(self.spark, self.closed, closed)
        table = self.spark.table(self.closed)
        have = {c.lower() for c in closed.columns}
        missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if f.name.lower() not in have}
        closed.withColumns(missing).select(*table.columns).write.mode("append").insertInto(self.closed)


class RowLevelTarget:
    """A merge target in a catalog that runs MERGE itself. Unproven: no such catalog is installed here, and only
    the statement is tested."""

    removed_rows = 0

    def __init__(self, spark: SparkSession, name: str, key: str):
        self.spark = spark
        self.name = name
        self.key = key

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def watermarks(self, systems) -> dict[str, datetime]:
        return high_watermarks(self.read(), systems)

    def newest(self) -> datetime:
        return high_watermark(self.read())

    def load(self, df: DataFrame, on_duplicate: str, modified: str = MODIFIED) -> DataFrame:
        settle(df, self.key, on_duplicate, modified).writeTo(self.name).createOrReplace()
        return self.read()

    def merge(self, updates: DataFrame, on_duplicate: str, modified: str = MODIFIED,
              keep_created: bool = False) -> DataFrame:
        if keep_created:
            raise ValueError("a row-level merge replaces the time of creation")
        merge_into(self.name, updates, self.key, on_duplicate, modified)
        return self.read()
