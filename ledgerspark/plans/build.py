"""Building models: from source tables to a finished output, first run or incremental."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.contracts import require_contract
from ledgerspark.functions import surrogate_key
from ledgerspark.operators.conform import Feed, conform
from ledgerspark.operators.jobs import with_audit
from ledgerspark.operators.joins import repeat_per_match
from ledgerspark.operators.union import union_rows
from ledgerspark.operators.upsert import require_policy
from ledgerspark.operators.watermark import newer_than, within_lookback
from ledgerspark.plans.dims import DIMENSIONS
from ledgerspark.plans.facts import FACTS
from ledgerspark.plans.model import Model
from ledgerspark.settings import RunContext, Settings
from ledgerspark.sources.catalog import SourceCatalog, qualified, target_namespace
from ledgerspark.sources.declared import COLUMNS
from ledgerspark.sources.targets import HistoryTarget, PartitionedTarget, RowLevelTarget, Staging, TableTarget

Target = TableTarget | PartitionedTarget | RowLevelTarget

#: Source tables that ``run_all`` reads once for all models that merge from them.
SHARED_TABLES = ("fact_transaction",)

MODELS: dict[str, Model] = {model.name: model for model in DIMENSIONS + FACTS}


def select_models(*tags: str) -> list[Model]:
    """The models that carry every given tag."""
    return [model for model in MODELS.values() if set(tags) <= set(model.tags)]


def build(model: Model, sources: SourceCatalog, ctx: RunContext, since: dict[str, datetime] | None = None,
          lookback: tuple[datetime, int | None] | None = None, repeat_rows: bool = True) -> DataFrame:
    """The rows a run of ``model`` produces, with repeated keys left in.

    ``since`` holds the high watermark per system and ``lookback`` a common watermark with a number of days (null:
    the sources' settings); with neither, the sources are read whole. ``repeat_rows=False`` leaves out copies that a join would make of a row,
    for callers that keep one row per key anyway.
    """
    if sources.spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled: without it bad numbers and dates would become null unnoticed")
    parts = [_feed_rows(model, feed, sources, since, lookback, repeat_rows) for feed in model.feeds]
    rows = union_rows(*parts)
    rows = rows.withColumns({name: make() for name, make in model.derived.items()})
    if model.enrich:
        rows = model.enrich(rows, sources.resolve, ctx)
    rows = with_audit(rows, ctx).select(*model.contract.fieldNames())
    return require_contract(rows, model.contract)


def run(model: Model, sources: SourceCatalog, ctx: RunContext, target: Target, on_duplicate: str,
        lookback_days: int | None = None, refresh: bool = False, reload: bool = False, lookback: bool = False,
        keep_created: bool = False) -> DataFrame:
    """Run a model into its target: load it when it does not exist, else merge what changed since.

    ``on_duplicate`` must be chosen: ``keep_all`` loads repeated keys as they are, ``error`` refuses them and
    ``latest`` keeps one row per key; ``target.removed_rows`` tells how many rows that removed. Watermarks come from the
    target, per source system. With ``lookback_days``, or ``lookback`` for the number in the sources' settings, the
    window instead reaches that many days behind the newest row of the whole target. ``refresh`` merges all source
    rows, as is needed after a change that their modification times do not show (a new mapping, another as-of date).
    ``reload`` builds the target anew. ``keep_created`` leaves matched rows their time of creation.
    """
    require_policy(on_duplicate)
    # Only ``latest`` may leave out copies of a row, as it would keep one of them anyway.
    repeat_rows = on_duplicate != "latest"
    if reload or not target.exists():
        return target.load(build(model, sources, ctx, repeat_rows=repeat_rows), on_duplicate)
    since = window = None
    if lookback or lookback_days is not None:
        window = (target.newest(), lookback_days)
    elif not refresh:
        since = target.watermarks(model.systems)
    updates = build(model, sources, ctx, since, window, repeat_rows=repeat_rows)
    return target.merge(updates, on_duplicate, keep_created=keep_created)


def _place(settings: Settings, schema: str | None, default_schema: str, spark: SparkSession) -> str:
    """The namespace of outputs, which is made if it is not there."""
    namespace = qualified(settings.target_database, target_namespace(schema, default_schema))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    return namespace


def target_of(spark: SparkSession, model: Model, settings: Settings = Settings(), default_schema: str = "default",
              buckets: int | None = None) -> TableTarget:
    """Where a model is kept: the reporting schema, or the default one when none is configured.

    ``buckets`` is for facts and counts when they are first loaded; dimensions are small next to them and have none.
    """
    namespace = _place(settings, settings.reporting_schema, default_schema, spark)
    buckets = buckets if "fact" in model.tags else None
    return TableTarget(spark, f"{namespace}.{model.name}", model.key, buckets, systems=model.systems)


def snapshot_target(spark: SparkSession, name: str, key: str, settings: Settings = Settings(),
                    default_schema: str = "default") -> HistoryTarget:
    """Where a history table is kept."""
    return HistoryTarget(spark, f"{_place(settings, settings.snapshot_schema, default_schema, spark)}.{name}", key)


class RunAllError(RuntimeError):
    """Some models failed: ``failed`` has their errors, ``done`` the results of the others."""

    def __init__(self, done: dict[str, DataFrame], failed: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failed.items()))
        self.done = done
        self.failed = failed


def run_all(spark: SparkSession, sources: SourceCatalog, ctx: RunContext, on_duplicate: str, tags=(),
            settings: Settings = Settings(), threads: int = 4, buckets: int | None = None,
            shared: tuple[str, ...] = SHARED_TABLES) -> dict[str, DataFrame]:
    """Run every model that carries the tags; if some fail, the others still run and ``RunAllError`` names both.

    Models do not depend on each other; a few run at a time. Each runs in a scheduler pool of its own, so that under fair
    scheduling (``settings.SESSION_OPTIONS``) a large fact does not hold all cores from the dimensions.

    Source tables named in ``shared`` that several incremental models read are scanned once: the columns that any of them
    needs, newer than the lowest of their watermarks, are staged and each takes its part. First loads read for
    themselves, as staging would write the whole source once more; so do the counts of all transactions of a customer,
    which ``latest`` does not need.
    """
    models = select_models(*tags)
    targets = {model.name: target_of(spark, model, settings, buckets=buckets) for model in models}

    def in_pool(model: Model) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", model.name)
        try:
            return run(model, once, ctx, targets[model.name], on_duplicate)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    namespace = next(iter(targets.values())).name.rpartition(".")[0] if targets else ""
    with Staging(spark, qualified(namespace, "run_all")) as staging:
        once = sources.sharing(_shared_batches(sources, models, targets, shared, staging))
        with ThreadPoolExecutor(threads) as pool:
            started = {m.name: pool.submit(in_pool, m) for m in models}
    failed = {name: future.exception() for name, future in started.items() if future.exception()}
    done = {name: future.result() for name, future in started.items() if name not in failed}
    if failed:
        raise RunAllError(done, failed)
    return done


def _shared_batches(sources: SourceCatalog, models: list[Model], targets: dict[str, TableTarget], shared: tuple[str, ...],
                    staging: Staging) -> dict[tuple[str, str], DataFrame]:
    """One staged batch for each shared table that several models with targets read by the same modification time."""
    readers: dict[tuple[str, str, str], list[tuple[Model, Feed]]] = {}
    for model in models:
        for feed in model.feeds:
            if feed.table in shared and feed.modified and targets[model.name].exists():
                readers.setdefault((feed.source, feed.table, feed.modified), []).append((model, feed))
    batches = {}
    for (source, table, modified), found in readers.items():
        if len(found) > 1:
            lowest = min(targets[model.name].watermarks(model.systems)[feed.system] for model, feed in found)
            rows = sources.resolve(source, table)
            columns = COLUMNS.get((source, table), "").split() or rows.columns
            batches[source, table] = staging.stage(rows.select(*columns).where(newer_than(modified, lowest)))
    return batches


def run_snapshot(target: HistoryTarget, current: DataFrame, updated_at: str, ctx: RunContext,
                 close_deleted: bool = True) -> DataFrame:
    """Bring a history table up to date with the current rows."""
    return target.observe(current, updated_at, ctx.run_ts, close_deleted)


def _feed_rows(model: Model, feed: Feed, sources: SourceCatalog, since, lookback, repeat_rows: bool) -> DataFrame:
    newer = feed.modified and since is not None
    df = sources.resolve_newer(feed.source, feed.table) if newer else sources.resolve(feed.source, feed.table)
    if feed.keep is not None:
        df = df.where(feed.keep())
    if feed.modified and since is not None:
        df = df.where(newer_than(feed.modified, since[feed.system]))
    if feed.modified and lookback is not None:
        df = df.where(within_lookback(feed.modified, *lookback, settings=sources.settings))
    if feed.matches and repeat_rows:
        source, table, own_id, other_id = feed.matches
        df = repeat_per_match(df, sources.resolve(source, table), F.col(own_id), other_id)
    rows = conform(df, feed, model.contract)
    parts = [F.col(name) for name in feed.key_parts or model.key_parts]
    return rows.withColumn(model.key, surrogate_key(*parts))
