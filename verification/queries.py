"""Every query the driver runs: ``(spark, folder of test tables) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import functions as fn
from ledgerspark import operators as op
from ledgerspark.plans import MODELS, build, run, run_all
from ledgerspark.settings import RunContext, Settings
from ledgerspark.sources import HistoryTarget, PartitionedTarget, TableTarget, buckets_for, shared_folder
from verification.erp_views import ErpViews, read_table

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT = RunContext(run_ts=datetime(2024, 1, 1), run_id="test-run", as_of_date=date(1998, 6, 30))
BATCH_ONE_UNTIL = datetime(1998, 12, 31)
TRANSACTIONS = MODELS["fact_transactions"]
# For the test tables; larger ones take as many as their rows ask for.
FACT_BUCKETS = 8


def _fact_buckets(spark: SparkSession, sf_dir: str) -> int:
    """As many as the rows of the fact ask for: about one per line, which the footers of the files tell."""
    return buckets_for(spark, read_table(spark, sf_dir, "lineitem").count(), FACT_BUCKETS)


def scan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every source table."""
    views = ErpViews(spark, sf_dir)
    counts = [
        views.view(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source_table"), "n_rows")
        for name in views.names()
    ]
    return reduce(DataFrame.unionByName, counts)


def model(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's first run: every row, repeated keys included."""
    return build(MODELS[name], ErpViews(spark, sf_dir).catalog(), CONTEXT)


def two_runs(name: str, on_duplicate: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a model into a table: batch 1, then what is newer.

    ``latest`` keeps one row per key from the first load on. ``keep_all`` loads repeated keys as they are and lets
    every target row of an updated key take the update.
    """
    spec = MODELS[name]
    buckets = _fact_buckets(spark, sf_dir) if "fact" in spec.tags and on_duplicate != "keep_all" else None
    target = TableTarget(spark, f"{name}_{uuid.uuid4().hex}", spec.key, buckets, shared_folder(spark), spec.systems)
    run(spec, ErpViews(spark, sf_dir, until=BATCH_ONE_UNTIL).catalog(), CONTEXT, target, on_duplicate)
    result = run(spec, ErpViews(spark, sf_dir).catalog(), CONTEXT, target, on_duplicate)
    target.drop_old_versions()
    return result


def _two_runs_by_month(on_duplicate: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    target = PartitionedTarget(spark, f"by_month_{uuid.uuid4().hex}", TRANSACTIONS.key, "transactiondate", _fact_buckets(spark, sf_dir))
    run(TRANSACTIONS, ErpViews(spark, sf_dir, until=BATCH_ONE_UNTIL).catalog(), CONTEXT, target, on_duplicate)
    result = run(TRANSACTIONS, ErpViews(spark, sf_dir).catalog(), CONTEXT, target, on_duplicate)
    target.drop_old_versions()
    return result


def merge_partitioned_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into a table partitioned by month, of which the second reads and writes touched months only."""
    return _two_runs_by_month("latest", spark, sf_dir)


def merge_partitioned_all_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with repeated keys kept: every row of an updated key takes the update, in whatever month it is."""
    return _two_runs_by_month("keep_all", spark, sf_dir)


def _first_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(TRANSACTIONS, ErpViews(spark, sf_dir, until=BATCH_ONE_UNTIL).catalog(), CONTEXT)


def watermarks_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.watermarks_by_source(_first_transactions(spark, sf_dir))


def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions a second run reads, each system by its own watermark."""
    since = op.high_watermarks(_first_transactions(spark, sf_dir), TRANSACTIONS.systems)
    rows = build(TRANSACTIONS, ErpViews(spark, sf_dir).catalog(), CONTEXT, since=since)
    return rows.select("source_system", "transactionuniqueid", "last_modified_date")


def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions a second run reads with a window of three days behind the newest row."""
    newest = op.high_watermark(_first_transactions(spark, sf_dir))
    rows = build(TRANSACTIONS, ErpViews(spark, sf_dir).catalog(), CONTEXT, lookback=(newest, 3))
    return rows.select("source_system", "transactionuniqueid", "last_modified_date")


def incremental_lookback_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the window of the settings, here 30 days."""
    newest = op.high_watermark(_first_transactions(spark, sf_dir))
    sources = ErpViews(spark, sf_dir).catalog(Settings(lookback_days=30))
    rows = build(TRANSACTIONS, sources, CONTEXT, lookback=(newest, None))
    return rows.select("source_system", "transactionuniqueid", "last_modified_date")


def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return op.recent_rows(events, "ts", datetime(2024, 1, 31))


def soft_delete_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(status == "F", True).when(status == "O", False).alias("is_deleted")
    )
    return op.drop_soft_deleted(orders).drop("is_deleted")


def schema_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose updates bring one new column and lack one old column."""
    nation = read_table(spark, sf_dir, "nation")
    updates = nation.where(F.col("n_nationkey") % 2 == 0).select("n_nationkey", "n_regionkey")
    merged = op.upsert(nation.select("n_nationkey", "n_name"), updates, "n_nationkey", "error")
    return merged.select("n_nationkey", "n_name", "n_regionkey")


def snapshot_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers seen twice: some gone, some changed, some new the second time."""
    key = F.col("key")
    first = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.expr("dateadd(DAY, cast(c_custkey % 1000 as int), timestamp_ntz'1995-01-01')").alias("updated_at"),
    )
    a_day_later = F.expr("updated_at + interval 1 day")
    second = (
        first.where(key % 10 != 3)
        .withColumn("updated_at", F.when(key % 5 == 0, a_day_later).otherwise(F.col("updated_at")))
        .unionByName(first.where(key < 10).withColumn("key", -key - 1))
    )
    history = op.snapshot_scd2(None, first, "key", "updated_at", CONTEXT.run_ts)
    return op.snapshot_scd2(history, second, "key", "updated_at", CONTEXT.run_ts).drop("updated_at")


def _customers(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.expr("dateadd(DAY, cast(c_custkey % 1000 as int), timestamp_ntz'1995-01-01')").alias("updated_at"), *more)


def history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history over three runs, of which the second has the time of the first.

    The second time some customers are gone, some changed and some new; the third time others changed and the gone are back.
    """
    key, first = F.col("key"), _customers(spark, sf_dir)
    later = lambda some, days, mark: {
        "updated_at": F.when(some, F.expr(f"updated_at + interval {days} day")).otherwise(F.col("updated_at")),
        "name": F.when(some, F.concat("name", F.lit(mark))).otherwise(F.col("name")),
    }
    second = first.where(key % 10 != 3).withColumns(later(key % 5 == 0, 1, "/2")).unionByName(first.where(key < 10).withColumn("key", -key - 1))
    third = first.withColumns(later((key % 7 == 0) | (key % 10 == 3), 3, "/3"))
    target = HistoryTarget(spark, f"history_{uuid.uuid4().hex}", "key")
    for state, run_ts in [(first, CONTEXT.run_ts), (second, CONTEXT.run_ts), (third, datetime(2024, 2, 1))]:
        history = target.observe(state, "updated_at", run_ts)
    target.drop_old_versions()
    return history.drop("updated_at")


def history_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history whose second state has a column that the first had not."""
    key = F.col("key")
    second = _customers(spark, sf_dir, F.col("c_mktsegment").alias("segment")).where(key % 10 != 3).withColumn(
        "updated_at", F.when(key % 2 == 0, F.expr("updated_at + interval 1 day")).otherwise(F.col("updated_at")))
    target = HistoryTarget(spark, f"history_{uuid.uuid4().hex}", "key")
    target.observe(_customers(spark, sf_dir), "updated_at", CONTEXT.run_ts)
    return target.observe(second, "updated_at", datetime(2024, 2, 1)).drop("updated_at")


def run_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimensions run side by side into a database and schema of their own: rows per table."""
    settings = Settings(target_database="spark_catalog", reporting_schema=f"tagged_{uuid.uuid4().hex}")
    tables = run_all(spark, ErpViews(spark, sf_dir).catalog(), CONTEXT, "latest", tags=["dimension"], settings=settings)
    counts = [spark.table(f"spark_catalog.{settings.reporting_schema}.{name}").agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(name).alias("table_name"), "n_rows") for name in tables]
    return reduce(DataFrame.unionByName, counts)


def effective_dated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = ErpViews(spark, sf_dir)
    accounts = op.union_relations({
        "netsuite": views.view("ns_dim_chartofaccounts").select(F.col("account_id").cast("string")),
        "sage": views.view("sg_dim_chartofaccounts").select(F.col("account_id").cast("string")),
    })
    values = {"gaap_mapping_l1": "gaap_mapping_l1", "pandl_multiplier": "pandl_multiplier"}
    return op.effective_dated_join(accounts, views.view("map_coa_reporting"), CONTEXT.as_of_date, values).select(
        "source_system", "account_id", *values
    )


def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.union_relations({
        "customer": read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "supplier": read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    })


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    customers = op.with_key(customers, "key_1", [F.lit("SAGE"), "c_custkey"])
    some_null = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).cast("string")
    return op.with_key(customers, "key_2", [some_null, "c_name"]).drop("c_name")


def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"amount": "amount", "trx_amount": "convertedamount", "total_due": "openamount", "quantity": "quantity"}
    return ErpViews(spark, sf_dir).view("sg_fact_transaction").select(
        "tran_id", "transaction_line_number",
        *[fn.clean_number(F.col(name)).alias(out) for name, out in measures.items()],
    )


def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderstatus").alias("status")
    )
    return op.safe_cast_columns(orders, {"priority": ("int",), "status": ("int", -1)})


def normalize_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,4)").alias("amount"),
        F.when(F.col("l_linenumber") != 1, (1 + F.col("l_tax")).cast("decimal(10,4)")).alias("rate"),
    )
    rounded = op.normalize_amounts(lines, ["amount"], "rate").drop("rate")
    return rounded.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def fill_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("n_regionkey") != 0, F.substring("n_name", 1, 3))
    return op.fill_currency(read_table(spark, sf_dir, "nation").select("n_nationkey", known.alias("currency")), "currency")


def standardize_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("+1 ("), F.col("s_nationkey") + 100, F.lit(") "), F.col("s_suppkey") + 5550000).alias("phone"),
        F.concat(F.lit("  "), "s_name", F.lit("@Example.COM ")).alias("email"),
    )
    return op.standardize_contacts(suppliers, phones=["phone"], emails=["email"])


def assign_fiscal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.explode(F.array(F.lit(1), F.lit(4), F.lit(7))).alias("start_month")
    )
    return op.assign_fiscal_period(orders, "o_orderdate", F.col("start_month")).drop("o_orderdate")


_SINGLE: tuple[Query, ...] = (
    scan_sources, watermarks_by_source, incremental_watermark, incremental_lookback, incremental_lookback_configured,
    merge_partitioned_fact_transactions, merge_partitioned_all_fact_transactions, history_runs, history_added_column,
    run_by_tag, recent_rows, soft_delete_filter,
    schema_append, snapshot_scd2, effective_dated_join, union_relations, surrogate_key, clean_numeric, safe_cast,
    normalize_amounts, fill_currency, standardize_contacts, assign_fiscal_period,
)


def queries() -> dict[str, Query]:
    named = {f"model_{name}": partial(model, name) for name in MODELS}
    named |= {f"upsert_{name}": partial(two_runs, name, "latest") for name in MODELS}
    # The planning facts repeat keys within a batch, which a merge that keeps repeated keys refuses.
    unrepeated = [name for name in MODELS if name not in ("fact_budget", "fact_ebitda_adjs")]
    named |= {f"merge_{name}": partial(two_runs, name, "keep_all") for name in unrepeated}
    return named | {query.__name__: query for query in _SINGLE}
