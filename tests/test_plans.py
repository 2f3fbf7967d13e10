"""Plans: what must reach the scan, and what must not be shuffled."""

from __future__ import annotations

import io
import uuid
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark.operators.upsert import keys_present, replace_rows, update_every_row
from ledgerspark.plans import MODELS, build
from ledgerspark.settings import NETSUITE, SAGE
from ledgerspark.sources import SourceCatalog, TableTarget, shared_folder
from ledgerspark.sources.targets import Staging
from verification.erp_views import ErpViews
from verification.queries import BATCH_ONE_UNTIL, CONTEXT

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The ERP inputs as Parquet files, so that the models' own plans show without the views below them."""
    folder = tmp_path_factory.mktemp("erp")
    views = ErpViews(spark, FOLDER)
    given = {}
    for name in ("ns_fact_transaction", "sg_fact_transaction", "ns_dim_entity", "sg_dim_customer"):
        path = str(folder / name)
        views.view(name).write.parquet(path)
        source = {"ns": "gold_netsuite", "sg": "gold_sage"}[name[:2]]
        given[(source, name[3:])] = path
    return SourceCatalog(spark, given=given)


def test_models_do_not_shuffle(stored):
    for name in ("fact_transactions", "fact_budget", "fact_ebitda_adjs"):
        text = plan(build(MODELS[name], stored, CONTEXT))
        assert "Exchange" not in text and "Join" not in text


def test_watermark_and_columns_reach_the_scan(stored):
    mark = datetime(1998, 1, 1)
    text = plan(build(MODELS["fact_budget"], stored, CONTEXT, since={NETSUITE: mark, SAGE: mark}))
    assert text.count("GreaterThan(last_modified_date,1998-01-01T00:00)") == 2
    assert "trx_amount" not in text and "net_amount" not in text


def test_customers_one_per_key_need_no_join(stored):
    exact = plan(build(MODELS["dim_customer"], stored, CONTEXT))
    assert "Join" in exact
    assert "ReadSchema: struct<entity_id:bigint>" in exact
    single = build(MODELS["dim_customer"], stored, CONTEXT, repeat_rows=False)
    assert "Join" not in plan(op.latest_per_key(single, "customer_key"))


def test_repeated_keys_are_reduced_before_the_shuffle(stored):
    text = plan(op.latest_per_key(build(MODELS["fact_budget"], stored, CONTEXT), "budget_transaction_key"))
    tree = text[:text.index("\n\n")]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1


@pytest.mark.parametrize("share", [1, 50])
def test_merge_shuffles_the_batch_only(spark, stored, no_broadcast, share):
    """One plan at every size of the batch: a join of buckets that can spill, without an exchange."""
    spec = MODELS["fact_transactions"]
    target = TableTarget(spark, f"p_{uuid.uuid4().hex}", spec.key, 8, shared_folder(spark))
    target.load(build(spec, ErpViews(spark, FOLDER, until=BATCH_ONE_UNTIL).catalog(), CONTEXT), "latest")
    rows = build(spec, stored, CONTEXT).where(F.xxhash64(spec.key) % share == 0)
    with Staging(spark, target.name) as staging:
        batch, _ = staging.settled(rows, spec.key, "latest", "last_modified_date", 8)
        text = plan(replace_rows(target.read(), batch, batch.select(spec.key), spec.key))
    tree = text[:text.index("\n\n")]
    assert "SortMergeJoin" in tree
    assert "Exchange" not in tree


def test_keeping_repeats_reads_the_targets_keys_once(spark, tmp_path, no_broadcast):
    spark.range(1000).selectExpr("cast(id as string) as k", "id as v").write.parquet(str(tmp_path / "t"))
    spark.range(10).selectExpr("cast(id as string) as k", "-id as v").write.parquet(str(tmp_path / "u"))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u"))
    keys_present(target, batch, "k").write.parquet(str(tmp_path / "p"))
    text = plan(update_every_row(target, batch, "k", spark.read.parquet(str(tmp_path / "p"))))
    assert text.count("/t]") == 1


def test_keys_of_a_target_are_not_broadcast(spark, tmp_path):
    """Repeated keys take few bytes in a file; a join would broadcast all their rows, however many."""
    spark.range(0, 200_000, 1, 2).selectExpr("cast(id div 1000 as string) as k", "id as v").write.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([("3", 1), ("3", 2), ("199", 3), ("new", 4), (None, 5)], "k string, v long")
    target = spark.read.parquet(str(tmp_path / "t")).union(spark.sql("SELECT cast(null AS string), 0L"))
    found = keys_present(target, batch, "k")
    assert "Join" not in plan(found) and "Broadcast" not in plan(found)
    assert sorted(row["k"] for row in found.collect()) == ["199", "3"]


def test_mapping_is_pruned_and_filtered(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "mapping")
    views = ErpViews(spark, FOLDER)
    views.view("map_coa_reporting").write.parquet(path)
    spark.range(9).selectExpr("cast(id as string) as account_id", "'SAGE' as source_system").write.parquet(str(tmp_path / "accounts"))
    accounts = spark.read.parquet(str(tmp_path / "accounts"))
    text = plan(op.effective_dated_join(accounts, spark.read.parquet(path), CONTEXT.as_of_date, {"debt_mapping": "d"}))
    assert text.count("LessThanOrEqual(effective_from,1998-06-30), GreaterThanOrEqual(effective_to,1998-06-30)") == 1
    assert "cashflow_l1" not in text
    tree = text[:text.index("\n\n")]
    assert tree.count("Scan parquet") == 2 and tree.count("Exchange") == 2 and tree.count("Join") == 1
