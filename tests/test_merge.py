"""Merging: policies, schema changes, properties over random batches, and the written target."""

from __future__ import annotations

import os
import random
import uuid
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from ledgerspark import operators as op
from ledgerspark.plans import MODELS, RunAllError, build, run, run_all, run_snapshot, snapshot_target, target_of
from ledgerspark.settings import EPOCH, RunContext, Settings
from ledgerspark.sources import PartitionedTarget, RowLevelTarget, TableTarget, full_refresh, shared_folder, write_table
from tests.test_models import catalog
from verification.erp_views import ErpViews
from verification.queries import BATCH_ONE_UNTIL

SCHEMA = "k string, v string, last_modified_date timestamp_ntz"
DAY = datetime(2020, 1, 1)


def at(n):
    return None if n is None else DAY + timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, at(n)) for k, v, n in rows], SCHEMA)


def bag(df):
    return Counter(map(tuple, df.collect()))


def target(spark, key="k", **options):
    return TableTarget(spark, f"t_{uuid.uuid4().hex}", key, folder=shared_folder(spark), **options)


def test_latest_prefers_time_then_all_other_columns(spark):
    df = frame(spark, [("a", "x", 1), ("a", "y", 2), ("a", "z", None), ("b", "x", 3), ("b", "y", 3), ("c", None, None),
                       (None, "n", 1)])
    assert bag(op.latest_per_key(df, "k")) == Counter([("a", "y", at(2)), ("b", "y", at(3)), ("c", None, None),
                                                       (None, "n", at(1))])


def test_update_and_insert(spark):
    merged = op.upsert(frame(spark, [("a", "old", 5), ("b", "keep", 1)]), frame(spark, [("a", "new", 1), ("c", "add", 2)]), "k", "latest")
    assert bag(merged) == Counter([("a", "new", at(1)), ("b", "keep", at(1)), ("c", "add", at(2))])


def test_duplicate_updates(spark):
    old, twice = frame(spark, [("a", "old", 0)]), frame(spark, [("a", "x", 1), ("a", "y", 2)])
    assert bag(op.upsert(old, twice, "k", "latest")) == Counter([("a", "y", at(2))])
    for policy in ("error", "keep_all"):
        with pytest.raises(op.DuplicateKeyError):
            op.upsert(old, twice, "k", policy)
    with pytest.raises(ValueError, match="on_duplicate"):
        op.upsert(old, twice, "k", "whatever")


def test_keep_all_updates_every_row_of_a_key(spark):
    old = frame(spark, [("a", "1", 0), ("a", "2", 0), ("b", "3", 0)])
    new = frame(spark, [("a", "new", 1), ("c", "x", 1), ("c", "y", 1)])
    assert bag(op.upsert(old, new, "k", "keep_all")) == Counter(
        {("a", "new", at(1)): 2, ("b", "3", at(0)): 1, ("c", "x", at(1)): 1, ("c", "y", at(1)): 1})


def test_new_and_missing_columns(spark):
    old = spark.createDataFrame([("a", "v1", "only old"), ("b", "v2", "stays")], "k string, v string, o string")
    new = spark.createDataFrame([("a", "v3", 1), ("c", "v4", 2)], "K string, V string, n int")
    merged = op.upsert(old, new, "k", "latest")
    assert [c.lower() for c in merged.columns] == ["k", "v", "o", "n"]
    assert bag(merged) == Counter([("a", "v3", "only old", 1), ("b", "v2", "stays", None), ("c", "v4", None, 2)])
    twice = old.unionByName(old)
    assert bag(op.upsert(twice, new, "k", "keep_all"))[("a", "v3", "only old", 1)] == 2


row = st.tuples(st.sampled_from("abcde"), st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 5)))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=st.lists(row, min_size=1, max_size=8), second=st.lists(row, min_size=1, max_size=8))
def test_merge_against_a_dictionary(spark, first, second):
    def winners(rows):
        def rank(r):
            return (r[2] is not None, r[2] or 0, r[1] is not None, r[1] or "")
        best = {}
        for r in rows:
            if r[0] not in best or rank(r) > rank(best[r[0]]):
                best[r[0]] = r
        return best

    once = op.upsert(op.latest_per_key(frame(spark, first), "k"), frame(spark, second), "k", "latest")
    wanted = {k: (k, v, at(n)) for k, (_, v, n) in (winners(first) | winners(second)).items()}
    assert bag(once) == Counter(wanted.values())
    assert bag(op.upsert(once, frame(spark, second), "k", "latest")) == Counter(wanted.values())


@pytest.mark.parametrize("buckets", [None, 8, 3])
@pytest.mark.parametrize("policy", ["latest", "error", "keep_all"])
def test_written_merge_equals_pure_merge(spark, buckets, policy):
    rng = random.Random(2)
    first = [(f"k{i}", rng.choice("xyz"), rng.randint(0, 9)) for i in range(200)]
    second = [(f"k{i}", rng.choice("xyz"), rng.randint(0, 9)) for i in range(100, 300)]
    if policy == "latest":
        first, second = first * 3, second + [("k100", "later", 50)] * 400
    if policy == "keep_all":
        first += [("k0", "twin", 1), ("k150", "twin", 1)]
    table = target(spark, buckets=buckets)
    table.load(frame(spark, first), policy)
    before = op.latest_per_key(frame(spark, first), "k") if policy == "latest" else frame(spark, first)
    assert bag(table.read()) == bag(before)
    assert bag(table.merge(frame(spark, second), policy)) == bag(op.upsert(before, frame(spark, second), "k", policy))


@pytest.mark.parametrize("policy", ["latest", "keep_all"])
def test_types_of_the_target_stay(spark, policy):
    old = spark.createDataFrame([("a", 1.5, "x")], "k string, v double, t string")
    new = spark.createDataFrame([("a", 2, 7), ("b", 3, None)], "k string, v int, t int")
    merged = op.upsert(old, new, "k", policy)
    assert merged.dtypes == old.dtypes
    assert bag(merged) == Counter([("a", 2.0, "7"), ("b", 3.0, None)])


def test_target_appends_columns_and_drops_old_versions(spark):
    table = target(spark)
    table.load(frame(spark, [("a", "x", 1)]), "latest")
    more = spark.createDataFrame([("b", "y", at(2), 7)], SCHEMA + ", extra int")
    assert bag(table.merge(more, "latest")) == Counter([("a", "x", at(1), None), ("b", "y", at(2), 7)])
    assert len(table.drop_old_versions()) == 1
    assert table.drop_old_versions() == []
    assert table.read().count() == 2


def test_buckets_stay_with_the_target(spark):
    """Neither another argument nor another number of shuffle partitions splits a target anew; ``rebucket`` does."""
    table = target(spark, buckets=3)
    table.load(frame(spark, [(f"k{i}", "x", 1) for i in range(500)]), "latest")
    other = TableTarget(spark, table.name, "k", buckets=5, folder=table.folder)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        merged = other.merge(frame(spark, [(f"k{i}", "y", 2) for i in range(400, 600)]), "latest")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(r["v"] for r in merged.collect()) == {"x": 400, "y": 200}
    assert other._live_buckets() == 3
    assert other.rebucket(5).count() == 600
    assert other._live_buckets() == 5
    assert len(spark.table(other._live_version()).inputFiles()) <= 10


def test_removed_rows_are_told(spark):
    table = target(spark)
    table.load(frame(spark, [("a", "x", 1), ("a", "y", 2), ("b", "z", 1)]), "latest")
    assert table.removed_rows == 1
    table.merge(frame(spark, [("c", "x", 1)]), "latest")
    assert table.removed_rows == 0
    with pytest.raises(TypeError):
        table.merge(frame(spark, [("c", "x", 1)]))


def test_error_refuses_the_repeats_of_a_model(spark):
    spec = MODELS["dim_customer"]
    sources = ErpViews(spark, "/root/testdata/sf0.001").catalog()
    table = target(spark, spec.key)
    with pytest.raises(op.DuplicateKeyError):
        run(spec, sources, run_context(), table, "error")
    assert not table.exists()
    everything = build(spec, sources, run_context()).count()
    assert run(spec, sources, run_context(), table, "keep_all").count() == everything
    single = target(spark, spec.key)
    assert run(spec, sources, run_context(), single, "latest").count() < everything


@pytest.mark.parametrize("policy", ["latest", "keep_all"])
def test_time_of_creation_can_stay(spark, policy):
    schema = "k string, v string, _created_at timestamp_ntz"
    old = spark.createDataFrame([("a", "x", at(1)), ("b", "x", None)], schema)
    new = spark.createDataFrame([("a", "y", at(2)), ("b", "y", at(2)), ("c", "y", at(2))], schema)
    wanted = Counter([("a", "y", at(1)), ("b", "y", None), ("c", "y", at(2))])
    assert bag(op.upsert(old, new, "k", policy, keep=("_created_at",))) == wanted
    table = target(spark)
    table.replace(old)
    assert bag(table.merge(new, policy, keep_created=True)) == wanted


def files_of(folder):
    return {os.path.join(path, name) for path, _, names in os.walk(folder.removeprefix("file:")) for name in names if name.endswith(".parquet")}


def staged_tables(spark, table):
    return [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{table.name}__staged*'").collect()]


def test_nothing_is_left_of_staged_batches_and_old_versions(spark):
    folder = f"{shared_folder(spark)}/own_{uuid.uuid4().hex}"
    table = TableTarget(spark, f"t_{uuid.uuid4().hex}", "k", folder=folder)
    table.load(frame(spark, [("a", "x", 1), ("a", "y", 1)]), "keep_all")
    for n in (2, 3):
        table.merge(frame(spark, [("b", "x", n)]), "latest")
    with pytest.raises(op.DuplicateKeyError):
        table.merge(frame(spark, [("a", "1", 1), ("a", "2", 1)]), "keep_all")
    assert staged_tables(spark, table) == []
    assert len(os.listdir(folder.removeprefix("file:"))) == 3
    assert len(table.drop_old_versions()) == 2
    assert files_of(folder) == {f.removeprefix("file://") for f in table.read().inputFiles()}


def test_a_batch_of_one_month_rewrites_that_month(spark):
    schema = "k string, v string, d date, last_modified_date timestamp_ntz"
    rows = [(f"k{i}", "old", date(2020, 1 + i % 4, 1 + i % 28), at(0)) for i in range(80)] + [("none", "old", None, at(0))]
    table = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d")
    table.load(spark.createDataFrame(rows, schema), "latest")
    before = set(spark.table(table.name).inputFiles())
    batch = [("k1", "new", date(2020, 2, 5), at(1)), ("more", "new", date(2020, 2, 9), at(1))]
    merged = table.merge(spark.createDataFrame(batch, schema), "latest")
    wanted = {r[0]: r for r in rows} | {r[0]: r for r in batch}
    assert bag(merged) == Counter(wanted.values())
    after = set(spark.table(table.name).inputFiles())
    assert {f for f in before if f not in after} == {f for f in before if "_month=2020-02" in f}
    assert staged_tables(spark, table) == []


def test_rows_that_leave_a_month_and_new_columns(spark):
    schema = "k string, v string, d date, last_modified_date timestamp_ntz"
    rows = [("a", "1", date(2020, 1, 1), at(0)), ("b", "2", date(2020, 2, 1), at(0))]
    table = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d")
    table.load(spark.createDataFrame(rows, schema), "error")
    moved = spark.createDataFrame([("a", "1", date(2020, 3, 1), at(1), 7)], schema + ", n int")
    assert bag(table.merge(moved, "error")) == Counter(
        [("a", "1", date(2020, 3, 1), at(1), 7), ("b", "2", date(2020, 2, 1), at(0), None)])
    with pytest.raises(op.DuplicateKeyError):
        table.merge(spark.createDataFrame(rows * 2, schema), "error")
    assert table.merge(spark.createDataFrame([], schema), "latest").count() == 2


def test_a_failed_merge_leaves_the_old_state(spark):
    table = target(spark)
    table.load(frame(spark, [("a", "x", 1)]), "latest")
    broken = frame(spark, [("b", "not a number", 1)]).selectExpr("k", "cast(cast(v as int) as string) as v", "last_modified_date")
    with pytest.raises(PySparkException):
        table.merge(broken, "latest")
    assert bag(table.read()) == Counter([("a", "x", at(1))])


def test_full_refresh_keeps_duplicates_and_plain_tables(spark):
    table = target(spark)
    assert full_refresh(frame(spark, [("a", "x", 1)] * 3), table).count() == 3
    name = f"plain_{uuid.uuid4().hex}"
    for n in (3, 2):
        write_table(spark.range(n), name)
    assert spark.table(name).count() == 2


def test_row_level_merge_needs_a_catalog_that_has_it(spark):
    """No such catalog is installed; the statement must be complete up to that point."""
    name = f"plain_{uuid.uuid4().hex}"
    write_table(frame(spark, [("a", "x", 1)]), name)
    table = RowLevelTarget(spark, f"default.{name}", "k")
    assert table.exists() and table.read().count() == 1
    with pytest.raises(PySparkException, match="does not support MERGE INTO"):
        table.merge(frame(spark, [("a", "y", 2)]), "error")


def test_watermarks(spark):
    df = spark.createDataFrame(
        [("NETSUITE", at(1)), ("NETSUITE", at(3)), ("SAGE", None), ("OTHER", at(9))],
        "source_system string, last_modified_date timestamp_ntz")
    assert op.high_watermarks(df, ["netsuite", "SAGE", "NEW"]) == {"NETSUITE": at(3), "SAGE": EPOCH, "NEW": EPOCH}
    assert op.high_watermark(df) == at(9)
    assert op.high_watermark(df.limit(0)) == EPOCH
    assert bag(op.watermarks_by_source(df)) == Counter([("NETSUITE", at(3)), ("SAGE", EPOCH), ("OTHER", at(9))])


def test_strict_watermark_and_lookback(spark):
    df = frame(spark, [("before", "", 4), ("at", "", 5), ("after", "", 6), ("none", "", None), ("edge", "", 2), ("far", "", 1)])

    def keys(condition):
        return {r["k"] for r in df.where(condition).collect()}

    assert keys(op.newer_than("last_modified_date", at(5))) == {"after"}
    assert keys(op.within_lookback("last_modified_date", at(5))) == {"before", "at", "after", "edge"}
    assert keys(op.within_lookback("last_modified_date", at(5), 0)) == {"at", "after"}
    assert {r["k"] for r in op.recent_rows(df, "last_modified_date", at(7), 2).collect()} == {"at", "after"}


def run_context(n=0):
    return RunContext(datetime(2024, 1, 1) + timedelta(days=n), f"run {n}", date(2020, 1, 1))


def test_two_ordered_batches_equal_one_load(spark):
    """Only for keys that contain the system; otherwise systems overwrite each other."""
    first = [{"item_id": str(i), "item_name": "a", "last_modified_date": at(i % 3)} for i in range(10)]
    second = [{"item_id": str(i), "item_name": "b", "last_modified_date": at(5 + i)} for i in range(5, 15)]
    spec, columns = MODELS["dim_item"], ["item_key", "source_system", "item_id", "item_name", "last_modified_date"]
    early = catalog(spark, netsuite_dim_item=first, sage_dim_item=first)
    late = catalog(spark, netsuite_dim_item=first + second, sage_dim_item=first + second)
    two, one = target(spark, spec.key), target(spark, spec.key)
    run(spec, early, run_context(), two, "latest")
    run(spec, late, run_context(), two, "latest")
    run(spec, late, run_context(), one, "latest")
    assert bag(two.read().select(columns)) == bag(one.read().select(columns))
    unchanged = bag(two.read())
    run(spec, late, run_context(1), two, "latest")
    assert bag(two.read()) == unchanged
    ran_again = run(spec, late, run_context(2), two, "latest", refresh=True)
    assert {r["_dbt_run_id"] for r in ran_again.collect()} == {"run 2"}
    assert run(spec, early, run_context(3), two, "latest", reload=True).count() == 20


def test_null_times_load_once_and_lookback_reads_back(spark):
    rows = [{"class_id": "none"}, {"class_id": "old", "last_modified_date": at(1)},
            {"class_id": "late", "last_modified_date": at(9)}]
    spec = MODELS["dim_class"]
    table = target(spark, spec.key)
    sources = catalog(spark, netsuite_dim_classification=rows)
    assert run(spec, sources, run_context(), table, "latest").count() == 3

    def runs(df):
        return {r["class_id"]: r["_dbt_run_id"] for r in df.collect()}

    assert set(runs(run(spec, sources, run_context(1), table, "latest")).values()) == {"run 0"}
    assert runs(run(spec, sources, run_context(2), table, "latest", lookback_days=3)) == {
        "none": "run 0", "old": "run 0", "late": "run 2"}


def test_a_new_mapping_needs_a_refresh(spark):
    accounts = [{"account_id": "1", "account_number": "9", "last_modified_date": at(1)}]

    def sources(name):
        mapping = [{"account_id": "1", "source_system": "sage", "effective_from": date(2019, 1, 1),
                    "effective_to": date(2021, 1, 1), "debt_mapping": name}]
        return catalog(spark, sage_dim_chartofaccounts=accounts, mapping_map_coa_reporting=mapping)

    spec = MODELS["dim_chart_of_accounts"]
    table = target(spark, spec.key)

    def mapped(df):
        return [r["debtmapping"] for r in df.collect()]

    assert mapped(run(spec, sources("first"), run_context(), table, "latest")) == ["first"]
    assert mapped(run(spec, sources("second"), run_context(1), table, "latest")) == ["first"]
    assert mapped(run(spec, sources("second"), run_context(2), table, "latest", refresh=True)) == ["second"]


def test_shared_keys_move_the_other_watermark_back(spark):
    """Both systems use id 1: the second takes the row over, so the first system's newest time is lost."""
    tables = dict(netsuite_dim_locations=[{"location_id": "1", "last_modified_date": at(5)},
                                          {"location_id": "2", "last_modified_date": at(1)}],
                  sage_dim_location=[{"location_id": "1", "last_modified_date": at(9)}])
    spec = MODELS["dim_location"]
    table = target(spark, spec.key)
    loaded = run(spec, catalog(spark, **tables), run_context(), table, "latest")
    assert op.high_watermarks(loaded, ["NETSUITE", "SAGE"]) == {"NETSUITE": at(1), "SAGE": at(9)}
    again = run(spec, catalog(spark, **tables), run_context(1), table, "latest")
    assert {r["location_id"]: r["source_system"] for r in again.collect()} == {"1": "NETSUITE", "2": "NETSUITE"}


@pytest.mark.parametrize("name, policy", [
    ("dim_location", "latest"), ("dim_subsidiary", "latest"), ("fact_transactions", "latest"),
    ("dim_currency", "keep_all"), ("fact_transactions", "keep_all"),
])
def test_kept_watermarks_are_those_of_a_scan(spark, name, policy):
    spec, folder = MODELS[name], "/root/testdata/sf0.001"
    kept = target(spark, spec.key, systems=spec.systems)
    scanned = TableTarget(spark, kept.name, spec.key)
    for until in (datetime(1996, 1, 1), BATCH_ONE_UNTIL, None):
        run(spec, ErpViews(spark, folder, until=until).catalog(), run_context(), kept, policy)
        assert set(kept._kept_watermarks()) == {"NETSUITE", "SAGE"}
        assert kept.watermarks(spec.systems) == op.high_watermarks(kept.read(), spec.systems)
        assert kept.newest() == scanned.newest() == op.high_watermark(kept.read())
    assert kept.watermarks(["sage", "other"]) == op.high_watermarks(kept.read(), ["SAGE", "OTHER"])


def test_empty_targets_keep_the_first_watermark(spark):
    spec = MODELS["dim_class"]
    table = target(spark, spec.key, systems=spec.systems)
    run(spec, catalog(spark), run_context(), table, "latest")
    assert table.watermarks(spec.systems) == {"NETSUITE": EPOCH, "SAGE": EPOCH}
    later = [{"class_id": "1", "last_modified_date": at(1)}]
    assert run(spec, catalog(spark, sage_dim_classification=later), run_context(), table, "latest").count() == 1
    assert table.watermarks(spec.systems) == {"NETSUITE": EPOCH, "SAGE": at(1)}


def test_run_all_of_a_tag(spark):
    rows = [{"class_id": "1", "last_modified_date": at(1)}]
    done = run_all(spark, catalog(spark, sage_dim_classification=rows), run_context(), "error", tags=["class"])
    assert list(done) == ["dim_class"] and done["dim_class"].count() == 1
    assert spark.table("reporting.dim_class").count() == 1


def test_run_all_models_twice(spark):
    """Every model into a namespace of its own, first batch then everything; keys stay unique."""
    options = Settings(reporting_schema=f"space_{uuid.uuid4().hex}")
    folder = "/root/testdata/sf0.001"
    first = run_all(spark, ErpViews(spark, folder, until=BATCH_ONE_UNTIL).catalog(), run_context(), "latest", settings=options, buckets=4)
    before = {name: df.count() for name, df in first.items()}
    second = run_all(spark, ErpViews(spark, folder).catalog(), run_context(1), "latest", settings=options)
    assert set(second) == set(MODELS)
    for name, df in second.items():
        rows, keys = df.count(), df.select(MODELS[name].key).distinct().count()
        assert rows == keys >= before[name] > 0


def test_run_all_tells_what_failed(spark):
    options = Settings(reporting_schema=f"space_{uuid.uuid4().hex}", target_database="spark_catalog")
    given = {"sage_dim_classification": [{"class_id": "1", "last_modified_date": at(1)}],
             "sage_dim_item": [{"item_id": "1", "last_modified_date": at(1)}] * 2}
    with pytest.raises(RunAllError) as failure:
        run_all(spark, catalog(spark, **given), run_context(), "error", tags=["dimension"], settings=options)
    assert "dim_item" in failure.value.failed and "dim_class" in failure.value.done
    assert spark.table(f"spark_catalog.{options.reporting_schema}.dim_class").count() == 1


def test_outputs_go_to_the_named_database(spark):
    options = Settings(reporting_schema=" mine ", snapshot_schema=None, target_database="spark_catalog")
    assert target_of(spark, MODELS["dim_item"], options).name == "spark_catalog.mine.dim_item"
    assert snapshot_target(spark, "h", "k", options).name == "spark_catalog.default.h"
    assert target_of(spark, MODELS["dim_item"], options, buckets=9).buckets is None
    assert target_of(spark, MODELS["fact_budget"], options, buckets=9).buckets == 9


def test_the_configured_window(spark):
    rows = [{"class_id": str(n), "last_modified_date": at(n)} for n in range(10)]
    spec, table = MODELS["dim_class"], target(spark, MODELS["dim_class"].key)
    for days in (2, 5):
        sources = catalog(spark, netsuite_dim_classification=rows)
        sources.settings = Settings(lookback_days=days)
        run(spec, sources, run_context(), table, "latest", reload=True)
        found = run(spec, sources, run_context(1), table, "latest", lookback=True)
        assert sum(r["_dbt_run_id"] == "run 1" for r in found.collect()) == days + 1


def test_history(spark):
    def now(*rows):
        return spark.createDataFrame([(k, v, at(n)) for k, v, n in rows], "k int, v string, u timestamp_ntz")

    table = snapshot_target(spark, f"history_{uuid.uuid4().hex}", "k")
    first = run_snapshot(table, now((1, "a", 1), (2, "b", 1), (3, "c", 1)), "u", run_context())
    assert bag(first) == Counter([(1, "a", at(1), at(1), None), (2, "b", at(1), at(1), None), (3, "c", at(1), at(1), None)])
    second = run_snapshot(table, now((1, "a2", 2), (2, "changed, same time", 1), (4, "d", 2)), "u", run_context(1))
    gone = run_context(1).run_ts
    assert bag(second) == Counter([
        (1, "a", at(1), at(1), at(2)), (1, "a2", at(2), at(2), None), (2, "b", at(1), at(1), None),
        (3, "c", at(1), at(1), gone), (4, "d", at(2), at(2), None)])
    third = run_snapshot(table, now((1, "older", 1), (3, "back", 9)), "u", run_context(2), close_deleted=False)
    assert bag(third) == bag(second) + Counter()  | Counter([(3, "back", at(9), at(9), None)])


def test_closed_versions_are_not_rewritten(spark):
    def now(*rows):
        return spark.createDataFrame([(k, v, at(n)) for k, v, n in rows], "k int, v string, u timestamp_ntz")

    table = snapshot_target(spark, f"history_{uuid.uuid4().hex}", "k")
    run_snapshot(table, now((1, "a", 1), (2, "b", 1)), "u", run_context())
    run_snapshot(table, now((1, "a2", 2), (2, "b", 1)), "u", run_context(1))
    closed, seen = set(spark.table(table.closed).inputFiles()), bag(table.read())
    unchanged = run_snapshot(table, now((1, "a2", 2), (2, "b", 1)), "u", run_context(2))
    assert bag(unchanged) == seen
    run_snapshot(table, now((1, "a3", 3), (2, "b", 1)), "u", run_context(3))
    assert closed < set(spark.table(table.closed).inputFiles())
    before = bag(table.read())
    for wrong in ([(1, "x", 9), (1, "y", 9)], [(None, "x", 9)]):
        with pytest.raises(op.DuplicateKeyError):
            run_snapshot(table, now(*wrong), "u", run_context(4))
    assert bag(table.read()) == before
    again = run_snapshot(table, now((1, "a3", 3), (2, "b", 1)), "u", run_context(3))
    assert bag(again) - before == Counter()
