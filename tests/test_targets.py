"""Targets that are published by version: histories that survive repeated and failed runs, and tables split by month."""

from __future__ import annotations

import uuid
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark.plans import MODELS, run_all
from ledgerspark.settings import RunContext, Settings
from ledgerspark.sources import HistoryTarget, PartitionedTarget, SourceCatalog, StaleRunError, TableTarget
from ledgerspark.sources import targets
from ledgerspark.operators.joins import repeat_per_match
from verification.erp_views import ErpViews
from verification.queries import BATCH_ONE_UNTIL

SCHEMA = "k string, v string, d date, source_system string, last_modified_date timestamp_ntz"


def at(n: int) -> datetime:
    return datetime(2020, 1, 1) + timedelta(days=n)


def bag(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def states(spark, *rows):
    return spark.createDataFrame([(k, v, at(n)) for k, v, n in rows], "k int, v string, u timestamp_ntz")


@pytest.fixture
def history(spark):
    return HistoryTarget(spark, f"h_{uuid.uuid4().hex}", "k")


def test_two_states_under_one_time_keep_all_closed_versions(spark, history):
    when = datetime(2024, 1, 1)
    for n in (1, 2, 3):
        found = history.observe(states(spark, (1, f"v{n}", n)), "u", when)
    assert bag(found) == Counter([(1, "v1", at(1), at(1), at(2)), (1, "v2", at(2), at(2), at(3)), (1, "v3", at(3), at(3), None)])


def test_a_run_with_an_older_time_is_refused_and_nothing_is_written(spark, history):
    for n in (1, 3):
        history.observe(states(spark, (1, f"v{n}", n), (2, "same", 0)), "u", datetime(2024, 1, n))
    before, files = bag(history.read()), set(spark.table(history.closed).inputFiles())
    with pytest.raises(StaleRunError):
        history.observe(states(spark, (1, "v2", 2)), "u", datetime(2024, 1, 2))
    assert bag(history.read()) == before and set(spark.table(history.closed).inputFiles()) == files
    assert history.last_run() == (2, datetime(2024, 1, 3))


@pytest.mark.parametrize("step", ["replace", "_close"])
def test_a_failed_run_leaves_nothing_behind(spark, history, monkeypatch, step):
    """It fails after the open versions, or the closed ones, were written; the next run sees another state."""
    history.observe(states(spark, (1, "a", 1), (2, "b", 1)), "u", datetime(2024, 1, 1))
    history.observe(states(spark, (1, "a2", 2), (2, "b", 1)), "u", datetime(2024, 1, 2))
    before = bag(history.read())
    owner = TableTarget if step == "replace" else HistoryTarget
    kept = getattr(owner, step)

    def failing(*args):
        kept(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(RuntimeError, match="lost"):
        history.observe(states(spark, (1, "wrong", 9)), "u", datetime(2024, 1, 3))
    monkeypatch.undo()
    assert bag(history.read()) == before
    history.drop_old_versions()
    assert bag(history.read()) == before
    after = history.observe(states(spark, (1, "a2", 2), (2, "b", 1)), "u", datetime(2024, 1, 3))
    assert bag(after) == before


def test_a_column_that_appears_later_is_null_before(spark, history):
    history.observe(states(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1)), "u", datetime(2024, 1, 1))
    history.observe(states(spark, (1, "a2", 2), (2, "b", 1), (3, "c", 1)), "u", datetime(2024, 1, 2))
    wider = states(spark, (1, "a3", 3), (2, "b", 1)).withColumn("n", F.lit(7))
    found = history.observe(wider, "u", datetime(2024, 1, 3)).select("k", "v", "n", "valid_from", "valid_to")
    wanted = Counter([(1, "a", None, at(1), at(2)), (1, "a2", None, at(2), at(3)), (1, "a3", 7, at(3), None),
                      (2, "b", None, at(1), None), (3, "c", None, at(1), datetime(2024, 1, 3))])
    assert bag(found) == wanted
    pure = op.snapshot_scd2(None, states(spark, (1, "a", 1)), "k", "u", at(9))
    pure = op.snapshot_scd2(pure, states(spark, (1, "a2", 2)), "k", "u", at(9))
    pure = op.snapshot_scd2(pure, wider.where("k = 1"), "k", "u", at(9)).select("k", "v", "n", "valid_from", "valid_to")
    assert bag(pure) == Counter({row: n for row, n in wanted.items() if row[0] == 1})


def rows_of(n: int) -> list[tuple]:
    return [(f"k{i}", "old", date(2020, 1 + i % 4, 1 + i % 28), "SAGE" if i % 2 else "NETSUITE", at(i)) for i in range(n)]


@pytest.fixture
def by_month(spark):
    table = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)
    table.load(spark.createDataFrame(rows_of(40), SCHEMA), "latest")
    return table


def test_touched_months_are_found_without_moving_the_targets_keys(spark, by_month):
    batch = spark.createDataFrame([("k1", "new", date(2021, 5, 5), "SAGE", at(99))], SCHEMA)
    with targets.Staging(spark, by_month.name) as staging:
        pairs = staging.stage(by_month._pairs(batch, targets._PartitionedState.of(by_month)), 4, "k")
        options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
        before = {name: spark.conf.get(name) for name in options}
        for name, value in options.items():
            spark.conf.set(name, value)
        try:
            months = by_month.touched_months(pairs)
            plan = months._jdf.queryExecution().executedPlan().toString()
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)
        assert plan.count("Exchange") == 1 and "hashpartitioning(_month" in plan and "SortMergeJoin" in plan
        assert {r[0] for r in months.collect()} == {"2020-02", "2021-05"}


def test_watermarks_follow_the_months_without_a_scan(spark, by_month, monkeypatch):
    def refuse(*args, **more):
        raise AssertionError("the target is scanned")

    monkeypatch.setattr(targets, "high_watermarks", refuse)
    monkeypatch.setattr(targets, "high_watermark", refuse)
    assert by_month.watermarks(["netsuite", "SAGE", "OTHER"]) == {"NETSUITE": at(38), "SAGE": at(39), "OTHER": datetime(1900, 1, 1)}
    # The newest row of one system becomes older: only its month tells.
    by_month.merge(spark.createDataFrame([("k39", "new", date(2020, 4, 12), "SAGE", at(5)), ("k0", "n", date(2022, 1, 1), "NETSUITE", at(77))], SCHEMA), "latest")
    found = PartitionedTarget(spark, by_month.name, "k", "d")
    assert found.watermarks(["NETSUITE", "SAGE"]) == {"NETSUITE": at(77), "SAGE": at(37)} and found.newest() == at(77)


def test_keep_all_updates_every_row_in_whatever_month(spark):
    table = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)
    rows = [("a", "1", date(2020, 1, 1), "SAGE", at(0)), ("a", "2", date(2020, 3, 1), "SAGE", at(0)), ("a", "2", date(2020, 3, 1), "SAGE", at(0)),
            ("b", "3", date(2020, 2, 1), "SAGE", at(0)), ("c", "4", None, "SAGE", at(0)), ("untouched", "5", date(2019, 1, 1), "SAGE", at(0))]
    table.load(spark.createDataFrame(rows, SCHEMA), "keep_all")
    before = set(table.read().inputFiles())
    batch = [("a", "new", date(2020, 5, 1), "SAGE", at(1)), ("x", "6", date(2020, 5, 2), "SAGE", at(1)), ("x", "7", date(2020, 5, 2), "SAGE", at(1))]
    wanted = op.upsert(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(batch, SCHEMA), "k", "keep_all")
    assert bag(table.merge(spark.createDataFrame(batch, SCHEMA), "keep_all")) == bag(wanted)
    kept = before & set(table.read().inputFiles())
    assert kept == {f for f in before if any(m in f for m in ("_month=2020-02", "_month=none", "_month=2019-01"))}
    with pytest.raises(op.DuplicateKeyError):
        table.merge(spark.createDataFrame(batch, SCHEMA).where("k = 'a'").union(spark.createDataFrame(batch, SCHEMA).where("k = 'a'")), "keep_all")


def test_a_failed_merge_by_month_is_not_seen_and_goes(spark, by_month, monkeypatch):
    before = bag(by_month.read())
    kept = targets._PartitionedState.publish

    def failing(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(targets._PartitionedState, "publish", failing)
    lost = spark.createDataFrame([("k1", "wrong", date(2020, 2, 2), "SAGE", at(99)), ("ghost", "wrong", date(2023, 1, 1), "SAGE", at(99))], SCHEMA)
    with pytest.raises(RuntimeError, match="lost"):
        by_month.merge(lost, "latest")
    monkeypatch.setattr(targets._PartitionedState, "publish", kept)
    assert bag(by_month.read()) == before
    batch = [("ghost", "right", date(2020, 2, 3), "SAGE", at(50)), ("k2", "new", date(2020, 3, 3), "NETSUITE", at(50))]
    wanted = op.upsert(spark.createDataFrame(rows_of(40), SCHEMA), spark.createDataFrame(batch, SCHEMA), "k", "latest")
    assert bag(by_month.merge(spark.createDataFrame(batch, SCHEMA), "keep_all")) == bag(wanted)
    assert by_month.drop_old_versions() != []
    by_month.compact()
    by_month.drop_old_versions()
    assert bag(by_month.read()) == bag(wanted)
    assert by_month.places().count() == 41
    again = [("k2", "newer", date(2020, 3, 3), "NETSUITE", at(60))]
    wanted = op.upsert(wanted, spark.createDataFrame(again, SCHEMA), "k", "latest")
    assert bag(by_month.merge(spark.createDataFrame(again, SCHEMA), "latest")) == bag(wanted)


def test_a_reload_forgets_what_was_there(spark, by_month):
    by_month.load(spark.createDataFrame(rows_of(3), SCHEMA), "error")
    assert bag(by_month.read()) == Counter(rows_of(3)) and by_month.places().count() == 3
    assert by_month.newest() == at(2)


def test_a_load_with_repeats_is_refused_and_not_seen(spark, by_month):
    repeated = spark.createDataFrame(rows_of(3) * 2, SCHEMA)
    for table in (by_month, PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)):
        there = table.exists()
        with pytest.raises(op.DuplicateKeyError):
            table.load(repeated, "error")
        assert table.exists() == there
        assert bag(table.load(repeated, "latest")) == Counter(rows_of(3)) and table.removed_rows == 3
        assert table.places().count() == 3


def test_rows_with_one_match_are_not_moved_again(spark):
    rows = spark.createDataFrame([(1, "one"), (2, "three"), (3, "none"), (None, "no id"), (None, "no id")], "id int, v string")
    other = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,), (9,), (9,)], "o int")
    found = repeat_per_match(rows, other, F.col("id"), "o")
    assert bag(found) == Counter({(1, "one"): 1, (2, "three"): 3, (3, "none"): 1, (None, "no id"): 2})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "LeftAnti" in plan and "Inner" in plan
    assert plan.index("LeftAnti") < plan.index("RepartitionByExpression")  # a branch of its own, before that of the pieces


def test_facts_that_run_together_scan_their_source_once(spark):
    """The second run of all facts, and of the customers who are counted by them, with and without sharing."""
    folder, context = "/root/testdata/sf0.001", RunContext(datetime(2024, 1, 1), "one run", date(1998, 6, 30))
    scans: Counter = Counter()

    def counted(catalog: SourceCatalog) -> SourceCatalog:
        resolve = catalog.resolve

        class Counting(SourceCatalog):
            def resolve(self, source, table):
                scans[source, table] += 1
                return resolve(source, table)

            def sharing(self, batches):
                shared = Counting(self.spark, self.settings, self._given)
                shared._batches = dict(batches)
                return shared

        return Counting(spark, catalog.settings, catalog._given)

    results = {}
    for shared in ((), ("fact_transaction",)):
        options = Settings(reporting_schema=f"space_{uuid.uuid4().hex}")
        names = ["fact_transactions", "fact_budget", "fact_ebitda_adjs"]
        run_all(spark, ErpViews(spark, folder, until=BATCH_ONE_UNTIL).catalog(), context, "latest", tags=["fact"], settings=options, buckets=4)
        scans.clear()
        done = run_all(spark, counted(ErpViews(spark, folder).catalog()), context, "latest", tags=["fact"], settings=options, shared=shared)
        results[shared] = {name: bag(done[name]) for name in names}
        wanted = 1 if shared else 3
        assert scans == {("gold_netsuite", "fact_transaction"): wanted, ("gold_sage", "fact_transaction"): wanted}
        assert not [t for t in spark.catalog.listTables(options.reporting_schema) if "staged" in t.name]
    assert results[()] == results[("fact_transaction",)]
    assert all(sum(found.values()) > 0 for found in results[()].values()) and set(MODELS) >= set(results[()])


def test_a_load_is_written_once_and_moved_once(spark, monkeypatch):
    def refuse(*args, **more):
        raise AssertionError("the load is staged")

    monkeypatch.setattr(targets.Staging, "stage", refuse)
    rows = spark.createDataFrame(rows_of(40) + rows_of(3), SCHEMA)
    table = TableTarget(spark, f"t_{uuid.uuid4().hex}", "k", 16)
    table.load(rows, "latest")
    assert bag(table.read()) == bag(spark.createDataFrame(rows_of(40), SCHEMA)) and table.removed_rows == 3
    assert all(f.endswith(".zstd.parquet") for f in table.read().inputFiles())
    settled = op.latest_per_key(rows, "k")
    moved = lambda buckets: targets.in_buckets(settled, buckets, "k", "latest")._jdf.queryExecution().toString().count("hashpartitioning(k")
    monkeypatch.setattr(targets, "FILES_PER_BUCKET", 1)
    assert moved(16) == moved(8) == moved(None) == 1 < moved(12)


def test_a_refused_load_leaves_no_version(spark):
    table = TableTarget(spark, f"t_{uuid.uuid4().hex}", "k", 4)
    with pytest.raises(op.DuplicateKeyError):
        table.load(spark.createDataFrame(rows_of(4) + rows_of(2), SCHEMA), "error")
    assert not table.exists() and not [t for t in spark.catalog.listTables() if t.name.startswith(table.name)]


def test_buckets_grow_with_the_rows(spark):
    partitions = targets.shuffle_partitions(spark)
    assert targets.buckets_for(spark, 600_000, 8) == 8
    many = targets.buckets_for(spark, 100_000_000, 8)
    assert many % partitions == 0 and 400 <= many < 400 + partitions


@pytest.mark.parametrize("few", [0, 100])
def test_few_repeats_are_settled_without_moving_the_others(spark, monkeypatch, few):
    monkeypatch.setattr(targets, "FEW_KEYS", few)
    later = [(k, "newer", d, s, at(60)) for k, _, d, s, _ in rows_of(3)]
    nothing = [(None, "a", date(2020, 1, 1), "SAGE", at(1)), (None, "b", date(2020, 1, 1), "SAGE", at(2))]
    df = spark.createDataFrame(rows_of(20) + later + nothing, SCHEMA)
    with targets.Staging(spark, f"t_{uuid.uuid4().hex}") as staging:
        found, removed = staging.settled_in_place(df, "k", "latest", "last_modified_date")
        assert bag(found) == bag(op.latest_per_key(df, "k")) and removed == 4


@pytest.mark.parametrize("few", [0, 100])
@pytest.mark.parametrize("policy", ["latest", "keep_all"])
def test_few_and_many_matches_merge_alike(spark, monkeypatch, policy, few):
    monkeypatch.setattr(targets, "FEW_KEYS", few)
    first = spark.createDataFrame(rows_of(40), SCHEMA)
    batch = spark.createDataFrame([(f"k{i}", "new", date(2021, 1 + i % 3, 2), "SAGE", at(99)) for i in range(35, 50)], SCHEMA)
    wanted = bag(op.upsert(first, batch, "k", policy))
    by_month = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)
    whole = TableTarget(spark, f"t_{uuid.uuid4().hex}", "k")
    for table in (by_month, whole):
        table.load(first, policy)
        assert bag(table.merge(batch, policy)) == wanted


def test_rows_that_stay_in_a_touched_month_are_not_moved(spark, by_month, monkeypatch):
    written = []
    kept = PartitionedTarget._write
    monkeypatch.setattr(PartitionedTarget, "_write", lambda self, rows, state: written.append(rows) or kept(self, rows, state))
    by_month.merge(spark.createDataFrame([("k1", "new", date(2020, 2, 5), "SAGE", at(99))], SCHEMA), "latest")
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("RebalancePartitions") and "rightHint=(strategy=broadcast)" in plan


@pytest.mark.parametrize("few", [0, 100])
def test_a_load_by_month_is_not_staged_and_settles_the_months_of_repeats(spark, monkeypatch, few):
    """Wide rows go straight into their months; those of repeated keys, in whatever month, are then written once more."""
    monkeypatch.setattr(targets, "FEW_KEYS", few)
    staged, stage = [], targets.Staging.stage
    monkeypatch.setattr(targets.Staging, "stage", lambda self, df, *more: staged.append(df.columns) or stage(self, df, *more))
    # k1 (2020-02) is newer in 2020-05, k2 (2020-03) comes twice in its month, two rows without key share one with none.
    more = [("k1", "newer", date(2020, 5, 1), "SAGE", at(60)), ("k2", "newer", date(2020, 3, 9), "SAGE", at(60)),
            (None, "a", date(2020, 6, 1), "SAGE", at(1)), (None, "b", None, "SAGE", at(2))]
    df = spark.createDataFrame(rows_of(40) + more, SCHEMA)
    table = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)
    found = table.load(df, "latest")
    assert few == 0 or not [columns for columns in staged if "v" in columns]
    assert bag(found) == bag(op.latest_per_key(df, "k")) and table.removed_rows == 3
    versions = {f.split("_month=")[1].split("/")[0]: f.split("_version=")[1].split("/")[0] for f in found.inputFiles()}
    assert versions == {"2020-01": "1", "2020-04": "1", "2020-02": "2", "2020-03": "2", "2020-05": "2", "none": "2"}
    assert table.drop_old_versions() == []
    assert table.watermarks(["SAGE", "NETSUITE"]) == {"SAGE": at(60), "NETSUITE": at(38)}
    batch = spark.createDataFrame([("k1", "newest", date(2020, 7, 1), "SAGE", at(70)), ("k3", "newest", date(2020, 4, 1), "SAGE", at(70))], SCHEMA)
    wanted = bag(op.upsert(op.latest_per_key(df, "k"), batch, "k", "latest"))
    assert bag(table.merge(batch, "latest")) == wanted


def test_a_merge_by_month_counts_repeats_from_its_table_of_months(spark, by_month, monkeypatch):
    counted, without = [], targets.Staging.without_repeats
    monkeypatch.setattr(targets.Staging, "without_repeats", lambda self, rows, n, *more: counted.append(n) or without(self, rows, n, *more))
    batch = [("k1", "new", date(2020, 2, 5), "SAGE", at(99)), ("k1", "newer", date(2020, 3, 6), "SAGE", at(100))]
    by_month.merge(spark.createDataFrame(batch, SCHEMA), "latest")
    assert by_month.removed_rows == 1 and by_month.read().where("k = 'k1'").select("v").collect() == [("newer",)]
    plan = counted[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "__staged" in plan and "_n" in plan and "v#" not in plan


def test_a_write_leaves_no_shuffle_files(spark):
    stored = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in stored.getAllFiles().mkString("|").split("|") if "/shuffle_" in x}
    rows = spark.createDataFrame(rows_of(40), SCHEMA).repartition(5, "v").repartition(3, "k")
    before, setting = files(), spark.conf.get(targets._CLEANUP, None)
    with targets.Staging(spark, f"t_{uuid.uuid4().hex}") as staging:
        staging.stage(rows)
    TableTarget(spark, f"t_{uuid.uuid4().hex}", "k")._write(rows, None)
    target = PartitionedTarget(spark, f"t_{uuid.uuid4().hex}", "k", "d", 4)
    for _ in range(2):
        target._write(target._with_month(rows), targets._PartitionedState(buckets=4))
    target._append_places(target._pairs(rows, targets._PartitionedState(buckets=4)), targets._PartitionedState(buckets=4))
    assert files() <= before and spark.conf.get(targets._CLEANUP, None) == setting


@pytest.mark.parametrize("policy", ["latest", "keep_all"])
def test_a_merge_adds_to_months_that_it_does_not_match(spark, by_month, policy):
    """Months that a batch only adds to keep their files; later merges match the rows of both versions."""
    before = {f for f in by_month.read().inputFiles()}
    wanted, first = spark.createDataFrame(rows_of(40), SCHEMA), [("k1", "new", date(2020, 3, 5), "SAGE", at(90)), ("more", "new", date(2020, 4, 9), "SAGE", at(95))]
    second = [("more", "newer", date(2020, 4, 9), "SAGE", at(50)), ("k3", "newer", date(2020, 4, 1), "SAGE", at(51)), ("last", "new", None, "NETSUITE", at(52))]
    for batch, kept, newest in ((first, ("2020-01", "2020-03", "2020-04"), at(95)), (second, ("2020-01", "2020-03"), at(90))):
        rows = spark.createDataFrame(batch, SCHEMA)
        wanted = spark.createDataFrame(op.upsert(wanted, rows, "k", policy).collect(), SCHEMA)
        found = by_month.merge(rows, policy)
        assert bag(found) == bag(wanted)
        assert before & set(found.inputFiles()) == {f for f in before if any(f"_month={month}" in f for month in kept)}
        assert by_month.newest() == newest and by_month.watermarks(["SAGE"]) == {"SAGE": newest}
        by_month.drop_old_versions()
        assert bag(PartitionedTarget(spark, by_month.name, "k", "d").read()) == bag(wanted)
    by_month.compact()
    assert bag(by_month.read()) == bag(wanted) and by_month.places().count() == 42
