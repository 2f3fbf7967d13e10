"""The two left joins against brute force, with hot keys and tiny limits."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark.operators import joins


@pytest.mark.parametrize("limit", [1, 2, 7, 65_536])
def test_repeat_per_match_equals_the_left_join(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "COPIES_PER_ROW", limit)
    left = spark.createDataFrame([(i, i if i % 4 else None) for i in range(20)], "name int, ref int")
    hits = [1] * 100 + [2] * 7 + [3] * 14 + [5] * 15 + [None] * 9 + [99]
    right = spark.createDataFrame([(h,) for h in hits], "other int")
    found = op.repeat_per_match(left, right, F.col("ref"), "other")
    assert found.columns == ["name", "ref"]
    plain = left.join(right, F.col("ref") == F.col("other"), "left").select("name", "ref")
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_copies_of_a_hot_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "COPIES_PER_ROW", 100)
    left = spark.createDataFrame([(1, 1)], "name int, ref int")
    right = spark.range(50_000).select(F.lit(1).alias("other"))
    found = op.repeat_per_match(left, right, F.col("ref"), "other")
    per_partition = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_partition) == 50_000
    assert max(per_partition) < 15_000


def test_rows_without_id_are_spread(spark):
    left = spark.range(100_000).select(F.col("id").cast("int").alias("name"), F.lit(None).cast("int").alias("ref"))
    found = op.repeat_per_match(left, spark.range(10).select(F.col("id").cast("int").alias("other")), F.col("ref"), "other")
    per_partition = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_partition) == 100_000
    assert max(per_partition) < 30_000


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_effective_dated_join_equals_brute_force(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rng, day = random.Random(1), date(2020, 6, 30)
        ids = ["hot"] * 40 + [str(i) for i in range(60)] + [None] * 10
        accounts = [(rng.choice(ids), rng.choice(["NETSUITE", "Sage"]), i) for i in range(300)]
        mapping = []
        for i in range(300):
            first = day + timedelta(days=rng.randint(-4, 2))
            mapping.append((rng.choice(ids), rng.choice(["netsuite", "SAGE", None]), f"m{i}", first,
                            first + timedelta(days=rng.randint(0, 4))))
        left = spark.createDataFrame(accounts, "account_id string, source_system string, n int")
        right = spark.createDataFrame(
            mapping, "account_id string, source_system string, m string, effective_from date, effective_to date")
        found = op.effective_dated_join(left, right, day, {"m": "name"})
        assert found.columns == ["account_id", "source_system", "n", "name"]
        wanted = Counter()
        for account, system, n in accounts:
            names = [m for a, s, m, lo, hi in mapping
                     if account is not None and a == account and s is not None and s.upper() == system.upper() and lo <= day <= hi]
            wanted.update((account, system, n, name) for name in names or [None])
        assert Counter(map(tuple, found.collect())) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
