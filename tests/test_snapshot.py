"""History snapshots against a plain Python history over random sequences of states."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest

from ledgerspark.contracts import ContractError
from ledgerspark.operators import snapshot_scd2

DAY = datetime(2020, 1, 1)
SCHEMA = "k int, v string, u timestamp_ntz"

state = st.dictionaries(st.integers(0, 4), st.tuples(st.sampled_from("xyz"), st.integers(0, 6)), max_size=5)


def at(n):
    return DAY + timedelta(days=n)


def next_history(history, current, run_ts, close_deleted):
    result, seen_open = [], set()
    for k, v, u, start, end in history:
        if end is not None:
            result.append((k, v, u, start, end))
            continue
        seen_open.add(k)
        if k not in current:
            result.append((k, v, u, start, run_ts if close_deleted else None))
        elif at(current[k][1]) > start:
            new = at(current[k][1])
            result += [(k, v, u, start, new), (k, current[k][0], new, new, None)]
        else:
            result.append((k, v, u, start, None))
    result += [(k, v, at(n), at(n), None) for k, (v, n) in current.items() if k not in seen_open]
    return result


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(states=st.lists(state, min_size=1, max_size=3), close_deleted=st.booleans())
def test_history_equals_the_plain_one(spark, states, close_deleted):
    history, wanted = None, []
    for n, current in enumerate(states):
        run_ts = datetime(2024, 1, 1) + timedelta(days=n)
        rows = spark.createDataFrame([(k, v, at(u)) for k, (v, u) in current.items()], SCHEMA)
        history = snapshot_scd2(history, rows, "k", "u", run_ts, close_deleted)
        wanted = next_history(wanted, current, run_ts, close_deleted)
        assert Counter(map(tuple, history.collect())) == Counter(wanted)


def test_columns_must_agree(spark):
    history = snapshot_scd2(None, spark.createDataFrame([], SCHEMA), "k", "u", DAY)
    with pytest.raises(ContractError):
        snapshot_scd2(history, spark.createDataFrame([], "k int, u timestamp_ntz"), "k", "u", DAY)


def test_one_join_per_snapshot(spark, capsys):
    rows = spark.createDataFrame([(1, "x", DAY)], SCHEMA)
    snapshot_scd2(snapshot_scd2(None, rows, "k", "u", DAY), rows, "k", "u", DAY).explain()
    assert capsys.readouterr().out.count("Join") == 1
