"""Models on hand-made rows: the behaviours that the test tables do not show by themselves."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.contracts import CONTRACTS, ContractError, require_contract
from ledgerspark.operators.conform import Feed, conform
from ledgerspark.plans import MODELS, build, select_models
from ledgerspark.settings import NETSUITE, SAGE, RunContext
from ledgerspark.sources import SourceCatalog
from ledgerspark.sources.declared import COLUMNS

CONTEXT = RunContext(datetime(2024, 1, 1), "r", date(2020, 6, 30))
TIMES = {"last_modified_date", "updated_at", "tran_date", "start_date", "due_date", "close_date"}
DATES = {"effective_from", "effective_to"}
NUMBERS = {"pandl_multiplier", "budget_multiplier"}


def source(spark, name, *rows):
    """A source table with all its columns; those not given are null."""
    def kind(column):
        if column in TIMES:
            return "timestamp_ntz"
        return "date" if column in DATES else "double" if column in NUMBERS else "string"

    columns = COLUMNS[name].split()
    schema = ", ".join(f"{c} {kind(c)}" for c in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def catalog(spark, **tables):
    names = {f"{source_name.split('_')[-1]}_{table}": (source_name, table) for source_name, table in COLUMNS}
    given = {names[alias]: source(spark, names[alias], *rows) for alias, rows in tables.items()}
    for name in COLUMNS:
        given.setdefault(name, source(spark, name))
    return SourceCatalog(spark, given=given)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_contract_of_every_model(spark):
    for name, model in MODELS.items():
        df = build(model, catalog(spark), CONTEXT)
        assert df.schema.fieldNames() == CONTRACTS[name].fieldNames()
        assert df.count() == 0
        assert df.columns[0] == model.key


def test_unique_id_is_null_while_the_key_is_not(spark):
    df = build(MODELS["fact_transactions"], catalog(spark, netsuite_fact_transaction=[{"transaction_id": "5"}]), CONTEXT)
    key, unique = rows_of(df, "financetransactionkey", "transactionuniqueid")[0]
    assert unique is None
    assert key == hashlib.md5(b"NETSUITE-5-").hexdigest()


def test_entity_name_falls_back_to_the_title(spark):
    people = [
        {"entity_id": "1", "first_name": "A", "last_name": "B", "entity_title": "T"},
        {"entity_id": "2", "first_name": "A", "entity_title": "T"},
        {"entity_id": "3", "last_name": "B"},
    ]
    df = build(MODELS["dim_entity"], catalog(spark, netsuite_dim_entity=people), CONTEXT)
    assert rows_of(df, "entity_id", "entity_name") == [("1", "A B"), ("2", "T"), ("3", None)]


def test_entity_ids_by_type(spark):
    entities = [{"entity_id": str(i), "entity_type": kind} for i, kind in
                enumerate(["EMPLOYEE", "Customer", "vendor", "partner", None])]
    df = build(MODELS["dim_entity"], catalog(spark, sage_dim_entity=entities), CONTEXT)
    assert rows_of(df, "employee_id", "customer_id", "vendor_id") == [
        ("0", None, None), (None, "1", None), (None, None, "2"), (None, None, None), (None, None, None)]


def test_inactive_flags_are_kept_as_they_are(spark):
    first = [{"employee_id": str(i), "is_inactive": flag} for i, flag in enumerate(["true", "TRUE", None])]
    second = [{"employee_id": str(i + 10), "is_inactive": flag} for i, flag in enumerate(["active", "inactive", None])]
    df = build(MODELS["dim_employee"], catalog(spark, netsuite_dim_employees=first, sage_dim_employee=second), CONTEXT)
    assert dict(rows_of(df, "employee_id", "is_inactive")) == {
        "0": False, "1": False, "2": False, "10": True, "11": False, "12": False}


def test_one_id_in_both_systems(spark):
    tables = dict(netsuite_dim_locations=[{"location_id": "1"}], sage_dim_location=[{"location_id": "1"}],
                  netsuite_dim_item=[{"item_id": "1"}], sage_dim_item=[{"item_id": "1"}])
    sources = catalog(spark, **tables)
    keys = {name: {r[0] for r in rows_of(build(MODELS[name], sources, CONTEXT), MODELS[name].key)}
            for name in ("dim_location", "dim_item", "dim_product")}
    assert {name: len(found) for name, found in keys.items()} == {"dim_location": 1, "dim_item": 2, "dim_product": 1}


def test_account_keys_and_mapping_boundaries(spark):
    def mapped(account, system, first, last, name):
        return {"account_id": account, "source_system": system, "effective_from": first, "effective_to": last,
                "gaap_mapping_l1": name}

    mapping = [
        mapped("1", "netsuite", date(2020, 1, 1), date(2020, 6, 30), "ends today"),
        mapped("1", "NetSuite", date(2020, 6, 30), date(2021, 1, 1), "starts today"),
        mapped("1", "Sage", date(2020, 7, 1), date(2021, 1, 1), "starts tomorrow"),
        mapped("2", "SAGE", None, date(2021, 1, 1), "open start"),
    ]
    sources = catalog(spark, netsuite_dim_chartofaccounts=[{"account_id": "1", "account_number": "100"}, {}],
                      sage_dim_chartofaccounts=[{"account_id": "1", "account_number": "100"}, {"account_id": "2"}],
                      mapping_map_coa_reporting=mapping)
    found = rows_of(build(MODELS["dim_chart_of_accounts"], sources, CONTEXT), "account_key", "source_system",
                    "account_id", "gaapmappingl1")
    key = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert sorted(found, key=str) == sorted([
        (key("1"), NETSUITE, "1", "ends today"), (key("1"), NETSUITE, "1", "starts today"),
        (key(""), NETSUITE, None, None), (key("100"), SAGE, "1", None), (key(""), SAGE, "2", None)], key=str)


def test_customers_repeat_per_transaction(spark):
    people = [{"entity_id": f"e{i}", "customer_id": i and str(i), "entity_type": "Customer"} for i in (None, 1, 2, 3)]
    people.append({"entity_id": "v", "customer_id": "1", "entity_type": "vendor"})
    facts = [{"entity_id": "1"}] * 3 + [{"entity_id": "2"}, {"entity_id": None}, {"entity_id": "9"}]
    sources = catalog(spark, netsuite_dim_entity=people, netsuite_fact_transaction=facts)
    exact = sorted(r[0] for r in rows_of(build(MODELS["dim_customer"], sources, CONTEXT), "customer_id"))
    assert exact == ["e1", "e1", "e1", "e2", "e3", "eNone"]
    single = sorted(r[0] for r in rows_of(build(MODELS["dim_customer"], sources, CONTEXT, repeat_rows=False), "customer_id"))
    assert single == ["e1", "e2", "e3", "eNone"]


def test_subsidiary_without_time_is_always_read(spark):
    far = datetime(2999, 1, 1)
    sources = catalog(spark, netsuite_dim_subsidiary=[{"subsidiary_id": "1"}],
                      sage_dim_subsidiary=[{"subsidiary_id": "2", "last_modified_date": datetime(2020, 1, 1)}])
    df = build(MODELS["dim_subsidiary"], sources, CONTEXT, since={NETSUITE: far, SAGE: far})
    assert rows_of(df, "subsidiary_id", "last_modified_date") == [("1", datetime(1900, 1, 1))]


def test_currency_watermark_uses_its_own_column(spark):
    mark = datetime(2020, 1, 1)
    rows = [{"currency_id": "old", "updated_at": mark}, {"currency_id": "new", "updated_at": datetime(2020, 1, 2)},
            {"currency_id": "none"}]
    df = build(MODELS["dim_currency"], catalog(spark, sage_dim_currency=rows), CONTEXT, since={NETSUITE: mark, SAGE: mark})
    assert rows_of(df, "currency_id", "is_base_currency") == [("new", None)]


def test_float_ids_are_refused(spark):
    items = source(spark, ("gold_sage", "dim_item"), {}).withColumn("item_id", F.lit(5.0).cast("double"))
    sources = SourceCatalog(spark, given={("gold_sage", "dim_item"): items,
                                          ("gold_netsuite", "dim_item"): source(spark, ("gold_netsuite", "dim_item"))})
    with pytest.raises(ContractError, match="item_id has type double"):
        build(MODELS["dim_item"], sources, CONTEXT)


def test_feed_outside_its_contract_is_refused(spark):
    feed = Feed(NETSUITE, "gold_netsuite", "dim_item", {"item_nmae": "item_name"})
    with pytest.raises(ContractError, match="item_nmae"):
        conform(source(spark, ("gold_netsuite", "dim_item")), feed, CONTRACTS["dim_item"])


def test_contract_check(spark):
    wanted = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    require_contract(spark.sql("select 'x' as a, 1d as b"), wanted)
    for wrong in ("select 'x' as a", "select 'x' as a, 1 as b", "select 1d as b, 'x' as a",
                  "select 'x' as a, 1d as b, 1 as c"):
        with pytest.raises(ContractError):
            require_contract(spark.sql(wrong), wanted)


def test_strict_casts_need_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            build(MODELS["dim_item"], catalog(spark), CONTEXT)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_models_by_tag():
    assert len(MODELS) == 15 == len(select_models("cdm"))
    assert len(select_models("dimension")) == 12
    assert [m.name for m in select_models("fact", "budget")] == ["fact_budget", "fact_ebitda_adjs"]
    assert [m.name for m in select_models("account")] == ["dim_chart_of_accounts"]
    assert select_models("none such") == []
