"""Resolving inputs and naming outputs."""

from __future__ import annotations

import pytest

from ledgerspark.contracts import ContractError
from ledgerspark.settings import Settings
from ledgerspark.sources import SourceCatalog, shared_folder, table_name, target_namespace
from ledgerspark.sources.declared import COLUMNS, TABLES


def test_names_come_from_settings():
    assert table_name("gold_sage", "dim_item") == "gold_sage.dim_item"
    other = Settings(source_database="db", netsuite_silver_schema="clean")
    assert table_name("silver_netsuite", "accounts", other) == "db.clean.accounts"
    assert table_name("coa_mapping", "map_coa_reporting") == "account_mapping.map_coa_reporting"
    with pytest.raises(KeyError):
        table_name("gold_sage", "dim_locations")


def test_every_table_with_known_columns_is_declared():
    assert all(table in TABLES[source] for source, table in COLUMNS)
    assert len(COLUMNS) == 22


def test_namespace():
    assert target_namespace(None, "default") == "default"
    assert target_namespace("  finance ", "default") == "finance"


def test_given_tables(spark, tmp_path):
    df = spark.sql("select 1 as ITEM_ID, 'n' as item_name, 't' as item_type, timestamp_ntz'2020-01-01' as Last_Modified_Date")
    path = str(tmp_path / "items")
    df.write.parquet(path)
    key = ("gold_sage", "dim_item")
    for given in (df, lambda: df, path):
        assert SourceCatalog(spark, given={key: given}).resolve(*key).count() == 1
    with pytest.raises(ContractError, match="gold_sage.dim_item lacks the columns \\['item_name'\\]"):
        SourceCatalog(spark, given={key: df.drop("item_name")}).resolve(*key)


def test_catalog_tables(spark):
    spark.sql("create schema if not exists mapping_here")
    spark.sql("create or replace view mapping_here.map_coa_reporting as select 1 as x")
    sources = SourceCatalog(spark, Settings(source_database="spark_catalog", mapping_schema="mapping_here"))
    with pytest.raises(ContractError, match="coa_mapping.map_coa_reporting lacks"):
        sources.resolve("coa_mapping", "map_coa_reporting")


def test_shared_folder_is_the_cluster_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
