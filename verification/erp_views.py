"""ERP-shaped inputs cut from the test tables, as SQL that both engines run unchanged.

``day`` turns a number into a timestamp that many days after 1995-01-01; it is the only part the engines spell
differently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import timestamp_literal
from ledgerspark.settings import Settings
from ledgerspark.sources import SourceCatalog

BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table under its known schema, which saves opening a file to learn it."""
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spark_day(number: str) -> str:
    return f"dateadd(DAY, cast({number} as int), timestamp_ntz'1995-01-01')"


def duckdb_day(number: str) -> str:
    return f"(timestamp '1995-01-01' + to_days(cast({number} as int)))"


def view_sql(day: Callable[[str], str]) -> dict[str, str]:
    """The text of every view."""
    return {
        "ns_fact_transaction": f"""
            select l_orderkey as transaction_id,
                   l_partkey * 8 + l_linenumber as transaction_line_id,
                   l_partkey as account_id,
                   l_suppkey % 7 as class_id,
                   case when l_linenumber % 7 = 0 then null else l_partkey end as item_id,
                   l_suppkey as department_id,
                   n_regionkey as subsidiary_id,
                   c_nationkey as location_id,
                   o_custkey as entity_id,
                   year(o_orderdate) * 100 + month(o_orderdate) as posting_period_id,
                   c_nationkey as currency_id,
                   o_orderdate as tran_date, o_orderdate as start_date, l_shipdate as due_date,
                   case when l_linestatus = 'F' then l_shipdate end as close_date,
                   l_extendedprice as amount,
                   l_extendedprice * (1 - l_discount) as converted_net_amount,
                   case when l_returnflag = 'R' then null else l_extendedprice end as amount_paid,
                   l_quantity as quantity,
                   l_extendedprice * (1 - l_discount) as net_amount,
                   o_orderpriority as transaction_type,
                   l_returnflag as accounting_line_type,
                   o_orderstatus as transaction_status_id,
                   l_linestatus as transaction_accounting_posting_flag,
                   l_shipdate as last_modified_date
            from lineitem join orders on l_orderkey = o_orderkey
                 join customer on o_custkey = c_custkey
                 join nation on c_nationkey = n_nationkey
            where l_orderkey % 2 = 0
        """,
        "sg_fact_transaction": f"""
            select l_orderkey as tran_id,
                   l_partkey * 8 + l_linenumber as transaction_line_number,
                   cast(l_partkey + 10000 as string) as account_number,
                   l_partkey as account_id,
                   l_suppkey % 7 as classid,
                   case when l_linenumber % 5 = 0 then null else l_partkey end as itemid,
                   l_suppkey as department_id,
                   n_regionkey as subsidiary_id,
                   c_nationkey + 20 as location_id,
                   case when l_linenumber % 2 = 0 then o_custkey end as customer_id,
                   l_suppkey as vendor_id,
                   c_nationkey as currency_id,
                   year(o_orderdate) * 100 + month(o_orderdate) as reporting_period_id,
                   o_orderdate as tran_date, o_orderdate as start_date, l_shipdate as due_date,
                   case when l_linestatus = 'F' then l_shipdate end as close_date,
                   case when l_discount = 0 then 'NULL' else cast(l_extendedprice as string) end as amount,
                   case when l_tax = 0 then null else cast(l_extendedprice * (1 + l_tax) as string) end as trx_amount,
                   case when l_returnflag = 'R' then 'NULL' else cast(l_extendedprice as string) end as total_due,
                   cast(l_quantity as string) as quantity,
                   o_orderpriority as transaction_type,
                   l_returnflag as account_type,
                   o_orderstatus as state,
                   l_shipdate as last_modified_date
            from lineitem join orders on l_orderkey = o_orderkey
                 join customer on o_custkey = c_custkey
                 join nation on c_nationkey = n_nationkey
            where l_orderkey % 2 = 1
        """,
        "ns_dim_locations": f"""
            select n_nationkey as location_id, n_name as location_name, n_regionkey as parent,
                   {day("n_nationkey * 80")} as last_modified_date from nation
        """,
        "sg_dim_location": f"""
            select cast(n_nationkey + 20 as string) as location_id, 'B/' || n_name as location_full_name,
                   cast(n_regionkey as string) as parent, {day("n_nationkey * 80 + 1")} as last_modified_date from nation
        """,
        "ns_dim_item": f"""
            select p_partkey as item_id, p_name as item_name, p_type as item_type,
                   {day("(p_partkey * 397) % 2400")} as last_modified_date from part
        """,
        "sg_dim_item": f"""
            select p_partkey as item_id, p_name as item_name, p_type as item_type,
                   {day("(p_partkey * 397) % 2400")} as last_modified_date from part
        """,
        "ns_dim_entity": f"""
            select c_custkey as entity_id,
                   case when c_custkey % 3 = 0 then null else c_mktsegment end as first_name,
                   case when c_custkey % 5 = 0 then null else c_name end as last_name,
                   'T ' || c_name as entity_title,
                   case when c_custkey % 2 = 0 then 'CUSTOMER' else 'Customer' end as entity_type,
                   cast(null as bigint) as employee_id, c_custkey as customer_id, cast(null as bigint) as vendor_id,
                   {day("(c_custkey * 397) % 2400")} as last_modified_date from customer
            union all
            select -s_suppkey, null, null, s_name,
                   case when s_suppkey % 2 = 0 then 'vendor' else 'Vendor' end,
                   cast(null as bigint), cast(null as bigint), s_suppkey,
                   {day("(s_suppkey * 397) % 2400")} from supplier
        """,
        "sg_dim_entity": f"""
            select cast(c_custkey as string) as entity_id, c_name as entity_name,
                   case when c_custkey % 10 = 0 then 'Employee' else 'customer' end as entity_type,
                   {day("(c_custkey * 397) % 2400")} as last_modified_date from customer
            union all
            select cast(s_suppkey as string), s_name, 'VENDOR', {day("(s_suppkey * 397) % 2400")} from supplier
        """,
        "ns_dim_departments": f"""
            select s_suppkey as department_id, s_name as department_name, 'Root : ' || s_name as department_full_name,
                   case when s_suppkey % 10 = 0 then null else s_suppkey % 10 end as parent,
                   {day("(s_suppkey * 397) % 2400")} as last_modified_date from supplier where s_suppkey % 2 = 0
        """,
        "sg_dim_department": f"""
            select cast(s_suppkey as string) as department_id, s_name as department_name,
                   case when s_suppkey % 10 = 0 then null else cast(s_suppkey % 10 as string) end as parent,
                   {day("(s_suppkey * 397) % 2400")} as last_modified_date from supplier where s_suppkey % 2 = 1
        """,
        "ns_dim_currency": f"""
            select n_nationkey as currency_id, n_name as currency_name, substr(n_name, 1, 3) as currency_symbol,
                   n_nationkey = 0 as is_base_currency, {day("n_nationkey * 80")} as last_modified_date from nation
        """,
        "sg_dim_currency": f"""
            select cast(n_nationkey + 20 as string) as currency_id, n_name as currency_name,
                   substr(n_name, 1, 2) as symbol, {day("n_nationkey * 80")} as updated_at from nation
        """,
        "ns_dim_classification": f"""
            select distinct s_suppkey % 7 as class_id, 'class ' || cast(s_suppkey % 7 as string) as class_name,
                   {day("(s_suppkey % 7) * 300")} as last_modified_date from supplier
        """,
        "sg_dim_classification": f"""
            select distinct s_suppkey % 7 + 5 as class_id, 'b class ' || cast(s_suppkey % 7 as string) as class_name,
                   {day("(s_suppkey % 7) * 300 + 1")} as last_modified_date from supplier
        """,
        "ns_dim_chartofaccounts": f"""
            select p_partkey as account_id, cast(p_partkey + 10000 as string) as account_number, p_name as account_name,
                   p_type as account_type, p_brand as account_description, p_name as display_name,
                   case when p_partkey % 9 = 0 then null else p_partkey % 9 end as account_parent_id,
                   p_type || ' : ' || p_name as display_name_with_hierarchy,
                   p_partkey % 100 as department_id, p_partkey % 7 as class_id, p_partkey % 5 as subsidiary_id,
                   {day("(p_partkey * 397) % 2400")} as last_modified_date from part where p_partkey % 2 = 0
        """,
        "sg_dim_chartofaccounts": f"""
            select p_partkey as account_id, cast(p_partkey + 10000 as string) as account_number, p_name as account_name,
                   p_type as account_type, p_brand as category,
                   case when p_partkey % 9 = 0 then null else cast(p_partkey % 9 as string) end as alternative_account,
                   {day("(p_partkey * 397) % 2400")} as last_modified_date from part where p_partkey % 2 = 1
        """,
        "ns_dim_employees": f"""
            select s_suppkey as employee_id, 'role ' || cast(s_suppkey % 4 as string) as job_description,
                   '  ' || upper(s_name) || '@Example.COM ' as email,
                   s_suppkey as department_id, s_suppkey % 7 as class_id, s_nationkey as location_id,
                   s_nationkey % 5 as subsidiary, case when s_acctbal < 0 then 'true' else 'false' end as is_inactive,
                   {day("(s_suppkey * 397) % 2400")} as last_modified_date from supplier where s_suppkey % 2 = 0
        """,
        "sg_dim_employee": f"""
            select cast(s_suppkey as string) as employee_id, s_name as employee_name,
                   s_name || '@example.com' as email,
                   s_suppkey as department_id, s_suppkey % 7 as class_id, s_nationkey as location_id,
                   s_nationkey % 5 as subsidiary,
                   case when s_suppkey % 3 = 0 then null when s_acctbal < 0 then 'inactive' else 'active' end as is_inactive,
                   {day("(s_suppkey * 397) % 2400")} as last_modified_date from supplier where s_suppkey % 2 = 1
        """,
        "sg_dim_customer": f"""
            select cast(c_custkey as string) as customer_id, c_name as customer_name, c_mktsegment as customer_type,
                   {day("(c_custkey * 397) % 2400")} as last_modified_date from customer
        """,
        "ns_dim_subsidiary": f"""
            select r_regionkey as subsidiary_id, r_name as subsidiary_name from region
        """,
        "sg_dim_subsidiary": f"""
            select r_regionkey + 3 as subsidiary_id, 'B/' || r_name as subsidiary_title,
                   {day("r_regionkey * 400")} as last_modified_date from region
        """,
        "map_coa_reporting": f"""
            select cast(p_partkey as string) as account_id,
                   case when p_partkey % 2 = 0 then 'netsuite' else 'Sage' end as source_system,
                   p_type as gaap_mapping_l1, p_brand as gaap_mapping_l2, p_name as gaap_mapping_l3,
                   cast(null as string) as gaap_mapping_l4,
                   p_type as cashflow_l1, p_brand as cashflow_l2, cast(null as string) as cashflow_l3,
                   case when p_size % 2 = 0 then 1.0e0 else -1.0e0 end as pandl_multiplier,
                   1.0e0 as budget_multiplier, p_brand as debt_mapping,
                   cast({day("p_partkey % 1000")} as date) as effective_from,
                   cast({day("p_partkey % 1000 + 900")} as date) as effective_to
            from part
            union all
            select cast(p_partkey as string), case when p_partkey % 2 = 0 then 'NETSUITE' else 'SAGE' end,
                   'next', p_brand, p_name, cast(null as string), 'next', p_brand, cast(null as string),
                   1.0e0, 1.0e0, p_brand,
                   cast({day("p_partkey % 1000 + 900")} as date), cast({day("p_partkey % 1000 + 2400")} as date)
            from part where p_partkey % 2 = 0
        """,
    }


def source_of(view: str) -> tuple[str, str]:
    """The source and table a view stands for."""
    if view == "map_coa_reporting":
        return "coa_mapping", view
    system, _, table = view.partition("_")
    return {"ns": "gold_netsuite", "sg": "gold_sage"}[system], table


def modified_column(view: str) -> str | None:
    """The modification time of a view, if it has one."""
    return {"sg_dim_currency": "updated_at", "ns_dim_subsidiary": None, "map_coa_reporting": None}.get(
        view, "last_modified_date"
    )


class ErpViews:
    """The views over one folder of test tables; ``until`` keeps only rows modified up to that time."""

    def __init__(self, spark: SparkSession, sf_dir: str, until=None):
        self.spark = spark
        self.until = until
        self._sql = view_sql(spark_day)
        # The default; the models refuse sessions that turn bad values into nulls.
        spark.conf.set("spark.sql.ansi.enabled", "true")
        self._folder = sf_dir

    def names(self) -> list[str]:
        return list(self._sql)

    def view(self, name: str) -> DataFrame:
        text = re.sub(r"\b(from|join) (\w+)", r"\1 {\2}", self._sql[name])
        tables = {table: read_table(self.spark, self._folder, table) for table in re.findall(r"{(\w+)}", text)}
        df = self.spark.sql(text, **tables)
        column = modified_column(name)
        if self.until is not None and column:
            df = df.where(F.col(column) <= timestamp_literal(self.until))
        return df

    def catalog(self, settings: Settings = Settings()) -> SourceCatalog:
        """The views under the names the models resolve."""
        return SourceCatalog(self.spark, settings, given={
            source_of(name): (lambda name=name: self.view(name)) for name in self._sql
        })
