"""SQL oracles. Each text stands alone: it builds its inputs from the test tables and the result from those."""

from __future__ import annotations

import re

from verification.erp_views import duckdb_day, view_sql

CUT = "timestamp '1998-12-31 00:00:00'"
RUN_TS = "timestamp '2024-01-01 00:00:00'"
AS_OF = "date '1998-06-30'"
AUDIT = f"{RUN_TS} as _created_at, {RUN_TS} as _updated_at, 'test-run' as _dbt_run_id"
VIEWS = view_sql(duckdb_day)

# The columns of every output in order, audit columns last.
COLUMNS = {
    "dim_location": """
        location_key source_system location_id location_name parent_location_key last_modified_date
        _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_item": """
        item_key source_system item_id item_name item_type last_modified_date _created_at _updated_at
        _dbt_run_id
    """.split(),
    "dim_entity": """
        entity_key source_system entity_id entity_name entity_type employee_id customer_id vendor_id
        last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_department": """
        department_key source_system department_id department_name full_hierarchy_name parent_department_id
        parent_department_key last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_vendor": """
        vendor_key source_system vendor_id vendor_name last_modified_date _created_at _updated_at
        _dbt_run_id
    """.split(),
    "dim_currency": """
        currency_key source_system currency_id currency_name currency_symbol is_base_currency
        last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_class": """
        class_key source_system class_id class_name last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_product": """
        product_key source_system product_id product_name product_type product_category product_subcategory
        last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_chart_of_accounts": """
        account_key source_system account_id account_number account_name account_type description
        display_name parent_account_id full_hierarchy_name department_id class_id subsidiary_id product_id
        gaapmappingl1 gaapmappingl2 gaapmappingl3 gaapmappingl4 cashflowl1 cashflowl2 cashflowl3
        pandlmultiplier budgetmultiplier debtmapping last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_employee": """
        employee_key source_system employee_id title email department_key class_key location_key
        subsidiary_key is_inactive last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_customer": """
        customer_key source_system customer_id customer_name customer_type payment_plan last_modified_date
        _created_at _updated_at _dbt_run_id
    """.split(),
    "dim_subsidiary": """
        subsidiary_key source_system subsidiary_id subsidiary_name last_modified_date _created_at
        _updated_at _dbt_run_id
    """.split(),
    "fact_transactions": """
        financetransactionkey source_system transactionuniqueid transactionid transactionlineid
        chartofaccountkey classkey itemkey productkey departmentkey subsidiarykey locationkey entitykey
        customerkey vendorkey accountingperiodkey currency transactiondate postingperioddate duedate
        closedate amount convertedamount openamount quantity transactiontype debitcreditflag
        transactionstatus postingflag last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "fact_budget": """
        budget_transaction_key source_system budget_id subsidiary_key chart_of_account_key class_key
        department_key location_key accounting_period_key currency customerkey itemkey productkey amount
        convertedamount type last_modified_date _created_at _updated_at _dbt_run_id
    """.split(),
    "fact_ebitda_adjs": """
        ebitda_adjustment_key source_system adjustment_id subsidiary_key chart_of_account_key class_key
        department_key location_key accounting_period_key currency customerkey itemkey productkey
        adjustment_type adjustment_description amount converted_amount last_modified_date _created_at
        _updated_at _dbt_run_id
    """.split(),
}


def key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({part}, '')" for part in parts) + ")"


def rows(view: str, system: str, columns: str, where: str = "true",
         modified: str = "last_modified_date") -> str:
    """One system's conformed rows."""
    return f"select {columns}, '{system}' as source_system, {modified} as last_modified_date from {view} where {where}"


def ids(**names: str) -> str:
    return ", ".join(f"cast({old} as varchar) as {new}" for new, old in names.items())


def cols(**names: str) -> str:
    return ", ".join(f"{old} as {new}" for new, old in names.items())


def nulls(kind: str, *names: str) -> str:
    return ", ".join(f"cast(null as {kind}) as {name}" for name in names)


def number(name: str) -> str:
    return f"case when {name} is null or {name} = 'NULL' then 0.0::double else {name}::double end"


def route(kind: str) -> str:
    return f"case lower(entity_type) when '{kind}' then cast(entity_id as varchar) end"


_ITEM = ids(item_id="item_id") + ", item_name, item_type"
_PRODUCT = ", ".join([ids(product_id="item_id"), cols(product_name="item_name", product_type="item_type"),
                      nulls("varchar", "product_category", "product_subcategory")])
_CLASS = ids(class_id="class_id") + ", class_name"
_DATES = ", ".join(f"{old}::date as {new}" for new, old in
                   dict(transactiondate="tran_date", postingperioddate="start_date", duedate="due_date",
                        closedate="close_date").items())
_PLAN_A = ids(subsidiary_key="subsidiary_id", chart_of_account_key="account_id", class_key="class_id",
              department_key="department_id", location_key="location_id", accounting_period_key="posting_period_id",
              currency="currency_id", customerkey="entity_id", itemkey="item_id", productkey="item_id")
_PLAN_B = ids(subsidiary_key="subsidiary_id", chart_of_account_key="account_id", class_key="classid",
              department_key="department_id", location_key="location_id",
              accounting_period_key="reporting_period_id", currency="currency_id", customerkey="customer_id",
              itemkey="itemid", productkey="itemid")
_PLAN_KEY = key("source_system", "chart_of_account_key", "subsidiary_key", "accounting_period_key")
_BUDGET = nulls("double", "amount", "convertedamount") + ", " + nulls("varchar", "type")
_EBITDA = nulls("varchar", "adjustment_type", "adjustment_description") + ", " + nulls(
    "double", "amount", "converted_amount")
_MAPPED = cols(gaapmappingl1="gaap_mapping_l1", gaapmappingl2="gaap_mapping_l2", gaapmappingl3="gaap_mapping_l3",
               gaapmappingl4="gaap_mapping_l4", cashflowl1="cashflow_l1", cashflowl2="cashflow_l2",
               cashflowl3="cashflow_l3", pandlmultiplier="pandl_multiplier", budgetmultiplier="budget_multiplier",
               debtmapping="debt_mapping")

# Their keys repeat within a batch, so a merge that keeps repeated keys must refuse them.
PLANNING_FACTS = {"fact_budget", "fact_ebitda_adjs"}

# model -> (columns made after the union, rows of the first system, rows of the second)
SHAPES: dict[str, tuple[str, str, str]] = {
    "dim_location": (
        f"{key('location_id')} as location_key",
        rows("ns_dim_locations", "NETSUITE", "location_name, " + ids(location_id="location_id", parent_location_key="parent")),
        rows("sg_dim_location", "SAGE", cols(location_name="location_full_name") + ", " + ids(location_id="location_id", parent_location_key="parent")),
    ),
    "dim_item": (
        f"{key('source_system', 'item_id')} as item_key",
        rows("ns_dim_item", "NETSUITE", _ITEM),
        rows("sg_dim_item", "SAGE", _ITEM),
    ),
    "dim_entity": (
        f"{key('entity_id')} as entity_key",
        rows("ns_dim_entity", "NETSUITE", ids(entity_id="entity_id", employee_id="employee_id", customer_id="customer_id", vendor_id="vendor_id")
             + ", entity_type, case when first_name is null or last_name is null then entity_title else first_name || ' ' || last_name end as entity_name"),
        rows("sg_dim_entity", "SAGE", ids(entity_id="entity_id") + ", "
             + cols(employee_id=route("employee"), customer_id=route("customer"), vendor_id=route("vendor")) + ", entity_type, entity_name"),
    ),
    "dim_department": (
        f"{key('department_id')} as department_key, {key('source_system', 'parent_department_id')} as parent_department_key",
        rows("ns_dim_departments", "NETSUITE", ids(department_id="department_id", parent_department_id="parent")
             + ", department_name, department_full_name as full_hierarchy_name"),
        rows("sg_dim_department", "SAGE", ids(department_id="department_id", parent_department_id="parent")
             + ", department_name, department_name as full_hierarchy_name"),
    ),
    "dim_vendor": (
        f"{key('vendor_id')} as vendor_key",
        rows("ns_dim_entity", "NETSUITE", ids(vendor_id="vendor_id") + ", entity_title as vendor_name", "entity_type ilike 'vendor'"),
        rows("sg_dim_entity", "SAGE", ids(vendor_id="entity_id") + ", entity_name as vendor_name", "entity_type ilike 'vendor'"),
    ),
    "dim_currency": (
        f"{key('currency_id')} as currency_key",
        rows("ns_dim_currency", "NETSUITE", ids(currency_id="currency_id") + ", currency_name, currency_symbol, is_base_currency"),
        rows("sg_dim_currency", "SAGE", ids(currency_id="currency_id") + ", currency_name, symbol as currency_symbol, cast(null as boolean) as is_base_currency",
             modified="updated_at"),
    ),
    "dim_class": (
        f"{key('class_id')} as class_key",
        rows("ns_dim_classification", "NETSUITE", _CLASS),
        rows("sg_dim_classification", "SAGE", _CLASS),
    ),
    "dim_product": (
        f"{key('product_id')} as product_key",
        rows("ns_dim_item", "NETSUITE", _PRODUCT),
        rows("sg_dim_item", "SAGE", _PRODUCT),
    ),
    "dim_chart_of_accounts": (
        f"case source_system when 'SAGE' then {key('account_number')} else {key('account_id')} end as account_key",
        rows("ns_dim_chartofaccounts", "NETSUITE", ids(account_id="account_id", parent_account_id="account_parent_id", department_id="department_id",
             class_id="class_id", subsidiary_id="subsidiary_id") + ", account_number, account_name, account_type, account_description as description,"
             " display_name, display_name_with_hierarchy as full_hierarchy_name, " + nulls("varchar", "product_id")),
        rows("sg_dim_chartofaccounts", "SAGE", ids(account_id="account_id", parent_account_id="alternative_account") + ", account_number, account_name,"
             " account_type, category as description, account_name as display_name, account_name as full_hierarchy_name, "
             + nulls("varchar", "department_id", "class_id", "subsidiary_id", "product_id")),
    ),
    "dim_employee": (
        f"{key('employee_id')} as employee_key",
        rows("ns_dim_employees", "NETSUITE", ids(employee_id="employee_id", department_key="department_id", class_key="class_id", location_key="location_id",
             subsidiary_key="subsidiary") + ", job_description as title, email, coalesce(upper(is_inactive) = 'true', false) as is_inactive"),
        rows("sg_dim_employee", "SAGE", ids(employee_id="employee_id", department_key="department_id", class_key="class_id", location_key="location_id",
             subsidiary_key="subsidiary") + ", employee_name as title, email, coalesce(upper(is_inactive) = 'ACTIVE', false) as is_inactive"),
    ),
    "dim_customer": (
        f"{key('source_system', 'customer_id')} as customer_key",
        "select cast(e.entity_id as varchar) as customer_id, e.entity_title as customer_name, e.entity_type as customer_type,"
        " cast(null as varchar) as payment_plan, 'NETSUITE' as source_system, e.last_modified_date"
        " from ns_dim_entity e left join ns_fact_transaction t on t.entity_id::varchar = e.customer_id::varchar where e.entity_type ilike 'customer'",
        rows("sg_dim_customer", "SAGE", ids(customer_id="customer_id") + ", customer_name, customer_type, " + nulls("varchar", "payment_plan")),
    ),
    "dim_subsidiary": (
        f"{key('subsidiary_id')} as subsidiary_key",
        rows("ns_dim_subsidiary", "NETSUITE", ids(subsidiary_id="subsidiary_id") + ", subsidiary_name", modified="timestamp '1900-01-01'"),
        rows("sg_dim_subsidiary", "SAGE", ids(subsidiary_id="subsidiary_id") + ", subsidiary_title as subsidiary_name"),
    ),
    "fact_transactions": (
        f"""{key('source_system', 'transactionid', 'transactionlineid')} as financetransactionkey,
            transactionid || '-' || transactionlineid as transactionuniqueid""",
        rows("ns_fact_transaction", "NETSUITE", ids(transactionid="transaction_id", transactionlineid="transaction_line_id", chartofaccountkey="account_id",
             classkey="class_id", itemkey="item_id", productkey="item_id", departmentkey="department_id", subsidiarykey="subsidiary_id",
             locationkey="location_id", entitykey="entity_id", customerkey="entity_id", vendorkey="entity_id", accountingperiodkey="posting_period_id",
             currency="currency_id") + f", {_DATES}, amount, converted_net_amount as convertedamount, amount_paid as openamount, quantity, "
             + cols(transactiontype="transaction_type", debitcreditflag="accounting_line_type", transactionstatus="transaction_status_id",
                    postingflag="transaction_accounting_posting_flag")),
        rows("sg_fact_transaction", "SAGE", ids(transactionid="tran_id", transactionlineid="transaction_line_number", chartofaccountkey="account_number",
             classkey="classid", itemkey="itemid", productkey="itemid", departmentkey="department_id", subsidiarykey="subsidiary_id",
             locationkey="location_id", entitykey="coalesce(customer_id, vendor_id)", customerkey="customer_id", vendorkey="vendor_id",
             accountingperiodkey="tran_id", currency="currency_id") + f", {_DATES}, "
             + cols(amount=number("amount"), convertedamount=number("trx_amount"), openamount=number("total_due"), quantity=number("quantity"),
                    transactiontype="transaction_type", debitcreditflag="account_type", transactionstatus="state", postingflag="state")),
    ),
    "fact_budget": (
        f"{_PLAN_KEY} as budget_transaction_key, {_PLAN_KEY} as budget_id",
        rows("ns_fact_transaction", "NETSUITE", f"{_PLAN_A}, {_BUDGET}"),
        rows("sg_fact_transaction", "SAGE", f"{_PLAN_B}, {_BUDGET}"),
    ),
    "fact_ebitda_adjs": (
        f"{_PLAN_KEY} as ebitda_adjustment_key, {_PLAN_KEY} as adjustment_id",
        rows("ns_fact_transaction", "NETSUITE", f"{_PLAN_A}, {_EBITDA}"),
        rows("sg_fact_transaction", "SAGE", f"{_PLAN_B}, {_EBITDA}"),
    ),
}


def with_views(text: str, extra: str = "") -> str:
    """Put the definitions of the views a text names in front of it."""
    needed = [name for name in VIEWS if re.search(rf"\b{name}\b", text + extra)]
    parts = [f"{name} as ({VIEWS[name]})" for name in needed] + ([extra] if extra else [])
    return f"with {', '.join(parts)} {text}" if parts else text


def model_body(name: str, first_where: str = "true", second_where: str = "true") -> str:
    """A model's select; the conditions see the conformed ``last_modified_date``."""
    after, first, second = SHAPES[name]
    wanted = ", ".join(COLUMNS[name][:-3])
    body = f"""(select * from ({first}) where {first_where}) union all by name
               (select * from ({second}) where {second_where})"""
    keyed = f"select *, {after} from ({body})"
    if name == "dim_chart_of_accounts":
        keyed = f"""select u.*, {_MAPPED} from ({keyed}) u left join map_coa_reporting m
            on u.account_id = m.account_id and upper(u.source_system) = upper(m.source_system)
            and {AS_OF} between m.effective_from and m.effective_to"""
    return f"select {wanted}, {AUDIT} from ({keyed})"


def one_per_key(body: str, name: str) -> str:
    names = COLUMNS[name]
    others = ", ".join(f"{c} desc nulls last" for c in names[1:] if c != "last_modified_date")
    return f"""select {", ".join(names)} from (select *, row_number() over (partition by {names[0]}
        order by last_modified_date desc nulls last, {others}) as place from ({body})) where place = 1"""


def batch_one(name: str) -> str:
    """The model over batch 1. A source without modification time has no batches."""
    _, first, _ = SHAPES[name]
    has_time = name != "dim_subsidiary"
    cut = f"last_modified_date <= {CUT}"
    return model_body(name, cut if has_time else "true", cut)


def newer(system: str, target: str) -> str:
    return f"""last_modified_date > (select coalesce(max(last_modified_date), timestamp '1900-01-01')
        from {target} where source_system = '{system}')"""


def second_run(name: str) -> str:
    """The model over what is newer than ``run_1``, per system."""
    first_where = "true" if name == "dim_subsidiary" else newer("NETSUITE", "run_1")
    return model_body(name, first_where, newer("SAGE", "run_1"))


def upsert_sql(name: str) -> str:
    """Two runs of a model with one row per key: batch 1, then everything newer than what run 1 left."""
    key_name = COLUMNS[name][0]
    runs = f"run_1 as ({one_per_key(batch_one(name), name)}), run_2 as ({one_per_key(second_run(name), name)})"
    text = f"""select * from run_1 where {key_name} not in (select {key_name} from run_2)
        union all select * from run_2"""
    return with_views(text, runs)


def merge_sql(name: str) -> str:
    """The same two runs with repeated keys left in: every target row of an updated key takes the update."""
    k = COLUMNS[name][0]
    # In batch 1 the transactions that repeat a customer are those of batch 1.
    early = batch_one(name).replace(
        "join ns_fact_transaction t", f"join (select * from ns_fact_transaction where last_modified_date <= {CUT}) t"
    )
    text = f"""select * from run_1 where {k} not in (select {k} from run_2)
        union all select run_2.* from run_1 join run_2 on run_1.{k} = run_2.{k}
        union all select * from run_2 where {k} not in (select {k} from run_1)"""
    return with_views(text, f"run_1 as ({early}), run_2 as ({second_run(name)})")


_SELECTED = "select source_system, transactionuniqueid, last_modified_date from"
_TARGET = f"target as ({batch_one('fact_transactions')})"

_PARTS = " union all ".join(f"select '{view}' as source_table, count(*) as n_rows from {view}" for view in VIEWS)


def history_runs_sql() -> str:
    """Three states of the customers, and what each run closes and leaves open."""
    return f"""
        with s1 as (select c_custkey as key, c_name as name, {duckdb_day('c_custkey % 1000')} as t from customer),
             s2 as (select key, case when key % 5 = 0 then name || '/2' else name end as name,
                           case when key % 5 = 0 then t + interval 1 day else t end as t from s1 where key % 10 <> 3
                    union all select -key - 1, name, t from s1 where key < 10),
             s3 as (select key, case when key % 7 = 0 or key % 10 = 3 then name || '/3' else name end as name,
                           case when key % 7 = 0 or key % 10 = 3 then t + interval 3 day else t end as t from s1),
             c2 as (select o.key, o.name, o.t, case when n.key is null then {RUN_TS} else n.t end as until
                    from s1 o left join s2 n on o.key = n.key where n.key is null or n.t > o.t),
             o2 as (select coalesce(n.key, o.key) as key, case when o.key is null or n.t > o.t then n.name else o.name end as name,
                           case when o.key is null or n.t > o.t then n.t else o.t end as t from s2 n left join s1 o on o.key = n.key),
             c3 as (select o.key, o.name, o.t, case when n.key is null then timestamp '2024-02-01' else n.t end as until
                    from o2 o left join s3 n on o.key = n.key where n.key is null or n.t > o.t),
             o3 as (select coalesce(n.key, o.key) as key, case when o.key is null or n.t > o.t then n.name else o.name end as name,
                           case when o.key is null or n.t > o.t then n.t else o.t end as t from s3 n left join o2 o on o.key = n.key)
        select key, name, t as valid_from, until as valid_to from c2 union all select * from c3
        union all select key, name, t, cast(null as timestamp) from o3"""


def oracle_sql() -> dict[str, str]:
    texts = {f"model_{name}": with_views(model_body(name)) for name in SHAPES}
    texts |= {f"upsert_{name}": upsert_sql(name) for name in SHAPES}
    texts |= {f"merge_{name}": merge_sql(name) for name in SHAPES if name not in PLANNING_FACTS}
    texts |= {
        "scan_sources": with_views(_PARTS),
        "watermarks_by_source": with_views(
            """select source_system, coalesce(max(last_modified_date), timestamp '1900-01-01') as watermark
               from target group by source_system""", _TARGET),
        "incremental_watermark": with_views(
            f"""{_SELECTED} ({model_body('fact_transactions', newer('NETSUITE', 'target'), newer('SAGE', 'target'))})""",
            _TARGET),
        "incremental_lookback": with_views(
            f"""{_SELECTED} ({model_body('fact_transactions')}) where last_modified_date >=
                (select coalesce(max(last_modified_date), timestamp '1900-01-01') - interval 3 day from target)""",
            _TARGET),
        "incremental_lookback_configured": with_views(
            f"""{_SELECTED} ({model_body('fact_transactions')}) where last_modified_date >=
                (select coalesce(max(last_modified_date), timestamp '1900-01-01') - interval 30 day from target)""",
            _TARGET),
        "merge_partitioned_fact_transactions": upsert_sql("fact_transactions"),
        "merge_partitioned_all_fact_transactions": merge_sql("fact_transactions"),
        "history_runs": history_runs_sql(),
        "history_added_column": f"""
            with h as (select c_custkey as key, c_name as name, c_mktsegment as segment, {duckdb_day('c_custkey % 1000')} as t from customer)
            select key, name, t as valid_from, case when key % 10 = 3 then timestamp '2024-02-01' when key % 2 = 0 then t + interval 1 day end as valid_to,
                   cast(null as varchar) as segment from h
            union all select key, name, t + interval 1 day, null, segment from h where key % 10 <> 3 and key % 2 = 0""",
        "run_by_tag": with_views(" union all ".join(
            f"select '{name}' as table_name, count(distinct {COLUMNS[name][0]}) as n_rows from ({model_body(name)})"
            for name in SHAPES if name.startswith("dim_"))),
        "recent_rows": "select event_id, ts from events where ts >= timestamp '2024-01-31' - interval 3 day",
        "soft_delete_filter": """select o_orderkey, o_orderstatus from orders
            where not coalesce(case o_orderstatus when 'F' then true when 'O' then false end, false)""",
        "schema_append": """select n_nationkey, n_name, case when n_nationkey % 2 = 0 then n_regionkey end as n_regionkey
            from nation""",
        "snapshot_scd2": f"""
            with h as (select c_custkey as key, c_name as name, {duckdb_day('c_custkey % 1000')} as t from customer),
                 c as (select key, name, case when key % 5 = 0 then t + interval 1 day else t end as t
                       from h where key % 10 <> 3
                       union all select -key - 1, name, t from h where key < 10)
            select h.key, h.name, h.t as valid_from,
                   case when c.key is null then {RUN_TS} when c.t > h.t then c.t end as valid_to
            from h left join c on h.key = c.key
            union all
            select c.key, c.name, c.t, cast(null as timestamp) from c left join h on h.key = c.key
            where h.key is null or c.t > h.t""",
        "effective_dated_join": with_views(
            f"""select u.source_system, u.account_id, m.gaap_mapping_l1, m.pandl_multiplier
                from (select 'NETSUITE' as source_system, cast(account_id as varchar) as account_id from ns_dim_chartofaccounts
                      union all select 'SAGE', cast(account_id as varchar) from sg_dim_chartofaccounts) u
                left join map_coa_reporting m on u.account_id = m.account_id
                     and upper(u.source_system) = upper(m.source_system)
                     and m.effective_from <= {AS_OF} and m.effective_to >= {AS_OF}"""),
        "union_relations": """select c_custkey as id, c_name as name, 'CUSTOMER' as source_system from customer
            union all select s_suppkey, s_name, 'SUPPLIER' from supplier""",
        "surrogate_key": """select c_custkey, md5('SAGE-' || cast(c_custkey as varchar)) as key_1,
            md5(case when c_custkey % 3 = 0 then '' else cast(c_custkey as varchar) end || '-' || c_name) as key_2
            from customer""",
        "clean_numeric": with_views(
            "select tran_id, transaction_line_number, "
            + cols(amount=number("amount"), convertedamount=number("trx_amount"), openamount=number("total_due"),
                   quantity=number("quantity")) + " from sg_fact_transaction"),
        "safe_cast": """select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as integer) as priority,
            coalesce(try_cast(o_orderstatus as integer), -1) as status from orders""",
        "normalize_amounts": """select l_orderkey, l_linenumber, l_partkey,
            cast(round(cast(l_extendedprice as decimal(18,4)) * coalesce(case when l_linenumber <> 1
                 then cast(1 + l_tax as decimal(10,4)) end, 1), 2) as decimal(18,2)) as amount from lineitem""",
        "fill_currency": """select n_nationkey, case when n_regionkey = 0 then 'USD' else substr(n_name, 1, 3) end as currency
            from nation""",
        "standardize_contacts": """
            select s_suppkey, regexp_replace(regexp_replace(phone, '\\D', '', 'g'), '^1', '') as phone,
                   lower(trim(email)) as email
            from (select s_suppkey, concat('+1 (', 100 + s_nationkey, ') ', 5550000 + s_suppkey) as phone,
                         concat('  ', s_name, '@Example.COM ') as email from supplier)""",
        "assign_fiscal_period": """
            select o_orderkey, cast(s as integer) as start_month,
                   cast(year(o_orderdate - to_months(s - 1)) as integer) as fiscal_year,
                   cast(quarter(o_orderdate - to_months(s - 1)) as integer) as fiscal_quarter
            from orders, unnest([1, 4, 7]) as starts(s)""",
    }
    return texts
