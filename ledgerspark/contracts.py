"""Output contracts: the columns, order and types of every table of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# The audit columns that end every table.
AUDIT_COLUMNS = "last_modified_date:timestamp_ntz _created_at:timestamp_ntz _updated_at:timestamp_ntz _dbt_run_id"

# Column names in output order; a column without a type is text.
_COLUMNS = {
    "dim_location": "location_key source_system location_id location_name parent_location_key",
    "dim_item": "item_key source_system item_id item_name item_type",
    "dim_entity": """entity_key source_system entity_id entity_name entity_type
        employee_id customer_id vendor_id""",
    "dim_department": """department_key source_system department_id department_name
        full_hierarchy_name parent_department_id parent_department_key""",
    "dim_vendor": "vendor_key source_system vendor_id vendor_name",
    "dim_currency": """currency_key source_system currency_id currency_name currency_symbol
        is_base_currency:boolean""",
    "dim_class": "class_key source_system class_id class_name",
    "dim_product": """product_key source_system product_id product_name product_type
        product_category product_subcategory""",
    "dim_chart_of_accounts": """account_key source_system account_id account_number account_name
        account_type description display_name parent_account_id full_hierarchy_name
        department_id class_id subsidiary_id product_id
        gaapmappingl1 gaapmappingl2 gaapmappingl3 gaapmappingl4
        cashflowl1 cashflowl2 cashflowl3
        pandlmultiplier:double budgetmultiplier:double debtmapping""",
    "dim_employee": """employee_key source_system employee_id title email
        department_key class_key location_key subsidiary_key is_inactive:boolean""",
    "dim_customer": """customer_key source_system customer_id customer_name customer_type
        payment_plan""",
    "dim_subsidiary": "subsidiary_key source_system subsidiary_id subsidiary_name",
    "fact_transactions": """financetransactionkey source_system transactionuniqueid
        transactionid transactionlineid chartofaccountkey classkey itemkey productkey
        departmentkey subsidiarykey locationkey entitykey customerkey vendorkey
        accountingperiodkey currency
        transactiondate:date postingperioddate:date duedate:date closedate:date
        amount:double convertedamount:double openamount:double quantity:double
        transactiontype debitcreditflag transactionstatus postingflag""",
    "fact_budget": """budget_transaction_key source_system budget_id subsidiary_key
        chart_of_account_key class_key department_key location_key accounting_period_key
        currency customerkey itemkey productkey
        amount:double convertedamount:double type""",
    "fact_ebitda_adjs": """ebitda_adjustment_key source_system adjustment_id subsidiary_key
        chart_of_account_key class_key department_key location_key accounting_period_key
        currency customerkey itemkey productkey
        adjustment_type adjustment_description amount:double converted_amount:double""",
}


class ContractError(ValueError):
    """A table does not have the columns or types it was declared with."""


def _struct(columns: str) -> T.StructType:
    fields = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "string"], True))
    return T.StructType(fields)


CONTRACTS: dict[str, T.StructType] = {
    model: _struct(f"{columns} {AUDIT_COLUMNS}") for model, columns in _COLUMNS.items()
}


def require_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise when its columns or types differ from ``contract``."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in contract]
    if found != wanted:
        wrong = [f"{w[0]}: wanted {w[1]}, found {dict(found).get(w[0], 'nothing')}" for w in wanted if w not in found]
        extra = [name for name, _ in found if name not in dict(wanted)]
        raise ContractError(f"contract not met; wrong: {wrong}; unexpected: {extra}; found order: {df.columns}")
    return df


def require_columns(df: DataFrame, columns, label: str) -> DataFrame:
    """Return ``df`` unchanged, or raise when it lacks one of ``columns`` (names ignore case)."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in present]
    if missing:
        raise ContractError(f"{label} lacks the columns {missing}")
    return df
