"""The twelve dimensions. Unmentioned contract columns are typed nulls.

Most keys hash the natural id alone, so one id used by both systems gives one key and the later merge wins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import is_text, surrogate_key, timestamp_literal
from ledgerspark.operators.conform import Feed, ident, ident_when, rule
from ledgerspark.operators.joins import effective_dated_join
from ledgerspark.plans.model import Model
from ledgerspark.settings import EPOCH, NETSUITE, SAGE


def _netsuite(table: str, fields: dict, **options) -> Feed:
    return Feed(NETSUITE, "gold_netsuite", table, fields, **options)


def _sage(table: str, fields: dict, **options) -> Feed:
    return Feed(SAGE, "gold_sage", table, fields, **options)


def _dimension(subject: str, key: str, key_parts: tuple[str, ...], *feeds: Feed, **options) -> Model:
    return Model(f"dim_{subject}", key, key_parts, ("cdm", "dimension", options.pop("tag", subject)), feeds, **options)


# Fixed values, here and in every feed below: which source column fills which output column.
LOCATION = _dimension(
    "location", "location_key", ("location_id",),
    _netsuite("dim_locations", {
        "location_id": ident("location_id"),
        "location_name": "location_name",
        "parent_location_key": ident("parent"),
    }),
    _sage("dim_location", {
        "location_id": ident("location_id"),
        "location_name": "location_full_name",
        "parent_location_key": ident("parent"),
    }),
)

_ITEM = {"item_id": ident("item_id"), "item_name": "item_name", "item_type": "item_type"}
ITEM = _dimension(
    "item", "item_key", ("source_system", "item_id"), _netsuite("dim_item", _ITEM), _sage("dim_item", _ITEM)
)

# The same rows as the items under a key without the system; category and subcategory wait for user input.
_PRODUCT = {"product_id": ident("item_id"), "product_name": "item_name", "product_type": "item_type"}
PRODUCT = _dimension(
    "product", "product_key", ("product_id",), _netsuite("dim_item", _PRODUCT), _sage("dim_item", _PRODUCT)
)


def _person_or_title(first, last, title):
    return F.coalesce(F.concat(first, F.lit(" "), last), title)


def _sage_id_of(entity_type: str):
    return ident_when("entity_id", lambda: is_text(F.col("entity_type"), entity_type))


ENTITY = _dimension(
    "entity", "entity_key", ("entity_id",),
    _netsuite("dim_entity", {
        "entity_id": ident("entity_id"),
        "entity_name": rule(_person_or_title, "first_name", "last_name", "entity_title"),
        "entity_type": "entity_type",
        "employee_id": ident("employee_id"),
        "customer_id": ident("customer_id"),
        "vendor_id": ident("vendor_id"),
    }),
    _sage("dim_entity", {
        "entity_id": ident("entity_id"),
        "entity_name": "entity_name",
        "entity_type": "entity_type",
        "employee_id": _sage_id_of("employee"),
        "customer_id": _sage_id_of("customer"),
        "vendor_id": _sage_id_of("vendor"),
    }),
)

# The parent's key includes the system while the department's own key does not, so the two never meet.
DEPARTMENT = _dimension(
    "department", "department_key", ("department_id",),
    _netsuite("dim_departments", {
        "department_id": ident("department_id"),
        "department_name": "department_name",
        "full_hierarchy_name": "department_full_name",
        "parent_department_id": ident("parent"),
    }),
    _sage("dim_department", {
        "department_id": ident("department_id"),
        "department_name": "department_name",
        "full_hierarchy_name": "department_name",
        "parent_department_id": ident("parent"),
    }),
    derived={
        "parent_department_key": lambda: surrogate_key(F.col("source_system"), F.col("parent_department_id")),
    },
)

VENDOR = _dimension(
    "vendor", "vendor_key", ("vendor_id",),
    _netsuite("dim_entity", {"vendor_id": ident("vendor_id"), "vendor_name": "entity_title"},
              keep=lambda: is_text(F.col("entity_type"), "vendor")),
    _sage("dim_entity", {"vendor_id": ident("entity_id"), "vendor_name": "entity_name"},
          keep=lambda: is_text(F.col("entity_type"), "vendor")),
)

CURRENCY = _dimension(
    "currency", "currency_key", ("currency_id",),
    _netsuite("dim_currency", {
        "currency_id": ident("currency_id"),
        "currency_name": "currency_name",
        "currency_symbol": "currency_symbol",
        "is_base_currency": "is_base_currency",
    }),
    _sage("dim_currency", {
        "currency_id": ident("currency_id"),
        "currency_name": "currency_name",
        "currency_symbol": "symbol",
    }, modified="updated_at"),
)

_CLASS = {"class_id": ident("class_id"), "class_name": "class_name"}
CLASS = _dimension(
    "class", "class_key", ("class_id",), _netsuite("dim_classification", _CLASS), _sage("dim_classification", _CLASS)
)

# Mapping columns and their names in the account dimension.
MAPPING_VALUES = {
    "gaap_mapping_l1": "gaapmappingl1",
    "gaap_mapping_l2": "gaapmappingl2",
    "gaap_mapping_l3": "gaapmappingl3",
    "gaap_mapping_l4": "gaapmappingl4",
    "cashflow_l1": "cashflowl1",
    "cashflow_l2": "cashflowl2",
    "cashflow_l3": "cashflowl3",
    "pandl_multiplier": "pandlmultiplier",
    "budget_multiplier": "budgetmultiplier",
    "debt_mapping": "debtmapping",
}


def _with_mapping(accounts, resolve, ctx):
    """Replace the null mapping columns by the mapping valid on the as-of date."""
    accounts = accounts.drop(*MAPPING_VALUES.values())
    mapping = resolve("coa_mapping", "map_coa_reporting")
    return effective_dated_join(accounts, mapping, ctx.as_of_date, MAPPING_VALUES)


# The second system's key hashes the account number, though both systems are mapped by account id.
CHART_OF_ACCOUNTS = _dimension(
    "chart_of_accounts", "account_key", ("account_id",),
    _netsuite("dim_chartofaccounts", {
        "account_id": ident("account_id"),
        "account_number": "account_number",
        "account_name": "account_name",
        "account_type": "account_type",
        "description": "account_description",
        "display_name": "display_name",
        "parent_account_id": ident("account_parent_id"),
        "full_hierarchy_name": "display_name_with_hierarchy",
        "department_id": ident("department_id"),
        "class_id": ident("class_id"),
        "subsidiary_id": ident("subsidiary_id"),
    }),
    _sage("dim_chartofaccounts", {
        "account_id": ident("account_id"),
        "account_number": ident("account_number"),
        "account_name": "account_name",
        "account_type": "account_type",
        "description": "category",
        "display_name": "account_name",
        "parent_account_id": ident("alternative_account"),
        "full_hierarchy_name": "account_name",
    }, key_parts=("account_number",)),
    enrich=_with_mapping,
    tag="account",
)


def _status_is(word: str):
    """True where the upper-cased status equals ``word`` exactly, false elsewhere and for null."""
    return lambda status: F.coalesce(F.upper(status) == word, F.lit(False))


def _employee(title: str, inactive_word: str) -> dict:
    return {
        "employee_id": ident("employee_id"),
        "title": title,
        "email": "email",
        "department_key": ident("department_id"),
        "class_key": ident("class_id"),
        "location_key": ident("location_id"),
        "subsidiary_key": ident("subsidiary"),
        "is_inactive": rule(_status_is(inactive_word), "is_inactive"),
    }


# Kept as it is: upper case never equals 'true', and the second system's flag marks the active.
EMPLOYEE = _dimension(
    "employee", "employee_key", ("employee_id",),
    _netsuite("dim_employees", _employee("job_description", "true")),
    _sage("dim_employee", _employee("employee_name", "ACTIVE")),
)

# A customer of the first system is repeated once per transaction, whose amount is then not kept.
CUSTOMER = _dimension(
    "customer", "customer_key", ("source_system", "customer_id"),
    _netsuite("dim_entity", {
        "customer_id": ident("entity_id"),
        "customer_name": "entity_title",
        "customer_type": "entity_type",
    }, keep=lambda: is_text(F.col("entity_type"), "customer"),
        matches=("gold_netsuite", "fact_transaction", "customer_id", "entity_id")),
    _sage("dim_customer", {
        "customer_id": ident("customer_id"),
        "customer_name": "customer_name",
        "customer_type": "customer_type",
    }),
)

# The first system has no modification time, so its few rows are always read.
SUBSIDIARY = _dimension(
    "subsidiary", "subsidiary_key", ("subsidiary_id",),
    _netsuite("dim_subsidiary", {"subsidiary_id": ident("subsidiary_id"), "subsidiary_name": "subsidiary_name"},
              modified=None, modified_constant=lambda: timestamp_literal(EPOCH)),
    _sage("dim_subsidiary", {"subsidiary_id": ident("subsidiary_id"), "subsidiary_name": "subsidiary_title"}),
)

DIMENSIONS = (LOCATION, ITEM, ENTITY, DEPARTMENT, VENDOR, CURRENCY, CLASS, PRODUCT, CHART_OF_ACCOUNTS, EMPLOYEE,
              CUSTOMER, SUBSIDIARY)
