"""The three facts. Their foreign keys are natural ids as text; they meet dimensions on system and id."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import clean_number
from ledgerspark.operators.conform import Feed, first_ident, ident, joined_idents, rule
from ledgerspark.plans.model import Model
from ledgerspark.settings import NETSUITE, SAGE


def _fact_feed(system: str, fields: dict) -> Feed:
    return Feed(system, f"gold_{system.lower()}", "fact_transaction", fields)


# Fixed values, here and in every feed below: which source column fills which output column.
_DATES = {
    "transactiondate": "tran_date",
    "postingperioddate": "start_date",
    "duedate": "due_date",
    "closedate": "close_date",
}

TRANSACTIONS = Model(
    "fact_transactions", "financetransactionkey", ("source_system", "transactionid", "transactionlineid"),
    ("cdm", "fact", "transaction"),
    (
        _fact_feed(NETSUITE, _DATES | {
            "transactionuniqueid": joined_idents("transaction_id", "transaction_line_id"),
            "transactionid": ident("transaction_id"),
            "transactionlineid": ident("transaction_line_id"),
            "chartofaccountkey": ident("account_id"),
            "classkey": ident("class_id"),
            "itemkey": ident("item_id"),
            "productkey": ident("item_id"),
            "departmentkey": ident("department_id"),
            "subsidiarykey": ident("subsidiary_id"),
            "locationkey": ident("location_id"),
            "entitykey": ident("entity_id"),
            "customerkey": ident("entity_id"),
            "vendorkey": ident("entity_id"),
            "accountingperiodkey": ident("posting_period_id"),
            "currency": ident("currency_id"),
            "amount": "amount",
            "convertedamount": "converted_net_amount",
            "openamount": "amount_paid",
            "quantity": "quantity",
            "transactiontype": "transaction_type",
            "debitcreditflag": "accounting_line_type",
            "transactionstatus": "transaction_status_id",
            "postingflag": "transaction_accounting_posting_flag",
        }),
        _fact_feed(SAGE, _DATES | {
            "transactionuniqueid": joined_idents("tran_id", "transaction_line_number"),
            "transactionid": ident("tran_id"),
            "transactionlineid": ident("transaction_line_number"),
            "chartofaccountkey": ident("account_number"),
            "classkey": ident("classid"),
            "itemkey": ident("itemid"),
            "productkey": ident("itemid"),
            "departmentkey": ident("department_id"),
            "subsidiarykey": ident("subsidiary_id"),
            "locationkey": ident("location_id"),
            "entitykey": first_ident("customer_id", "vendor_id"),
            "customerkey": ident("customer_id"),
            "vendorkey": ident("vendor_id"),
            "accountingperiodkey": ident("tran_id"),
            "currency": ident("currency_id"),
            "amount": rule(clean_number, "amount"),
            "convertedamount": rule(clean_number, "trx_amount"),
            "openamount": rule(clean_number, "total_due"),
            "quantity": rule(clean_number, "quantity"),
            "transactiontype": "transaction_type",
            "debitcreditflag": "account_type",
            "transactionstatus": "state",
            "postingflag": "state",
        }),
    ),
)


def _plan_fields(class_id: str, period: str, customer: str, item: str) -> dict:
    """The foreign keys of the two planning facts; their measures have no source yet and stay null."""
    return {
        "subsidiary_key": ident("subsidiary_id"),
        "chart_of_account_key": ident("account_id"),
        "class_key": ident(class_id),
        "department_key": ident("department_id"),
        "location_key": ident("location_id"),
        "accounting_period_key": ident(period),
        "currency": ident("currency_id"),
        "customerkey": ident(customer),
        "itemkey": ident(item),
        "productkey": ident(item),
    }


def _planning_fact(name: str, key: str, id_column: str) -> Model:
    """Rows per transaction under a key per account, subsidiary and period, so keys repeat."""
    return Model(
        name, key, ("source_system", "chart_of_account_key", "subsidiary_key", "accounting_period_key"),
        ("cdm", "fact", "budget"),
        (
            _fact_feed(NETSUITE, _plan_fields("class_id", "posting_period_id", "entity_id", "item_id")),
            _fact_feed(SAGE, _plan_fields("classid", "reporting_period_id", "customer_id", "itemid")),
        ),
        derived={id_column: lambda: F.col(key)},
    )


BUDGET = _planning_fact("fact_budget", "budget_transaction_key", "budget_id")
EBITDA_ADJUSTMENTS = _planning_fact("fact_ebitda_adjs", "ebitda_adjustment_key", "adjustment_id")

FACTS = (TRANSACTIONS, BUDGET, EBITDA_ADJUSTMENTS)
