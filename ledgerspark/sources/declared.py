"""The declared inputs: which tables exist per source, and which columns the models read."""

from __future__ import annotations

# The tables of each source.
TABLES = {
    "gold_netsuite": """dim_accounting_period dim_classification dim_chartofaccounts dim_departments
        dim_employees dim_currency dim_entity dim_item dim_locations dim_subsidiary fact_transaction""".split(),
    "gold_sage": """dim_chartofaccounts dim_classification dim_customer dim_entity dim_vendor dim_currency
        dim_department dim_employee dim_item dim_location dim_reporting_period dim_subsidiary
        fact_transaction""".split(),
    "silver_netsuite": """accounting_period accounts classification consolidated_exchange_rates currencies
        currencyrates departments employees entity item locations subsidiaries transaction
        transaction_accounting_line transaction_lines transaction_status""".split(),
    "silver_sage": """account batch currency customer department detail employee entry item location
        location_entity reporting_period""".split(),
    "coa_mapping": ["map_coa_reporting"],
}

# The columns the models need from each table they read.
COLUMNS = {
    ("gold_netsuite", "dim_locations"): "location_id location_name parent last_modified_date",
    ("gold_netsuite", "dim_item"): "item_id item_name item_type last_modified_date",
    ("gold_netsuite", "dim_entity"): """entity_id first_name last_name entity_title entity_type employee_id
        customer_id vendor_id last_modified_date""",
    ("gold_netsuite", "dim_departments"): """department_id department_name department_full_name parent
        last_modified_date""",
    ("gold_netsuite", "dim_currency"): """currency_id currency_name currency_symbol is_base_currency
        last_modified_date""",
    ("gold_netsuite", "dim_classification"): "class_id class_name last_modified_date",
    ("gold_netsuite", "dim_chartofaccounts"): """account_id account_number account_name account_type
        account_description display_name account_parent_id display_name_with_hierarchy department_id class_id
        subsidiary_id last_modified_date""",
    ("gold_netsuite", "dim_employees"): """employee_id job_description email department_id class_id location_id
        subsidiary is_inactive last_modified_date""",
    ("gold_netsuite", "dim_subsidiary"): "subsidiary_id subsidiary_name",
    ("gold_netsuite", "fact_transaction"): """transaction_id transaction_line_id account_id class_id item_id
        department_id subsidiary_id location_id entity_id posting_period_id currency_id tran_date start_date
        due_date close_date amount converted_net_amount amount_paid quantity net_amount transaction_type
        accounting_line_type transaction_status_id transaction_accounting_posting_flag last_modified_date""",
    ("gold_sage", "dim_location"): "location_id location_full_name parent last_modified_date",
    ("gold_sage", "dim_item"): "item_id item_name item_type last_modified_date",
    ("gold_sage", "dim_entity"): "entity_id entity_name entity_type last_modified_date",
    ("gold_sage", "dim_department"): "department_id department_name parent last_modified_date",
    ("gold_sage", "dim_currency"): "currency_id currency_name symbol updated_at",
    ("gold_sage", "dim_classification"): "class_id class_name last_modified_date",
    ("gold_sage", "dim_chartofaccounts"): """account_id account_number account_name account_type category
        alternative_account last_modified_date""",
    ("gold_sage", "dim_employee"): """employee_id employee_name email department_id class_id location_id
        subsidiary is_inactive last_modified_date""",
    ("gold_sage", "dim_customer"): "customer_id customer_name customer_type last_modified_date",
    ("gold_sage", "dim_subsidiary"): "subsidiary_id subsidiary_title last_modified_date",
    ("gold_sage", "fact_transaction"): """tran_id transaction_line_number account_number account_id classid
        itemid department_id subsidiary_id location_id customer_id vendor_id currency_id reporting_period_id
        tran_date start_date due_date close_date amount trx_amount total_due quantity transaction_type
        account_type state last_modified_date""",
    ("coa_mapping", "map_coa_reporting"): """account_id source_system gaap_mapping_l1 gaap_mapping_l2
        gaap_mapping_l3 gaap_mapping_l4 cashflow_l1 cashflow_l2 cashflow_l3 pandl_multiplier budget_multiplier
        debt_mapping effective_from effective_to""",
}
