"""Finance common data model on Spark: conform, key, union, merge and map ledger data."""
