from ledgerspark.operators.conform import Feed, conform, ident, plain, rule
from ledgerspark.operators.jobs import (
    assign_fiscal_period,
    drop_soft_deleted,
    fill_currency,
    normalize_amounts,
    safe_cast_columns,
    standardize_contacts,
    with_audit,
    with_key,
)
from ledgerspark.operators.joins import effective_dated_join, repeat_per_match
from ledgerspark.operators.snapshot import snapshot_scd2
from ledgerspark.operators.union import union_relations, union_rows
from ledgerspark.operators.upsert import DuplicateKeyError, latest_per_key, merge_into, upsert
from ledgerspark.operators.watermark import (
    high_watermark,
    high_watermarks,
    newer_than,
    recent_rows,
    watermarks_by_source,
    within_lookback,
)

__all__ = [
    "DuplicateKeyError",
    "Feed",
    "assign_fiscal_period",
    "conform",
    "drop_soft_deleted",
    "effective_dated_join",
    "fill_currency",
    "high_watermark",
    "high_watermarks",
    "ident",
    "latest_per_key",
    "merge_into",
    "newer_than",
    "normalize_amounts",
    "plain",
    "recent_rows",
    "repeat_per_match",
    "rule",
    "safe_cast_columns",
    "snapshot_scd2",
    "standardize_contacts",
    "union_relations",
    "union_rows",
    "upsert",
    "watermarks_by_source",
    "with_audit",
    "with_key",
    "within_lookback",
]
