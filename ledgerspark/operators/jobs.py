"""Table-level forms of the expression library: a table in, the same table with columns added or cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import functions as fn
from ledgerspark.settings import RunContext, Settings

WHOLE_TYPES = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}
# Digits, perhaps with a sign or blanks around them; wider than what the cast accepts, never narrower.
WHOLE_NUMBER = r"^[^0-9A-Za-z]*[0-9]+[^A-Za-z]*$"


def with_key(df: DataFrame, name: str, parts) -> DataFrame:
    """Add the surrogate key over id columns (names) or ready text expressions."""
    types = {f.name.lower(): f.dataType for f in df.schema}
    texts = [fn.id_text(F.col(p), types[p.lower()], p) if isinstance(p, str) else p for p in parts]
    return df.withColumn(name, fn.surrogate_key(*texts))


def with_audit(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Add the audit columns of this run."""
    stamp = fn.timestamp_literal(ctx.run_ts)
    return df.withColumns({"_created_at": stamp, "_updated_at": stamp, "_dbt_run_id": F.lit(ctx.run_id)})


def safe_cast_columns(df: DataFrame, casts: dict[str, tuple]) -> DataFrame:
    """Cast columns to a type, with null or a default where the value does not parse.

    ``casts`` maps a column to ``(type,)`` or ``(type, default)``; a default of 0 counts as a default.
    """
    texts = {f.name.lower() for f in df.schema if isinstance(f.dataType, T.StringType)}

    def cast(name: str, kind: str, default=None) -> Column:
        column = F.col(name)
        if name.lower() in texts and kind.lower() in WHOLE_TYPES:
            # A failed parse costs an exception per row, so text without the shape of a number is left out first.
            column = F.when(column.rlike(WHOLE_NUMBER), column)
        return fn.safe_cast(column, kind, default)

    return df.withColumns({name: cast(name, *spec) for name, spec in casts.items()})


def normalize_amounts(df: DataFrame, amounts, rate: Column | str | None = None) -> DataFrame:
    """Round amounts to two decimals, times an exchange rate when one is given. Use decimal amounts."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return df.withColumns({name: fn.rounded_amount(F.col(name), rate) for name in amounts})


def fill_currency(df: DataFrame, column: str, default: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """Put a currency where none is given: ``default``, else the one of the settings."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(settings.default_currency if default is None else default)))


def drop_soft_deleted(df: DataFrame, flag: str = "is_deleted", enabled: bool | None = None,
                      settings: Settings = Settings()) -> DataFrame:
    """Rows not marked as deleted, unless switched off here or in the settings; a missing mark counts as not deleted."""
    enabled = settings.enable_soft_deletes if enabled is None else enabled
    return df.where(~F.coalesce(F.col(flag), F.lit(False))) if enabled else df


def standardize_contacts(df: DataFrame, phones=(), emails=()) -> DataFrame:
    """Clean phone and e-mail columns."""
    cleaned = {name: fn.phone_number(F.col(name)) for name in phones}
    cleaned |= {name: fn.email_address(F.col(name)) for name in emails}
    return df.withColumns(cleaned)


def assign_fiscal_period(df: DataFrame, day: str, start_month: Column | int = 1) -> DataFrame:
    """Add ``fiscal_year`` and ``fiscal_quarter`` of a date column."""
    return df.withColumns({
        "fiscal_year": fn.fiscal_year(F.col(day), start_month),
        "fiscal_quarter": fn.fiscal_quarter(F.col(day), start_month),
    })
