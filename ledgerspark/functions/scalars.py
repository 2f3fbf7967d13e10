"""Column expressions of the model. All are built-in functions and stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_literal(value: datetime) -> Column:
    """``value`` as a timestamp without zone, whatever zone the session or the driver has."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def is_text(column: Column, word: str) -> Column:
    """Equality that ignores case; null stays null."""
    return F.lower(column) == word.lower()


def clean_number(column: Column) -> Column:
    """The marker text ``NULL`` and real nulls become 0; other text is cast strictly and fails if bad."""
    return F.coalesce(F.nullif(column.cast("string"), F.lit("NULL")), F.lit("0")).cast("double")


def safe_cast(column: Column, data_type: str, default=None) -> Column:
    """Null, or ``default`` when one is given, where the value does not parse."""
    parsed = column.try_cast(data_type)
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast(data_type))


def rounded_amount(amount: Column, rate: Column | None = None) -> Column:
    """Two decimals; a missing rate counts as 1."""
    return F.round(amount if rate is None else amount * F.coalesce(rate, F.lit(1)), 2)


def phone_number(column: Column) -> Column:
    """Digits only, without one leading 1."""
    digits = F.regexp_replace(column, "[^0-9]", "")
    return F.regexp_replace(digits, "^1", "")


def email_address(column: Column) -> Column:
    """Lower case without surrounding spaces (other white space stays)."""
    return F.lower(F.trim(column))


def fiscal_year(day: Column, start_month: Column | int = 1) -> Column:
    """The calendar year in which the fiscal year of ``day`` began."""
    return F.year(day) - (F.month(day) < start_month).cast("int")


def fiscal_quarter(day: Column, start_month: Column | int = 1) -> Column:
    """1 to 4, counted from ``start_month``."""
    months_in = F.pmod(F.month(day) - start_month, F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")
