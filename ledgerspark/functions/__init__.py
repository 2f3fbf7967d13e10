from ledgerspark.functions.keys import id_text, surrogate_key
from ledgerspark.functions.scalars import (
    clean_number,
    email_address,
    fiscal_quarter,
    fiscal_year,
    is_text,
    phone_number,
    rounded_amount,
    safe_cast,
    timestamp_literal,
)

__all__ = [
    "clean_number",
    "email_address",
    "fiscal_quarter",
    "fiscal_year",
    "id_text",
    "is_text",
    "phone_number",
    "rounded_amount",
    "safe_cast",
    "surrogate_key",
    "timestamp_literal",
]
