"""Key rendering. The text form of an id decides the key, so it is checked at plan time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.contracts import ContractError


def id_text(column: Column, data_type: T.DataType, label: str = "id") -> Column:
    """``column`` as text. Integers, whole decimals and text are ids; anything else is refused.

    A floating id would render as ``5.0`` (or ``1.0E7``) and so never meet the same id read as an integer.
    """
    whole = isinstance(data_type, T.IntegralType) or (isinstance(data_type, T.DecimalType) and data_type.scale == 0)
    if not whole and not isinstance(data_type, (T.StringType, T.NullType)):
        raise ContractError(f"{label} has type {data_type.simpleString()}, which cannot be an id")
    return column.cast("string")


def surrogate_key(*parts: Column) -> Column:
    """MD5 over text parts joined by ``-``; a null part counts as empty text, so the key is never null."""
    return F.md5(F.concat_ws("-", *[F.coalesce(part, F.lit("")) for part in parts]))
