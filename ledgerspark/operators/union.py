"""Unions of conformed or tagged tables. They add no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.contracts import ContractError


def union_rows(*parts: DataFrame) -> DataFrame:
    """All rows of tables that already have the same columns and types; anything else is an error.

    Types are compared first because a union would otherwise widen them quietly.
    """
    wanted = [(f.name, f.dataType) for f in parts[0].schema]
    for part in parts[1:]:
        found = [(f.name, f.dataType) for f in part.schema]
        if found != wanted:
            raise ContractError(f"cannot union {found} with {wanted}")
    return reduce(DataFrame.union, parts)


def union_relations(relations: dict[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """All rows of the named tables, each row tagged with its table's name in upper case."""
    tagged = [df.withColumn(tag, F.lit(name.upper())) for name, df in relations.items()]
    return reduce(DataFrame.unionByName, tagged)
