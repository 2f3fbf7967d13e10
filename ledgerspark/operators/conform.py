"""Conforming projection: one source table in, the columns of an output contract out.

A ``Feed`` says which source column or rule fills which contract column. Contract columns that a feed does not
mention become typed nulls. The projection is narrow: it never shuffles, and only the columns it names are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.contracts import ContractError
from ledgerspark.functions import id_text

# A field is built late, because a Column needs a running session: it gets the source's types by lower-case name.
SourceTypes = dict[str, T.DataType]
Field = Callable[[SourceTypes], Column]


def plain(name: str) -> Field:
    """The source column as it is; the contract decides its type."""
    return lambda types: F.col(name)


def ident(name: str) -> Field:
    """The source column as id text; refused at plan time when its type cannot be an id."""

    def build(types: SourceTypes) -> Column:
        return id_text(F.col(name), _type_of(types, name), name)

    return build


def rule(expression: Callable[..., Column], *names: str) -> Field:
    """An expression over source columns."""
    return lambda types: expression(*[F.col(name) for name in names])


def first_ident(*names: str) -> Field:
    """The first of several ids that is not null."""
    return lambda types: F.coalesce(*[ident(name)(types) for name in names])


def joined_idents(*names: str) -> Field:
    """Ids joined by ``-``; null as soon as one of them is null."""

    def build(types: SourceTypes) -> Column:
        parts: list[Column] = []
        for name in names:
            parts += [F.lit("-"), ident(name)(types)]
        return F.concat(*parts[1:])

    return build


def ident_when(name: str, condition: Callable[[], Column]) -> Field:
    """The id where the condition holds, null elsewhere."""
    return lambda types: F.when(condition(), ident(name)(types))


@dataclass(frozen=True)
class Feed:
    """How one source table fills an output table.

    ``modified`` is the source column compared with the high watermark; a feed without one is always read whole
    and carries ``modified_constant`` instead.
    """

    system: str
    source: str
    table: str
    fields: dict[str, Field | str]
    modified: str | None = "last_modified_date"
    modified_constant: Callable[[], Column] | None = None
    keep: Callable[[], Column] | None = None
    key_parts: tuple[str, ...] | None = None
    matches: tuple[str, str, str, str] | None = field(default=None)


def conform(df: DataFrame, feed: Feed, contract: T.StructType) -> DataFrame:
    """Project ``df`` to the contract columns the feed can fill, in contract order and with contract types."""
    unknown = set(feed.fields) - set(contract.fieldNames())
    if unknown:
        raise ContractError(f"{feed.source}.{feed.table} fills columns outside its contract: {sorted(unknown)}")
    types = {f.name.lower(): f.dataType for f in df.schema}
    columns = []
    for out in contract:
        if out.name == "source_system":
            value = F.lit(feed.system.upper())
        elif out.name == "last_modified_date":
            value = F.col(feed.modified) if feed.modified else feed.modified_constant()
        elif out.name in feed.fields:
            given = feed.fields[out.name]
            value = (plain(given) if isinstance(given, str) else given)(types)
        else:
            value = F.lit(None)
        columns.append(value.cast(out.dataType.simpleString()).alias(out.name))
    return df.select(*columns)


def _type_of(types: SourceTypes, name: str) -> T.DataType:
    if name.lower() not in types:
        raise ContractError(f"the source has no column {name}")
    return types[name.lower()]
