"""Named source tables: where they live, and whether they have the columns the models read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.contracts import require_columns
from ledgerspark.settings import Settings
from ledgerspark.sources.declared import COLUMNS, TABLES

Given = DataFrame | str | Callable[[], DataFrame]


def table_name(source: str, table: str, settings: Settings = Settings()) -> str:
    """The full name of a declared source table."""
    schemas = {
        "gold_netsuite": settings.netsuite_gold_schema,
        "gold_sage": settings.sage_gold_schema,
        "silver_netsuite": settings.netsuite_silver_schema,
        "silver_sage": settings.sage_silver_schema,
        "coa_mapping": settings.mapping_schema,
    }
    if table not in TABLES.get(source, ()):
        raise KeyError(f"no source table {source}.{table} is declared")
    return qualified(settings.source_database, schemas[source], table)


def qualified(*parts: str | None) -> str:
    """A name of the parts that are given."""
    return ".".join(part for part in parts if part)


def target_namespace(custom: str | None, default: str) -> str:
    """The schema an output goes to: the custom one word for word (trimmed) when given, else the default."""
    return default if custom is None or not custom.strip() else custom.strip()


class SourceCatalog:
    """Resolves ``(source, table)`` to a DataFrame.

    ``given`` overrides single tables with a DataFrame, a function that makes one, or a Parquet path; every other
    declared table is read from the session's catalog. Each read is its own scan, so each model prunes it to the
    columns it needs.
    """

    def __init__(self, spark: SparkSession, settings: Settings = Settings(),
                 given: dict[tuple[str, str], Given] | None = None):
        self.spark = spark
        self.settings = settings
        self._given = dict(given or {})
        self._batches: dict[tuple[str, str], DataFrame] = {}

    def sharing(self, batches: dict[tuple[str, str], DataFrame]) -> SourceCatalog:
        """The same sources, with rows that are newer than the watermarks of all who ask for newer ones read already."""
        shared = SourceCatalog(self.spark, self.settings, self._given)
        shared._batches = dict(batches)
        return shared

    def resolve_newer(self, source: str, table: str) -> DataFrame:
        """At least the rows that are newer than the caller's watermark: those read already, else the whole table."""
        batch = self._batches.get((source, table))
        return self.resolve(source, table) if batch is None else batch

    def resolve(self, source: str, table: str) -> DataFrame:
        name = table_name(source, table, self.settings)
        given = self._given.get((source, table), None)
        if given is None:
            df = self.spark.read.table(name)
        elif isinstance(given, str):
            df = self.spark.read.parquet(given)
        else:
            df = given if isinstance(given, DataFrame) else given()
        return require_columns(df, COLUMNS.get((source, table), "").split(), f"{source}.{table}")
