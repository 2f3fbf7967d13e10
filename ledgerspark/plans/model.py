"""What a model is: a key, tags and one feed per source system."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ledgerspark.contracts import CONTRACTS
from ledgerspark.operators.conform import Feed
from ledgerspark.settings import RunContext


@dataclass(frozen=True)
class Model:
    """``key_parts`` are contract columns; a feed may hash others. ``derived`` columns come after the key.

    ``enrich`` joins further columns: it gets the rows, the source resolver and the run.
    """

    name: str
    key: str
    key_parts: tuple[str, ...]
    tags: tuple[str, ...]
    feeds: tuple[Feed, ...]
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    enrich: Callable[[DataFrame, Callable[[str, str], DataFrame], RunContext], DataFrame] | None = None

    @property
    def contract(self) -> T.StructType:
        return CONTRACTS[self.name]

    @property
    def systems(self) -> tuple[str, ...]:
        return tuple(feed.system for feed in self.feeds)
