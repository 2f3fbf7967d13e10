"""What several operators share: stored intermediate tables, words of Arrow text columns, components of a graph."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: everything between these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that are handled as one numpy array; a longer text is one array of its own.
SLICE_BYTES = 1 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CONTROL = np.zeros(256, bool)
_CONTROL[[9, 10, 11, 12, 13, 32]] = True
_MARKS = _CONTROL.copy()
_MARKS[[x for x in range(128) if not chr(x).isalnum()]] = True


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application: they need not share the driver's Python path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerspark-"), "ledgerspark_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where everything is one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="ledgerspark-")


class Scratch:
    """Intermediate tables of one operator in the shared folder.

    A stored table cuts the lineage: a lost executor costs the tasks since the last table. The shuffle files of
    the job that wrote a table are removed with it, so the disk holds one step's shuffle at a time. ``drop``
    removes tables that no returned DataFrame reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            rows.write.option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield start, stop
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row (null: none), and where each text starts, with the end last."""
    data = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    if not len(data) or data.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(data) + 1, np.int64)
    return np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of some texts: ``count`` of each text, and two lanes of 64-bit codes of the words in order, ``codes`` and
    ``codes2``.

    ``lower`` puts A-Z in lower case; ``plain`` puts all letters in lower case, and ASCII marks end a word and belong
    to none. A word's code is the sum of a mix of each byte with its place in the word, which no pattern of bytes cancels;
    the second lane adds up another mix.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, plain: bool = False) -> None:
        data, starts = text_bytes(pc.utf8_lower(texts) if plain else texts)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = ~(_MARKS if plain else _CONTROL)[data]
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | first[1:-1]
        self.begins = np.flatnonzero(begin)
        self.ends = np.flatnonzero(stop) + 1
        self.data = data
        self.firsts = np.searchsorted(self.begins, starts)
        self.count = np.diff(self.firsts)
        self.lengths = self.ends - self.begins
        self._inside = inside
        self.codes = self._lane(False)

    def _lane(self, second: bool) -> np.ndarray:
        if not len(self.begins):
            return np.zeros(0, np.uint64)
        offsets = np.cumsum(self.lengths) - self.lengths
        units = np.arange(1, self.lengths.sum() + 1) - np.repeat(offsets, self.lengths)
        units <<= 8
        units |= self.data[self._inside]
        terms = mixed(units.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if second:
            terms = mixed(terms + np.uint64(0xD1342543DE82EF95))
        return mixed(np.add.reduceat(terms, offsets) + self.lengths.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))

    @cached_property
    def codes2(self) -> np.ndarray:
        return self._lane(True)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


def gram_codes(codes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """64-bit codes of all runs of n codes, by their first one; they run on over the ends of texts.

    Each place of a run has a factor of its own, as those of a polynomial would let words in certain patterns cancel.
    """
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    places = np.arange(1, n + 1, dtype=np.uint64) + np.uint64((seed + 1) << 32)
    out = np.zeros(size, np.uint64)
    for i, factor in enumerate(mixed(places * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)):
        out += codes[i : i + size] * factor
    return mixed(out)


def components(scratch: Scratch, name: str, links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b): component is the smallest node within reach.

    Large-star and small-star steps in turn: each is a grouped minimum and a join, stored after each round, until the
    links form stars. The minimum is combined map-side, so a node with very many links is not one task's work; such
    a node's rows are a join key, which adaptive execution splits.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Hands the neighbours of each node to the smallest of them: the larger ones, or the smaller ones."""
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both if large else both.where("b < a")
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = around.join(scratch.store(f"{name}-least-{uuid.uuid4().hex[:8]}", least), "a")
        if large:
            out = joined.where("b > a").select(F.col("m").alias("a"), "b")
        else:
            own = least.where("m < a").select(F.col("m").alias("a"), F.col("a").alias("b"))
            out = joined.select(F.col("m").alias("a"), "b").union(own)
        return out.where("a < b").distinct()

    edges = scratch.store(f"{name}-0", links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    def stars(edges: DataFrame) -> bool:
        """Whether every larger node has one link and no node is on both sides: then the smaller ones are the answer."""
        inner = edges.select(F.col("b").alias("a")).distinct()
        return (edges.join(inner, "a", "left_semi").isEmpty()
                and edges.groupBy("b").agg(F.count("*").alias("c")).where("c > 1").isEmpty())

    turn = 0
    while not stars(edges):
        turn += 1
        large = scratch.store(f"{name}-l{turn}", star(edges, True))
        edges = scratch.store(f"{name}-{turn}", star(large, False))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
