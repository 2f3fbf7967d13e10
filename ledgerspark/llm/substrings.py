"""Operator 4: repeated passages by compaction of a de Bruijn graph of word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, Words, _powers, gram_codes, mixed, slices

#: Words of a window: an edge of the graph, from its first 19 words to its last 19.
WINDOW = 20
#: Words of the grams among which a window's minimizer is the one with the least code.
GRAM = 6
_BASE = 0xC2B2AE3D27D4EB4F | 1


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Pieces:
    """The windows of some texts, cut into paths of consecutive windows with one minimizer.

    The minimizer and its place in the window follow from the window's words alone, so equal windows lie at
    equal places of paths with equal minimizers. ``text``, ``at`` (word), ``n`` (windows), ``minimizer``,
    ``digest`` and ``digest2`` (of all words of the path, by their two codes) describe the paths.
    """

    def __init__(self, texts: pa.Array) -> None:
        words = self.words = Words(texts)
        codes = words.codes
        grams = gram_codes(codes, GRAM)
        self.text = self.at = self.n = np.zeros(0, np.int64)
        self.minimizer = self.digest = self.digest2 = np.zeros(0, np.uint64)
        if len(codes) < WINDOW:
            return
        value, place = grams, np.arange(len(grams))
        width, most = 1, WINDOW - GRAM + 1
        while width < most:
            step = min(width, most - width)
            right, at = value[step:], place[step:]
            left = value[: len(right)]
            less = right < left
            value, place = np.where(less, right, left), np.where(less, at, place[: len(right)])
            width += step
        # The windows that lie within one text.
        owner = words.owner()
        begin = np.arange(len(codes) - WINDOW + 1)
        begin = begin[owner[begin] == owner[begin + WINDOW - 1]]
        if not len(begin):
            return
        mine = place[begin]
        new = np.ones(len(begin), bool)
        new[1:] = (np.diff(begin) > 1) | (np.diff(mine) != 0) | (np.diff(owner[begin]) != 0)
        first = np.flatnonzero(new)
        start, mine = begin[first], mine[first]
        self.start = start
        self.n = np.diff(np.append(first, len(begin)))
        self.text = owner[start]
        self.at = start - words.firsts[self.text]
        self.minimizer = grams[mine]
        length = self.n + WINDOW - 1
        back = _powers(pow(_BASE, -1, 1 << 64), len(codes))[start]
        cut = (length * 64 + mine - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)

        def digest(lane: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(lane) + 1, np.uint64)
            np.cumsum(lane * _powers(_BASE, len(lane)), out=sums[1:])
            return mixed((sums[start + length] - sums[start]) * back + cut)

        self.digest, self.digest2 = digest(codes), digest(words.codes2)


def pieces_of(documents: DataFrame, minimizers_only: bool = False) -> DataFrame:
    """The paths of all texts: minimizer, and unless only that is wanted digest, digest2, doc_id, at, n."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for start, stop in slices(batch.column(1)):
                p = Pieces(batch.column(1).slice(start, stop - start))
                columns = {"minimizer": signed(p.minimizer)}
                if not minimizers_only:
                    columns |= {"digest": signed(p.digest), "digest2": signed(p.digest2), "doc_id": pa.array(ids[start:stop][p.text]),
                                "at": pa.array(p.at.astype(np.int32)), "n": pa.array(p.n.astype(np.int32))}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "minimizer long" if minimizers_only else "minimizer long, digest long, digest2 long, doc_id long, at int, n int"
    return documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(cut, schema)


def windows_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Two codes (a, b: one from each lane), doc_id and place of each window in the wanted stretches (doc_id, spans of (at, n))."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans = batch.column(0).to_numpy(), batch.column(2)
            for start, stop in slices(batch.column(1)):
                words = Words(batch.column(1).slice(start, stop - start))
                a, b = gram_codes(words.codes, WINDOW, 1), gram_codes(words.codes2, WINDOW, 2)
                places, owners = [], []
                for i, own in enumerate(spans.slice(start, stop - start).to_pylist()):
                    most = words.count[i] - WINDOW + 1
                    found = [np.arange(x["at"], min(x["at"] + x["n"], most)) for x in own]
                    places.append(np.concatenate(found))
                    owners.append(np.full(len(places[-1]), i))
                at, owner = np.concatenate(places), np.concatenate(owners)
                index = words.firsts[owner] + at
                yield pa.RecordBatch.from_pydict({
                    "a": signed(a[index]), "b": signed(b[index]), "doc_id": pa.array(ids[start:stop][owner]),
                    "at": pa.array(at.astype(np.int32))})

    return (documents.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "text", "spans")
            .mapInArrow(cut, "a long, b long, doc_id long, at int"))


def compacted(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Joins paths that follow one another both in the copy and in the source.

    ``edges``: doc_id, at, n, source_id, source_at. A path without a predecessor is a head, one without a successor a
    tail; between the k-th head and the k-th tail of an alignment lies one unbranched path.
    """
    key = ["doc_id", "source_id", "shift"]
    rows = scratch.store("edges", edges.select("doc_id", "at", (F.col("at") + F.col("n")).alias("stop"), "source_id",
                                               (F.col("at") - F.col("source_at")).alias("shift")))
    ends = rows.select(*key, F.col("stop").alias("at"))
    starts = rows.select(*key, F.col("at").alias("stop"))
    order = Window.partitionBy(*key)
    heads = rows.join(ends, [*key, "at"], "left_anti").select(*key, "at").withColumn("k", F.row_number().over(order.orderBy("at")))
    tails = rows.join(starts, [*key, "stop"], "left_anti").select(*key, "stop").withColumn("k", F.row_number().over(order.orderBy("stop")))
    return heads.join(tails, [*key, "k"]).select(
        "doc_id", "at", (F.col("stop") - F.col("at")).alias("n"), "source_id", (F.col("at") - F.col("shift")).alias("source_at"))


def repeated_spans(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """Maximal runs of windows that repeat an earlier run: doc_id, at, n (windows), source_id, source_at.

    1. Minimizers that occur once belong to windows that occur once; only the others go on.
    2. Equal paths (same minimizer and digests) are collapsed: all but the first in document order repeat it.
    3. Where paths with one minimizer differ, the windows of the first of each are compared one by one.
    4. What was found is compacted into runs along source coordinates.
    """
    same = ["minimizer", "digest", "digest2"]
    counts = pieces_of(documents, minimizers_only=True).groupBy("minimizer").agg(F.count("*").alias("c"))
    repeated = scratch.store("repeated", counts.where("c > 1").select("minimizer"))
    pieces = scratch.store("pieces", pieces_of(documents).join(repeated, "minimizer"))
    paths = scratch.store("paths", pieces.groupBy(*same).agg(
        F.min(F.struct("doc_id", "at")).alias("first"), F.max("n").alias("n"), F.count("*").alias("c")))
    sources = paths.where("c > 1").select(*same, F.col("first.doc_id").alias("source_id"), F.col("first.at").alias("source_at"))
    later = F.struct("doc_id", "at") > F.struct("source_id", "source_at")
    whole = scratch.store("whole", pieces.join(scratch.store("sources", sources), same).where(later)
                          .select("doc_id", "at", "n", "source_id", "source_at"))
    mixed_up = scratch.store("mixed", paths.groupBy("minimizer").agg(F.count("*").alias("c")).where("c > 1").select("minimizer"))
    unclear = paths.join(mixed_up, "minimizer").select(F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"), "n")
    wanted = unclear.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    windows = scratch.store("windows", windows_of(documents, wanted))
    firsts = windows.groupBy("a", "b").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("c")).where("c > 1")
    firsts = scratch.store("firsts", firsts.select("a", "b", F.col("first.doc_id").alias("source_id"), F.col("first.at").alias("source_at")))
    single = windows.join(firsts, ["a", "b"]).where(later).select("doc_id", "at", F.lit(1).alias("n"), "source_id", "source_at")
    spans = scratch.store("spans", compacted(scratch, whole.union(single)))
    scratch.drop("repeated", "pieces", "paths", "sources", "whole", "mixed", "windows", "firsts", "edges")
    return spans


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Removes each word that a window covers whose words also start earlier: doc_id, n_words, n_removed,
    kept_sha256 and kept (the text that stays).

    Earlier means a smaller doc_id, or the same document and an earlier start. Windows are compared by two
    64-bit codes, each from codes of their own of all their words. Null and empty texts have no words. A row without doc_id has no place in the order
    and stays whole. Rows that share a doc_id and a place are the same occurrence: neither repeats the other; what
    is found for a doc_id holds for all its rows. Empty tables give no rows; other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "substrings")
    spans = repeated_spans(scratch, documents)
    by_document = spans.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("spans"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, sums, kept = [], [], [], []
            for text, own in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                own = own.as_py()
                total = len(words)
                if own:
                    edge = np.zeros(total + 1, np.int64)
                    at = np.array([x["at"] for x in own])
                    stop = at + np.array([x["n"] for x in own]) + WINDOW - 1
                    np.add.at(edge, np.minimum(at, total), 1)
                    np.add.at(edge, np.minimum(stop, total), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
                left = b" ".join(words)
                counts.append(total)
                gone.append(total - len(words))
                sums.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums, pa.string()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return (documents.select("doc_id", "text").join(by_document, "doc_id", "left").select("doc_id", "text", "spans")
            .mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"))


def op4_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{folder}/documents.parquet")).drop("kept")


OP4_SQL = r"""
WITH w AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
),
windows AS (
    SELECT doc_id, i AS place, array_to_string(words[i:i + 19], ' ') AS passage
    FROM w, unnest(range(1, len(words) - 18)) t(i)
),
later AS (
    SELECT doc_id, place
    FROM (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) AS n FROM windows)
    WHERE n > 1
),
gone AS (SELECT doc_id, list(DISTINCT place + j) AS places FROM later, unnest(range(20)) t(j) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
"""
