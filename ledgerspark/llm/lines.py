"""Operator 8: repeated runs of lines by prefix doubling over line ids; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch

_BLANK = " \t\r\x0b\x0c"


def solid_places(text: Column) -> Column:
    """Where among the lines of a text those are that are not blank."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.when(F.btrim(x, F.lit(_BLANK)) != "", i))
    return F.coalesce(F.array_compact(lines), F.array().cast("array<int>"))


def lines_of(text: Column) -> Column:
    """The lines of a text, without blank ones."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_BLANK)) != "")


def repeated_runs(scratch: Scratch, documents: DataFrame, least: int) -> DataFrame:
    """Starts of runs of ``least`` lines or more that occur earlier too: doc_id, at, n (``least`` or a larger power of two),
    the longest for each start.

    A suffix is a document from one line on. Suffixes have equal ranks at a width if their first lines, that many, are
    equal: the intervals of the suffix array whose common prefix is that long. The rank of twice the width is that of the
    pair of ranks, so each level joins the suffixes with those one width on; ``least`` lines are two such stretches that
    overlap. A rank that only one suffix has ends there; the doubling stops when no rank is shared. Ranks are 64-bit codes,
    two of them, and no global sort is needed to tell equal prefixes apart. Within an interval all suffixes but the first in
    document order start a later copy. The longer runs of a start are covered by those of the lines after it, so that the
    copies of any maximal run are covered whole.
    """
    lines = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    lines = scratch.store("lines", lines.select("doc_id", "at", F.xxhash64("line").alias("rank"), F.xxhash64(F.lit(1), "line").alias("check")))

    def shared(width: int, suffixes: DataFrame) -> DataFrame:
        """Suffixes whose rank another one has, with the interval's first."""
        groups = suffixes.groupBy("rank", "check").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("c")).where("c > 1")
        groups = scratch.store(f"groups-{width}", groups.select("rank", "check", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at")))
        return scratch.store(f"shared-{width}", suffixes.join(groups, ["rank", "check"]))

    def longer(active: DataFrame, width: int, step: int) -> DataFrame:
        """Suffixes whose first ``width`` lines are shared, and those ``step`` on: the ranks of both together."""
        here = active.select("doc_id", "at", "rank", "check")
        ahead = active.select("doc_id", (F.col("at") - step).alias("at"), F.col("rank").alias("rank2"), F.col("check").alias("check2"))
        pairs = here.join(ahead.distinct(), ["doc_id", "at"]).select(
            "doc_id", "at", F.xxhash64("rank", "rank2").alias("rank"), F.xxhash64("check", "check2", F.lit(1)).alias("check"))
        return shared(width + step, scratch.store(f"pairs-{width + step}", pairs))

    def later(active: DataFrame, n: int) -> DataFrame:
        return active.where(F.struct("doc_id", "at") > F.struct("first_id", "first_at")).select("doc_id", "at", F.lit(n).alias("n"))

    active, width = shared(1, lines), 1
    found = lines.select("doc_id", "at", F.lit(0).alias("n")).where("false")
    while not active.isEmpty():
        if width >= least:
            found = found.union(later(active, width))
        elif 2 * width > least:
            found = found.union(later(longer(active, width, least - width), least))
        active, width = longer(active, width, width), 2 * width
    return found.groupBy("doc_id", "at").agg(F.max("n").alias("n"))


def remove_repeated_lines(documents: DataFrame, least: int = 1) -> DataFrame:
    """Deletes the later copies of all runs of ``least`` or more lines that occur earlier too: doc_id, n_lines, n_removed,
    longest_run (a lower bound: ``least`` or a larger power of two), kept_sha256 and kept (the lines that stay, joined by
    line ends).

    Earlier means a smaller doc_id, or the same document and an earlier line. Blank lines are not counted, neither end a run
    nor belong to one, and stay where they are. With ``least`` 1 a line that recurs alone goes too. Null and empty texts have
    no lines. A row without doc_id stays whole; rows that share a doc_id and a place are one occurrence, and what is found for
    a doc_id holds for all its rows. Empty tables give no rows; other columns are not read.
    """
    if least < 1:
        raise ValueError("a run has one line at least")
    scratch = Scratch(documents.sparkSession, "lines")
    runs = repeated_runs(scratch, documents, least)
    # Every line of a longer run but its last ones starts a run of ``least``, so the starts and the lines after them are all places.
    starts = runs.groupBy("doc_id").agg(F.collect_set("at").alias("starts"), F.max("n").alias("longest_run"))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda at: F.sequence(at, at + least - 1)))) if least > 1 else F.col("starts")
    starts = scratch.store("gone", starts.select("doc_id", gone.alias("gone"), "longest_run"))
    # What is removed grows with the corpus, so this is a shuffle at every size; texts are split behind it.
    rows = documents.select("doc_id", "text").join(starts.hint("merge"), "doc_id", "left").select(
        "doc_id", F.split("text", "\n", -1).alias("lines"), solid_places(F.col("text")).alias("solid"), "gone",
        F.coalesce("longest_run", F.lit(0)).cast("long").alias("longest_run"))
    rows = rows.withColumn("n_lines", F.size("solid").cast("long")).withColumn(
        "gone", F.transform(F.coalesce("gone", F.array().cast("array<int>")), lambda i: F.get("solid", i)))
    # What is found for a doc_id may lie beyond the end of another of its texts.
    rows = rows.withColumn("gone", F.array_intersect("solid", "gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.coalesce(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"), F.lit(""))
    return rows.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), "longest_run", kept.alias("kept")).select(
        "doc_id", "n_lines", "n_removed", "longest_run", F.sha2("kept", 256).alias("kept_sha256"), "kept")


def op8_repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_lines(spark.read.parquet(f"{folder}/documents.parquet")).drop("kept", "longest_run")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(string_split(text, chr(10)), []) AS parts FROM documents),
lines AS (
    SELECT doc_id, i AS place, parts[i] AS line
    FROM d, unnest(range(1, len(parts) + 1)) t(i)
    WHERE trim(parts[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS n FROM lines),
counted AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE n > 1) AS n_removed,
           coalesce(list(place) FILTER (WHERE n > 1), []) AS places
    FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(parts, lambda x, i: NOT list_contains(coalesce(places, []), i)), chr(10))) AS kept_sha256
FROM d LEFT JOIN counted ON d.doc_id = counted.doc_id
"""
