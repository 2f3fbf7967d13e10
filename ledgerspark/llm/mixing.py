"""Operator 3: mix sources to target weights by fitting a subset sum of document lengths."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, word_count

#: Words of remaining budget that dynamic programming fits exactly.
EXACT_WORDS = 1 << 16


def subset_counts(lengths: list[int], counts: list[int], budget: int, exact: int = EXACT_WORDS) -> list[int]:
    """How many documents of each length to take, so that their words come as near below ``budget`` as found.

    The same share of each length comes first, rounded down; then single documents from the longest length down
    while more than ``exact`` words are open; the rest is a bounded knapsack over the lengths that are left, whose
    reachable sums are bits of one integer.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, take))
    order = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    for i in order:
        if left <= exact:
            break
        more = min(counts[i] - take[i], -((exact - left) // lengths[i]), left // lengths[i])
        take[i] += more
        left -= more * lengths[i]
    bound = min(left, exact)
    mask, reach, items, steps = (1 << (bound + 1)) - 1, 1, [], []
    for i in order:
        free, piece = min(counts[i] - take[i], bound // lengths[i]), 1
        while free > 0 and not reach >> bound & 1:
            piece = min(piece, free)
            items.append((i, piece))
            steps.append(reach)
            reach |= reach << piece * lengths[i] & mask
            free, piece = free - piece, piece * 2
    at = reach.bit_length() - 1
    for (i, piece), before in zip(reversed(items), reversed(steps)):
        if not before >> at & 1:
            take[i] += piece
            at -= piece * lengths[i]
    return take


def source_targets(sources: DataFrame, total: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """Adds weight and target to one row per source (none_last, source, source_size).

    Targets share ``total`` of all sizes by weight and stop at ``cap`` times the source's size; what is over goes to
    the others by weight until none is above. That is one level times the weight, or the cap: with sources
    ordered by cap per weight, the level follows from running sums.
    """
    place = Window.orderBy("none_last", "source")
    number = F.row_number().over(place) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "none_last", "source")
    before = F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    here = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    all_rows = Window.partitionBy()
    rows = rows.withColumn("level", (total * F.sum("source_size").over(all_rows) - before) / here)
    open_row = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first(open_row, ignorenulls=True).over(whole))
    share = F.coalesce(F.col("level") * F.col("weight"), F.col("most"))
    return rows.select("none_last", "source", "source_size", "weight", F.least("most", share).alias("target"))


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    size, target = int(rows.source_size.iloc[0]), float(rows.target.iloc[0])
    whole = int(target // size) if size else 0
    rest = max(0, round(target) - whole * size) if whole < 2 else 0
    rows = rows.sort_values("size")
    chosen = subset_counts([int(n) for n in rows["size"]], [int(n) for n in rows.n_docs], rest)
    return pd.DataFrame({"none_last": rows.none_last, "source": rows.source, "size": rows["size"],
                         "whole": whole, "chosen": chosen})


def mix_sources(documents: DataFrame, *, total: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = (5, 2, 1),
                seed: int = 7) -> DataFrame:
    """How often each document enters the mix: doc_id, size, source_size, target, taken, source, copies.

    A source is taken whole as often as its target allows (``copies`` 0, 1 or 2), and the remaining budget is fitted
    over its counts of documents by exact length; of each length the documents with the smallest seeded hash are
    chosen. Only counts by source and length meet in one task. A length's documents are ranked in
    1,024 ranges of their hash, so that one length with a third of all documents is not one task's work. The
    source table, one row per source, is ordered in one task.

    Null text has size 0; null source is a source, the last one; null and repeated ids are documents like others (equal
    rows are interchangeable); an empty table gives no rows. Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    key = ["none_last", "source"]
    sized = scratch.store("sized", documents.select(
        "doc_id", F.col("source").isNull().alias("none_last"), F.coalesce("source", F.lit("")).alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"),
    )).withColumn("range", F.shiftrightunsigned("draw", 54))
    parts = scratch.store("parts", sized.groupBy(*key, "size", "range").agg(F.count("*").alias("n_docs")))
    lengths = parts.groupBy(*key, "size").agg(F.sum("n_docs").alias("n_docs"))
    sources = lengths.groupBy(*key).agg(F.sum(F.col("size") * F.col("n_docs")).alias("source_size"))
    targets = scratch.store("targets", source_targets(sources, total, cap, weights))
    chosen = scratch.store("chosen", lengths.join(targets, key).groupBy(*key).applyInPandas(
        _fit, "none_last boolean, source string, size long, whole long, chosen long"))
    earlier = Window.partitionBy(*key, "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    quota = (parts.withColumn("before", F.coalesce(F.sum("n_docs").over(earlier), F.lit(0)))
             .join(chosen, [*key, "size"]).join(targets, key)
             .select(*key, "size", "range", "before", "whole", "chosen", "source_size", "target"))
    within = F.row_number().over(Window.partitionBy(*key, "size", "range").orderBy("draw", "doc_id"))
    copies = F.col("whole") + (F.col("before") + F.col("place") <= F.col("chosen")).cast("long")
    return (sized.withColumn("place", within)
            .join(scratch.store("quota", quota), [*key, "size", "range"])
            .select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                    F.when(~F.col("none_last"), F.col("source")).alias("source"), copies.alias("copies")))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{folder}/documents.parquet"))
