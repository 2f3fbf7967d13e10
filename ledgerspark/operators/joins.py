"""The two left joins of the model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies made from one intermediate row; larger counts are spread over several rows first.
COPIES_PER_ROW = 65_536


def effective_dated_join(
    rows: DataFrame,
    mapping: DataFrame,
    as_of: date,
    values: dict[str, str],
    id_column: str = "account_id",
    system_column: str = "source_system",
    valid_from: str = "effective_from",
    valid_to: str = "effective_to",
) -> DataFrame:
    """Left join to the mapping rows valid on ``as_of`` (both ends included), systems compared without case.

    ``values`` maps mapping columns to output names. Ranges that overlap on the day give one row each.

    The day filter and the column list reach the mapping scan. No broadcast is forced: Spark broadcasts the
    mapping when its size allows. Beyond that, one left join shuffles each side once; a hot account is on the left,
    which adaptive execution splits, and few mapping rows of an account are valid on a day.
    """
    day = F.lit(as_of.isoformat()).cast("date")
    valid = mapping.where(day.between(F.col(valid_from), F.col(valid_to))).select(
        F.col(id_column).alias("_mapped_id"),
        F.upper(system_column).alias("_mapped_system"),
        *[F.col(name).alias(out) for name, out in values.items()],
    )
    same = (F.col(id_column) == F.col("_mapped_id")) & (F.upper(system_column) == F.col("_mapped_system"))
    return rows.join(valid, same, "left").drop("_mapped_id", "_mapped_system")


def repeat_per_match(rows: DataFrame, other: DataFrame, row_id: Column, other_id: str) -> DataFrame:
    """The result of a left join whose right columns are all dropped: a row is repeated once per match.

    Only counts per id are joined, so the large side is aggregated before its shuffle and a hot id costs one
    number per map task. A row without id has no match and passes by the joins; a row with one match or none meets the
    ids of several matches in an anti join and is not moved again. Only rows with several matches are cut into
    pieces, which are spread over all partitions by the whole row; the number of partitions is set because a piece is
    tiny before it is expanded and would be coalesced with others.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        other.where(F.col(other_id).isNotNull())
        .groupBy(F.col(other_id).cast("string").alias("_other_id"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    names = rows.columns
    several = counts.where("_copies > 1")
    with_id = rows.where(row_id.isNotNull()).withColumn("_row_id", row_id.cast("string"))
    same = F.col("_row_id") == F.col("_other_id")
    once = with_id.join(several.select("_other_id"), same, "left_anti").select(*names)
    last_piece = F.floor((F.col("_copies") - 1) / COPIES_PER_ROW)
    pieces = with_id.join(several, same).select(
        *names, "_copies", F.explode(F.sequence(F.lit(0), last_piece)).alias("_piece")
    ).repartition(partitions, F.xxhash64(*names, "_piece"))
    size = F.least(F.lit(COPIES_PER_ROW), F.col("_copies") - F.col("_piece") * COPIES_PER_ROW).cast("int")
    copied = pieces.select(*names, F.explode(F.sequence(F.lit(1), size)).alias("_copy")).select(*names)
    return once.unionByName(copied).unionByName(rows.where(row_id.isNull()))
