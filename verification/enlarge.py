"""Writes a larger copy of the test tables: ``python verification/enlarge.py FOLDER OUT [TIMES] [FILES]``.

Orders, lineitem and events are repeated with keys of their own, and a third of the orders are given to one customer, so
that the facts grow and one key is hot. The other tables are copied as they are.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

GROWN = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
COPIED = ("region", "nation", "customer", "supplier", "part")


def enlarge(spark: SparkSession, folder: str, out: str, times: int = 12, files: int = 48) -> None:
    for name in COPIED:
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    for name, key in GROWN.items():
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        kind = dict(rows.dtypes)[key]
        copies = rows.crossJoin(F.broadcast(spark.range(times).withColumnRenamed("id", "_copy")))
        copies = copies.withColumn(key, (F.col(key) * times + F.col("_copy")).cast(kind)).drop("_copy")
        if name == "orders":
            hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast(dict(rows.dtypes)["o_custkey"]))
            copies = copies.withColumn("o_custkey", F.coalesce(hot, F.col("o_custkey")))
        copies.repartition(files).write.parquet(f"{out}/{name}.parquet")


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    session = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    enlarge(session, sys.argv[1], sys.argv[2], *map(int, sys.argv[3:5]))
