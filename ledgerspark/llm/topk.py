"""Operator 2: exact top-k search with bounds from segment statistics, coarse to fine."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch

#: Rows and queries that meet in one task; the work is cut into cells of this size at every scale.
CELL_ROWS = 4096
CELL_QUERIES = 512
#: Segments of a vector at each resolution.
SEGMENTS = (4, 16)

_LONG = 1 << 63


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of whole numbers as doubles; a shorter vector is filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def segment_features(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and standard deviations of each segment, weighted by the root of its length.

    For two vectors the distance within a segment of length n is at least n * (difference of means squared +
    difference of deviations squared). With the norms known, that bound on the distance is the bound
    dot(features, features) on the inner product.
    """
    edges = np.linspace(0, rows.shape[1], min(segments, max(rows.shape[1], 1)) + 1).astype(int)
    out = []
    for start, stop in zip(edges, edges[1:]):
        part = rows[:, start:stop]
        out += [part.mean(1) * np.sqrt(stop - start), part.std(1) * np.sqrt(stop - start)]
    return np.stack(out, 1) if out else np.zeros((len(rows), 1))


def exact_scores(rows: np.ndarray, query: np.ndarray, safe: bool) -> np.ndarray:
    """Integer inner products; beyond 64 bits they stop at the ends of the range."""
    if safe:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = [sum(int(a) * b for a, b in zip(row, whole)) for row in rows]
    return np.array([min(max(x, -_LONG), _LONG - 1) for x in sums], np.int64)


def cell_top(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a cell for each of its queries, without those that cannot be among a query's best."""
    width = max([0, *map(len, queries.vector), *map(len, rows.vector)])
    ids, own = rows.vec_id.to_numpy(), queries.vec_id.to_numpy()
    q, c = matrix(queries.vector, width), matrix(rows.vector, width)
    long_q, long_c = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
    safe = bool(long_q.max() * long_c.max() < 2.0**52)
    # What rounding may add to a bound.
    slack = 1e-9 * (long_q[:, None] * long_c.max()) + 1e-6
    levels = [(segment_features(q, s), segment_features(c, s)) for s in SEGMENTS]
    coarse = levels[0][0] @ levels[0][1].T + slack
    found = []
    for i, least in enumerate(queries.least.to_numpy()):
        left = np.flatnonzero((coarse[i] >= least) & (ids != own[i]))
        bound = coarse[i][left]
        for features, others in levels[1:]:
            if len(left):
                bound = np.minimum(bound, others[left] @ features[i] + slack[i])
                left, bound = left[bound >= least], bound[bound >= least]
        if len(left) > k:
            # The k rows with the highest bounds give a floor that the others' bounds must reach.
            first = np.argpartition(-bound, k - 1)[:k]
            floor = exact_scores(c[left[first]], q[i], safe).min()
            left = left[bound >= floor]
        scores = exact_scores(c[left], q[i], safe)
        best = np.lexsort((ids[left], -scores))[:k] if safe else np.array(
            sorted(range(len(left)), key=lambda j: (-int(scores[j]), ids[left[j]]))[:k], int)
        found.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[left[best]], "score": scores[best]}))
    out = pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return out.astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k rows of ``vectors`` (vec_id, vector of whole numbers) with the highest inner product for each query.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id, and a row never answers its own
    id. Rows and queries are cut into cells of bounded size; each row is sent once for every CELL_QUERIES queries. The
    best scores in the first cell of rows are a floor for the other cells.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.store("rows", vectors.select("vec_id", "vector", F.monotonically_increasing_id().alias("at")))
    asked = scratch.store("asked", queries.select("vec_id", "vector", F.monotonically_increasing_id().alias("at")))
    n_rows, n_asked = -(-max(rows.count(), 1) // CELL_ROWS), -(-max(asked.count(), 1) // CELL_QUERIES)
    rows = rows.select("vec_id", "vector", F.pmod(F.xxhash64("at"), F.lit(n_rows)).alias("r"))
    asked = asked.select("vec_id", "vector", F.pmod(F.xxhash64("at"), F.lit(n_asked)).alias("q"))

    def cells(asked: DataFrame, rows: DataFrame, parts) -> DataFrame:
        left = asked.withColumn("r", F.explode(parts)).groupBy("r", "q")
        right = rows.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)).cast("array<bigint>"))).groupBy("r", "q")

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            return cell_top(a, b, k)

        return left.cogroup(right).applyInPandas(meet, "query_id long, vec_id long, score long")

    floorless = asked.withColumn("least", F.lit(float("-inf")))
    seed = scratch.store("seed", cells(floorless, rows.where("r = 0"), F.array(F.lit(0).cast("long"))))
    floors = (seed.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
              .where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("low").cast("double").alias("floor")))
    floored = (asked.join(scratch.store("floors", floors), "vec_id", "left")
               .select("vec_id", "vector", "q", F.coalesce("floor", F.lit(float("-inf"))).alias("least")))
    others = F.sequence(F.lit(1), F.lit(n_rows - 1)).cast("array<bigint>") if n_rows > 1 else F.lit(None).cast("array<bigint>")
    found = seed.union(cells(floored, rows.where("r > 0"), others))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def whole_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, vector): components as floor(scale * x). Rows with a null vec_id or vector, or with a null or
    non-finite component, are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vector")))


def embedding_top_k(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """Top k of all rows for the rows whose vec_id is divisible by ``every``.

    Vectors of unequal length are compared as if filled up with zeros; scores beyond 64 bits stop at the end of the
    range. Rows that repeat a vec_id all stand as candidates, but one of them (the least vector) asks. Empty
    tables give no rows; other columns are not read.
    """
    rows = whole_vectors(embeddings)
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return top_k(rows, queries, k)


def op2_embedding_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_top_k(spark.read.parquet(f"{folder}/embeddings.parquet"))


OP2_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
