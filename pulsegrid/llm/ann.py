"""Nearest neighbours by largest inner product, exact.

Every query meets every block of rows, block by block; the blocks' best are merged. In a block, a matrix product gives
all inner products of a batch of queries at once, in single precision on scaled vectors; the ``k``-th largest of the
maxima of slices of ``SLICE`` vectors is a bound below each query's ``k``-th best, so only vectors at that bound or above
(less the product's rounding) are scored again with the measure itself, in double precision, row by row, and ranked. The result is the brute-force one.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components take no part.
Rows with a null id take no part either; a query's own id is not among its results. Fewer candidates than ``k``: all.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut

#: Queries whose inner products are taken together, and vectors of a slice whose maximum bounds the ``k``-th best.
TOGETHER, SLICE = 256, 32
#: Vectors of a block, and queries that meet it in one task, on average.
BLOCK, QUERIES = 16_384, 4_096


def sound(vec: Column) -> Column:
    """Vectors that take part."""
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def search(base: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, longest: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's ids and scores of its ``k`` best in this block."""
    n, dims = base.shape
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    whole, slices = n - n % SLICE, -(-n // SLICE)
    # In single precision on vectors scaled to length 1 at most; the product is off by less than (dims + 2) units in
    # the last place of single precision, the measure by far less.
    near = (base / longest).astype(np.float32)
    lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    margin = 4 * (dims + 2) * float(np.finfo(np.float32).eps) + float(np.finfo(np.float32).tiny)
    for first in range(0, len(queries), TOGETHER):
        asked = np.arange(first, min(first + TOGETHER, len(queries)))
        rough = near @ (queries[asked] / lengths[asked, None]).astype(np.float32).T
        # A query's own rows don't raise its bound.
        starts, ends = np.searchsorted(sorted_ids, query_ids[asked], "left"), np.searchsorted(sorted_ids, query_ids[asked], "right")
        for r, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            rough[order[a:b], r] = -np.inf
        if slices >= k:
            tops = rough[:whole].reshape(-1, SLICE, len(asked)).max(axis=1)
            if whole < n:
                tops = np.vstack([tops, rough[whole:].max(axis=0)])
            bound = np.partition(tops, slices - k, axis=0)[slices - k] - margin
        else:
            bound = np.full(len(asked), -np.inf, np.float32)
        cols, rows = np.nonzero((rough >= bound).T)
        for r, found in zip(asked.tolist(), np.split(rows, np.searchsorted(cols, np.arange(1, len(asked)))), strict=True):
            found = found[ids[found] != query_ids[r]]
            # Multiplied and summed row by row: equal vectors get equal scores.
            score = (base[found] * queries[r]).sum(axis=1)
            best = np.lexsort((ids[found], -score))[:k]
            yield r, ids[found][best], score[best]


def _meet(queries: pa.Table, base: pa.Table, longest: float, k: int) -> pa.Table:
    made = []
    if len(queries) and len(base):
        query_ids = queries["id"].to_numpy()
        made = list(search(matrix(base["vec"]), base["id"].to_numpy(), matrix(queries["vec"]), query_ids, longest, k))
    query = np.concatenate([np.full(len(i), query_ids[q]) for q, i, _ in made]) if made else np.zeros(0, np.int64)
    ids = np.concatenate([i for _, i, _ in made]) if made else np.zeros(0, np.int64)
    score = np.concatenate([s for _, _, s in made]) if made else np.zeros(0)
    return pa.table({"query_id": query, "vec_id": ids, "score": score})


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best found for each row where ``is_query`` holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), is_query.alias("query"))
    rows = cut(rows.where(F.col("id").isNotNull() & sound(F.col("vec"))), "vectors")
    dims = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if dims is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == dims["dims"])
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, n_queries, longest = rows.agg(F.count("*"), F.count(F.when(F.col("query"), 1)), F.sqrt(F.max(squares))).first()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERIES))
    mix = F.xxhash64("id", "vec")
    base = rows.select("id", "vec", F.pmod(mix, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    queries = rows.where("query").select("id", "vec", F.pmod(mix, F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    found = queries.groupBy("block", "part").cogroup(base.groupBy("block", "part")).applyInArrow(lambda q, b: _meet(q, b, longest, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
