"""Exact top-k inner products by pivot-table elimination.

Every vector stores its distances to a few pivots. For a query q and a candidate x the largest
``|d(q, p) - d(x, p)|`` over the pivots is a lower bound on their distance, hence with the norms an upper
bound on their inner product. Candidates are evaluated in the order of that bound until it falls below
the k-th best score found. Queries and candidates meet in blocks, and each block of candidates
contributes at most k rows for a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 16
CANDIDATES = 8192  # of a block
QUERIES = 2048
STEP = 256  # candidates evaluated between two looks at the bound


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """row (a row number of its own), vec_id and v: floor(scale * x) of each component as long.

    Left out: vectors that are NULL or hold NULL or non-finite components, and rows without an id.
    """
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf")))
    )
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), usable.alias("ok"))
        .where("ok")
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.transform("x", lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v"),
        )
    )


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector is filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _distances(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * a @ pivots.T, 0))


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, pivots: int = PIVOTS) -> pd.DataFrame:
    """The k best candidates of the block for each query, the query's own row aside."""
    empty = pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
    if not len(queries) or not len(candidates):
        return empty
    width = max(map(len, [*queries.v, *candidates.v]))
    order = np.lexsort((candidates.row.to_numpy(), candidates.vec_id.to_numpy()))
    ids, rows = candidates.vec_id.to_numpy()[order], candidates.row.to_numpy()[order]
    x = _matrix(candidates.v.to_numpy()[order], width)
    q = _matrix(queries.v.to_numpy(), width)
    # pivots spread over the block: each the candidate farthest from those before it
    chosen = [0]
    nearest = np.full(len(x), np.inf)
    while len(chosen) < min(pivots, len(x)):
        nearest = np.minimum(nearest, _distances(x, x[chosen[-1:]])[:, 0])
        chosen.append(int(nearest.argmax()))
    table, asked = _distances(x, x[chosen]), _distances(q, x[chosen])
    norms, own = (x * x).sum(1), (q * q).sum(1)
    out = []
    for i in range(len(q)):
        lower = np.zeros(len(x))
        for p in range(len(chosen)):
            np.maximum(lower, np.abs(table[:, p] - asked[i, p]), out=lower)
        bound = (own[i] + norms - lower * lower) / 2
        bound += 1e-9 * (own[i] + norms) + 1e-6  # rounding of the roots
        by_bound = np.argsort(-bound, kind="stable")
        best_score, best_at = np.empty(0), np.empty(0, "int64")
        for start in range(0, len(x), STEP):
            part = by_bound[start : start + STEP]
            if len(best_score) == k and bound[part[0]] < best_score[-1]:
                break
            part = part[rows[part] != queries.row.iat[i]]
            scores = np.concatenate([best_score, x[part] @ q[i]])
            places = np.concatenate([best_at, part])
            top = np.lexsort((places, -scores))[:k]  # places are in the order of vec_id
            best_score, best_at = scores[top], places[top]
        out.append(
            pd.DataFrame(
                {
                    "query_row": queries.row.iat[i],
                    "query_id": queries.vec_id.iat[i],
                    "vec_id": ids[best_at],
                    "score": best_score.astype("int64"),
                }
            )
        )
    return pd.concat([empty, *out])


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best inner products for every row whose id is
    divisible by ``every``, over every row but its own; all, if there are fewer. Ties go to the smaller id.

    Vectors that are NULL, or hold NULL or non-finite components, and rows without an id take no part.
    Repeated rows are candidates and queries of their own. Scores are exact below 2^53.
    """
    table = scaled(vectors, id_col, vector_col)
    counts = table.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")
    ).first()
    blocks, asked = -(-counts["n"] // CANDIDATES) or 1, -(-counts["q"] // QUERIES) or 1
    spread = F.xxhash64("vec_id", "row")
    held = table.withColumn("c", F.pmod(spread, F.lit(blocks)).cast("int"))
    held = held.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))
    wanted = table.where(F.col("vec_id") % every == 0)
    wanted = wanted.withColumn("b", F.pmod(spread, F.lit(asked)).cast("int"))
    wanted = wanted.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        return search_block(rows[rows.asks], rows[~rows.asks], k, pivots)

    columns = ["b", "c", "row", "vec_id", "v"]
    both = wanted.select(*columns, F.lit(True).alias("asks")).unionAll(held.select(*columns, F.lit(False).alias("asks")))
    found = both.groupBy("b", "c").applyInPandas(cell, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
