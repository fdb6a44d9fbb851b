"""Exact top-k search: query tiles times candidate tiles, a partial selection per product, a tree of merges.

Every candidate tile meets every query tile in a task of its own. The task multiplies in blocks, keeps the k best of
each query so far, and emits k rows per query and tile; merges then combine ``FAN`` tiles at a time, so no task sees
more than FAN * k rows of a query. Scores are whole numbers: products run in floating point only where every sum stays
below 2^53, in exact integers beyond.

Defined cases: vectors that are null or hold a null, a NaN or an infinity take no part, nor do rows without an id;
vectors of different lengths have no product; a row never meets rows of its own id; a repeated query row gets its own
list; repeated candidates are listed each. Scores beyond 64 bits are cut to the ends of that range after ranking.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import settled

SCALE = 256
TILE = 8192
BLOCK = 1024
FAN = 16
_LOW = np.iinfo(np.int64).min
FOUND = "query_row bigint, query_id bigint, tile int, vec_id bigint, score bigint"


def usable(vector: Column) -> Column:
    """Whether every component is a finite number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole_numbers(vectors: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as a matrix of floating point numbers."""
    return np.floor(scale * np.stack(vectors.to_numpy()).astype(np.float64))


def best_of(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (-1: none) and scores of each query's best candidates. ``c_ids`` ascend, so ties go to the left."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if not most < 2**50:
        return _best_of_large(q, q_ids, c, c_ids, k)
    place = np.arange(BLOCK)
    pos, score = [], []
    for i in range(0, len(q), BLOCK):
        part, own_ids = q[i : i + BLOCK], q_ids[i : i + BLOCK, None]
        best_pos = best_score = np.empty((len(part), 0), np.int64)
        for j in range(0, len(c), BLOCK):
            block = c[j : j + BLOCK]
            # falls with the score, then with the place: no two are equal
            key = (part @ block.T).astype(np.int64) * BLOCK + (BLOCK - 1 - place[: len(block)])
            key[own_ids == c_ids[None, j : j + BLOCK]] = _LOW
            skip = len(block) - min(k, len(block))
            top = np.argpartition(key, skip, axis=1)[:, skip:] if skip else np.broadcast_to(place[: len(block)], key.shape)
            key = np.take_along_axis(key, top, 1)
            best_pos = np.concatenate([best_pos, np.where(key == _LOW, -1, top + j)], 1)
            best_score = np.concatenate([best_score, key // BLOCK], 1)
            order = np.lexsort((best_pos, -best_score, best_pos < 0), axis=1)[:, :k]
            best_pos, best_score = np.take_along_axis(best_pos, order, 1), np.take_along_axis(best_score, order, 1)
        pos.append(best_pos)
        score.append(best_score)
    return np.concatenate(pos), np.concatenate(score)


def _best_of_large(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same in whole numbers of any size, for components that floating point could not multiply exactly."""
    pos = np.full((len(q), min(k, len(c))), -1, np.int64)
    score = np.zeros(pos.shape, np.int64)
    rows = [[int(x) for x in r] for r in c]
    for i, vector in enumerate(q):
        own = [int(x) for x in vector]
        found = ((-sum(x * y for x, y in zip(own, r)), p) for p, r in enumerate(rows) if c_ids[p] != q_ids[i])
        for n, (s, p) in enumerate(heapq.nsmallest(k, found)):
            pos[i, n], score[i, n] = p, min(max(-s, _LOW), -(_LOW + 1))
    return pos, score


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE, tile: int = TILE, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k best other rows."""
    rows = vectors.select(F.col(ident).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = settled(rows.withColumn("n", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    asked = rows.where(F.col("id") % every == 0)
    n_rows, n_asked = rows.count(), asked.count()
    # enough tiles to keep a cluster busy, none above the bound; each side travels once per tile of the other
    c_tiles, q_tiles = max(-(-n_rows // tile), min(64, -(-n_rows // 512)), 1), max(1, -(-n_asked // tile))
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    left = rows.select("id", "v", "n", (spread % c_tiles).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(q_tiles - 1))).alias("q"))
    right = asked.select(
        F.col("id").alias("q_id"), F.col("v").alias("q_v"), F.col("n").alias("q_n"), F.col("row").alias("q_row"),
        (spread % q_tiles).cast("int").alias("q_q"), F.explode(F.sequence(F.lit(0), F.lit(c_tiles - 1))).alias("q_c"),
    )

    def multiply(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({name: [] for name in ("query_row", "query_id", "tile", "vec_id", "score")})
        c = c.sort_values("id", kind="stable")
        ids, q_ids = c["id"].to_numpy(), q["q_id"].to_numpy()
        pos, score = best_of(whole_numbers(q["q_v"], scale), q_ids, whole_numbers(c["v"], scale), ids, k)
        at, rank = np.nonzero(pos >= 0)
        return pd.DataFrame(
            {
                "query_row": q["q_row"].to_numpy()[at],
                "query_id": q_ids[at],
                "tile": np.full(len(at), c["c"].iloc[0], np.int32),
                "vec_id": ids[pos[at, rank]],
                "score": score[at, rank],
            }
        )

    found = left.groupBy("n", "c", "q").cogroup(right.groupBy("q_n", "q_c", "q_q")).applyInPandas(multiply, FOUND)
    while c_tiles > 1:
        c_tiles = -(-c_tiles // FAN)
        found = found.withColumn("tile", F.floor(F.col("tile") / FAN).cast("int"))
        best = Window.partitionBy("query_row", "tile").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
