"""Cross-product sums of lagged regressors: what least squares on a long series needs from it.

Each (series, chunk) is reduced to one small matrix by numpy inside its task; the matrices are then added up.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.ordered import CHUNK, HALO, Series, framed_chunks

BLOCK = 20_000
GRAM_CHUNK_ROWS = 500_000

# (values in order, number of series rows) -> (first row with a full design, design of a block of rows)
Design = Callable[[np.ndarray, int, int, int], np.ndarray]


def lag_sums(
    df: DataFrame,
    series: Series,
    col: str,
    reach: int,
    lead_in: Callable[[int], int],
    design: Design,
    split: bool | None = None,
    rows_per_chunk: int = GRAM_CHUNK_ROWS,
) -> DataFrame:
    """One row per series: ``gram`` (flattened X'X) and ``n_used``.

    ``df`` carries ``row_no`` and ``n_rows``. ``lead_in(n_rows)`` rows at the series start have no complete design.
    ``design(values, start, stop, n_rows)`` gives the design rows of positions start..stop-1.
    """
    keys = list(series.keys)
    slim = framed_chunks(df, series, reach, split, rows_per_chunk).select(*keys, CHUNK, HALO, "row_no", "n_rows", F.col(col).cast("double").alias("_x"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keys).schema.fields)

    def reduce(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_no", kind="stable")
        values = pdf["_x"].to_numpy()
        n_rows = int(pdf["n_rows"].iloc[0])
        need = lead_in(n_rows)
        usable = np.flatnonzero(~pdf[HALO].to_numpy() & (pdf["row_no"].to_numpy() > need))
        if len(usable) == 0:
            return pd.DataFrame({k: pd.Series([], dtype=object) for k in [*keys, "gram", "n_used"]})
        first, last = int(usable[0]), int(usable[-1]) + 1  # own rows are contiguous
        total = None
        for a in range(first, last, BLOCK):
            x = design(values, a, min(a + BLOCK, last), n_rows)
            part = x.T @ x
            total = part if total is None else total + part
        row = dict(zip(keys, group)) | {"gram": total.ravel().tolist(), "n_used": last - first}
        return pd.DataFrame([row])

    parts = slim.groupBy(*keys, CHUNK).applyInPandas(
        lambda group, pdf: reduce(group[:-1], pdf), f"{key_schema}, gram array<double>, n_used long"
    )
    cells = parts.select(*keys, "n_used", F.posexplode("gram").alias("_i", "_g"))
    summed = cells.groupBy(*keys, "_i").agg(F.sum("_g").alias("_g"), F.sum("n_used").alias("_n"))
    return summed.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_g"))), lambda s: s["_g"]).alias("gram"),
        F.max("_n").alias("n_used"),
    )


def solve(gram: np.ndarray, cols: list[int], target: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients, residual sum of squares and inverse normal matrix for a subset of columns.

    Columns are scaled to unit length first, which keeps the small solve well conditioned.
    """
    scale = np.sqrt(np.maximum(np.diag(gram)[cols], 1e-300))
    a = gram[np.ix_(cols, cols)] / np.outer(scale, scale)
    b = gram[cols, target] / scale
    inv = np.linalg.pinv(a)
    beta = inv @ b
    ssr = float(gram[target, target] - b @ beta)
    return beta / scale, max(ssr, 0.0), inv / np.outer(scale, scale)


def nested_ssr(gram: np.ndarray, target: int, least: int) -> np.ndarray:
    """Residual sums of squares of the target on the first ``least``, least + 1, ... of the columns before it.

    One factorisation serves all of them: each further column takes the square of one more entry of the solved target.
    """
    scale = np.sqrt(np.maximum(np.diag(gram)[: target + 1], 1e-300))
    a = gram[: target + 1, : target + 1] / np.outer(scale, scale)
    # columns that the ones before them explain take nothing away
    factor = np.zeros((target, target))
    solved = np.zeros(target)
    for j in range(target):
        v = a[j, j] - factor[j, :j] @ factor[j, :j]
        if v <= 1e-13:
            continue
        factor[j, j] = math.sqrt(v)
        factor[j + 1 :, j] = (a[j + 1 : target, j] - factor[j + 1 :, :j] @ factor[j, :j]) / factor[j, j]
        solved[j] = (a[target, j] - solved[:j] @ factor[j, :j]) / factor[j, j]
    rest = a[target, target] - np.cumsum(solved**2)
    return np.maximum(rest[least - 1 :], 0.0) * scale[target] ** 2
