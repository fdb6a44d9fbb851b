"""Cross products of lagged values for a whole series and for each of its regimes, from one pass over the rows.

A scope is the whole series (``GLOBAL``) or one of its regimes, which must be contiguous in time. Every (series, chunk),
with the rows before it that lags reach, is reduced by numpy to one small matrix per scope; the matrices are then added up.
The matrix of the whole series is the sum of those of its regimes and of the border rows whose lags cross into the regime
before, so it costs no second pass. Nothing needs row numbers: a row is complete if the row ``reach`` places before it
lies in the same scope, and the first ``reach`` values of a scope travel along for designs with shorter lags.

Differences of any order are linear in lagged values, so their cross products follow from the same matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.lagsums import BLOCK, GRAM_CHUNK_ROWS
from driftline.operators.ordered import CHUNK, HALO, Series, framed_chunks
from driftline.session import join_same, pin, settle

GLOBAL = "GLOBAL"
SCOPE = "scope"


def scope_rows(df: DataFrame, series: Series, col: str, regime: str | None = None) -> DataFrame:
    """Known values, less the mean of their series, with the name of their regime."""
    keys = list(series.keys)
    named = F.col(regime).cast("string") if regime else F.lit(None).cast("string")
    known = df.where(F.col(col).isNotNull()).select(*keys, *dict.fromkeys((series.ts, *series.tie)), named.alias(SCOPE), F.col(col).cast("double").alias("_v"))
    known = settle(known)
    means = pin(known.groupBy(*keys).agg(F.avg("_v").alias("_mean")))
    return join_same(known, means, keys).withColumn("_v", F.col("_v") - F.col("_mean")).drop("_mean")


def scope_sizes(rows: DataFrame, series: Series) -> DataFrame:
    """(keys, scope, n) for the whole series and its regimes."""
    keys = list(series.keys)
    parts = rows.groupBy(*keys, SCOPE).agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy(*keys).agg(F.sum("n").alias("n")).select(*keys, F.lit(GLOBAL).alias(SCOPE), "n")
    return whole.unionByName(parts.where(F.col(SCOPE).isNotNull()))


def spans(names: np.ndarray, own: np.ndarray) -> list[tuple[str, int, int, int]]:
    """(scope, first row, first own row, past the last row) of the scopes that own rows of a chunk belong to."""
    first, past = int(own[0]), int(own[-1]) + 1  # own rows are contiguous
    out = [(GLOBAL, 0, first, past)]
    cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
    for a, b in zip(cuts, cuts[1:]):
        if names[a] is not None and max(a, first) < min(b, past):
            out.append((names[a], a, max(a, first), min(b, past)))
    return out


def products(x: np.ndarray) -> np.ndarray:
    return sum((x[a : a + BLOCK].T @ x[a : a + BLOCK] for a in range(0, len(x), BLOCK)), np.zeros((x.shape[1], x.shape[1])))


def lagged(values: np.ndarray, start: int, stop: int, lags: Sequence[int]) -> np.ndarray:
    """Rows (1, values at each lag) of positions start..stop-1."""
    out = np.ones((stop - start, len(lags) + 1))
    for j, k in enumerate(lags):
        out[:, j + 1] = values[start - k : stop - k]
    return out


# (scope, values of the scope from its first row in the frame, first own row, extra) -> rows (variant, matrix, rows in it)
Reduce = Callable[[str, np.ndarray, int, dict], list[tuple[str, np.ndarray, int]]]


def reduce_scopes(
    rows: DataFrame,
    series: Series,
    reach: int,
    reduce: Reduce,
    extra: DataFrame | None = None,
    split: bool | None = None,
    rows_per_chunk: int = GRAM_CHUNK_ROWS,
) -> DataFrame:
    """(keys, scope, variant, gram, n_used, head): matrices of ``reduce`` added up per scope, and its first values.

    ``extra`` has rows (keys, scope, variant, given) whose arrays the scope's calls of ``reduce`` get by variant; they travel as one
    more row per chunk, so the table of all series is never collected.
    """
    keys, order = list(series.keys), list(dict.fromkeys((series.ts, *series.tie)))
    framed = framed_chunks(rows, series, reach, split, rows_per_chunk).select(*keys, CHUNK, HALO, *order, SCOPE, "_v")
    if extra is not None:
        framed = settle(framed)
        places = framed.where(~F.col(HALO)).select(*keys, CHUNK, F.explode(F.array(F.lit(GLOBAL), F.col(SCOPE))).alias(SCOPE)).distinct()
        given = join_same(places, extra, [*keys, SCOPE]).select(*keys, CHUNK, SCOPE, "variant", "given")
        framed = framed.unionByName(given, allowMissingColumns=True)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in framed.select(*keys).schema.fields)
    names = [*keys, SCOPE, "variant", "gram", "n_used", "places", "head"]

    def run(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        known: dict[str, dict] = {}
        if "given" in pdf:
            told = pdf["variant"].notna()
            for scope, variant, given in zip(pdf.loc[told, SCOPE], pdf.loc[told, "variant"], pdf.loc[told, "given"]):
                known.setdefault(scope, {})[variant] = np.asarray(given, float)
            pdf = pdf[~told]
        pdf = pdf.sort_values(order, kind="stable")
        values = pdf["_v"].to_numpy(float)
        regimes = pdf[SCOPE].astype(object).where(pdf[SCOPE].notna(), None).to_numpy()
        found = []
        for scope, a, first, past in spans(regimes, np.flatnonzero(~pdf[HALO].to_numpy(bool))):
            # fewer rows in front than lags reach: the scope starts in this frame
            head = range(first - a, min(past - a, reach)) if first - a < reach else range(0)
            at, lead = list(head), [float(values[a + i]) for i in head]
            for variant, gram, n in reduce(scope, values[a:past], first - a, known.get(scope, {})):
                found.append((*group[: len(keys)], scope, variant, gram.ravel().tolist(), n, at, lead))
        return pd.DataFrame(found, columns=names)

    kinds = f"{key_schema}, {SCOPE} string, variant string, gram array<double>, n_used bigint, places array<int>, head array<double>"
    parts = settle(framed.groupBy(*keys, CHUNK).applyInPandas(run, kinds))
    by = [*keys, SCOPE, "variant"]
    cells = parts.select(*by, F.posexplode("gram").alias("_i", "_g")).groupBy(*by, "_i").agg(F.sum("_g").alias("_g"))
    grams = cells.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_g"))), lambda s: s["_g"]).alias("gram"))
    # at most ``reach`` values per scope
    firsts = F.flatten(F.collect_list(F.transform("places", lambda p, i: F.struct(p.alias("p"), F.get("head", i).alias("v")))))
    counts = parts.groupBy(*by).agg(F.sum("n_used").alias("n_used"), F.transform(F.array_sort(firsts), lambda s: s["v"]).alias("head"))
    return join_same(grams, counts, by)


def lag_matrices(rows: DataFrame, series: Series, lags: Sequence[int], split: bool | None = None, rows_per_chunk: int = GRAM_CHUNK_ROWS) -> DataFrame:
    """Cross products of (1, values at ``lags``) over the rows of each scope that have them all."""
    lags, reach = list(lags), max(lags)

    def reduce(scope: str, values: np.ndarray, first: int, _: dict) -> list[tuple[str, np.ndarray, int]]:
        start = max(first, reach)
        x = lagged(values, start, max(start, len(values)), lags)
        return [("", products(x), len(x))]

    return reduce_scopes(rows, series, reach, reduce, None, split, rows_per_chunk).drop("variant")


def difference_weights(d: int, sd: int = 0, m: int = 0) -> np.ndarray:
    """Weights of lags 0, 1, ... in ``d`` repeated differences and ``sd`` at lag ``m``."""
    out = np.ones(1)
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(sd):
        out = np.convolve(out, np.r_[1.0, np.zeros(m - 1), -1.0])
    return out


def mapped(gram: np.ndarray, lags: Sequence[int], columns: Sequence[np.ndarray]) -> np.ndarray:
    """Cross products of (1, columns), each column given by its weights of lags 0, 1, ..., from those of (1, lags)."""
    at = {k: j + 1 for j, k in enumerate(lags)}
    a = np.zeros((len(columns) + 1, len(lags) + 1))
    a[0, 0] = 1.0
    for i, weights in enumerate(columns):
        for k in np.flatnonzero(weights):
            a[i + 1, at[int(k)]] = weights[k]
    return a @ gram @ a.T


def shifted(weights: np.ndarray, k: int) -> np.ndarray:
    return np.r_[np.zeros(k), weights]
