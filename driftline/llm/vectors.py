"""Near-duplicate vectors: randomised-rotation binary codes decide which pairs need their exact cosine.

Equal vectors are one node. Nodes go to the cell of the nearest centre; centres come from a sample of at most ``SAMPLE``
nodes (those with the smallest hashes): far-apart leaders, moved to the mean of what is nearest to them twice. Every node
is indexed. A node also visits the cells whose centre is almost as near as its own (``MARGIN``); a pair is compared where
one node is at home and the other one visits.

Code: the offset of a node from its cell's centre, turned by a fixed random rotation, keeps its signs, its length and the
correction factor <signs, offset>. The product of the signs with a visitor's turned offset, divided by the factor, estimates
the inner product without bias; its error is normal to good accuracy, with a deviation that the factor tells. Pairs whose
upper bound (``SURE`` deviations) on the cosine is below the threshold are dropped, the rest is computed again in double
precision. So no link is below the threshold, and misses come from cells that a pair does not share (about 1 % of
pairs right at the threshold, under 0.1 % at a cosine of 0.95) or from the tail of the bound; tests measure recall.

Dense groups: nodes within half the threshold angle of their cell's centre (the core) are linked with each other for
certain, by the triangle inequality on angles. They are counted per cell and linked by one chain, never compared with each other; a
visitor further from the centre than one and a half threshold angles cannot reach the core and does not meet it. What
remains meets in blocks of ``BLOCK`` home nodes and ``BLOCK`` visitors. A block pair returns one row per node with links: how
many it has there and the smallest node of its part. Pairs never leave their task.

Components come from rounds of minimum labels over these rows.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their
own component; vectors of different lengths do not link; a repeated row counts as another vector, under its own id;
a null id takes part, and names no component unless no other node of it has an id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import settled, small_side
from driftline.llm.neardup import components

COSINE = 0.9
SAMPLE = 32_768  # nodes that the centres are fitted on, at most
PER_CENTRE = 64  # sampled nodes per centre, at least: few nodes pull a centre towards themselves
APART = math.cos(math.radians(35))  # leaders are further apart than this
MARGIN = 0.1  # cosine by which a visited centre may be further than the own one
SURE = 3.0
BLOCK = 2048
SURE_SIDE = 1e-9  # angle left for rounding
SEED = 20


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision, scaled to a largest component of 1; None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for x in column:
        v = x.values if x.is_valid else None
        if v is None or len(v) == 0 or v.null_count:
            out.append(None)
            continue
        v = v.to_numpy().astype(np.float64)
        top = np.abs(v).max()
        out.append(v / top if 0 < top < np.inf else None)
    return out


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, size, unit): equal vectors have equal keys; ``unit`` is null for vectors that link with nothing."""
    for b in batches:
        keys, sizes, units = [], [], []
        for raw, v in zip(b.column(1), rows_of(b.column(1))):
            unit = None if v is None else v / np.linalg.norm(v)
            keys.append(None if v is None else xxhash.xxh3_128_digest(raw.values.to_numpy().astype(np.float64).tobytes()))
            sizes.append(None if v is None else len(v))
            units.append(None if v is None else unit.tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(units, pa.binary())], ["id", "key", "size", "unit"])


def matrix(column: pa.Array | pd.Series, size: int) -> np.ndarray:
    """Packed vectors as the rows of a matrix."""
    packed = column.to_pylist() if isinstance(column, pa.Array) else column
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, size)


def normal(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


@dataclass(frozen=True)
class Index:
    """Centres (unit rows) and the rotation of one vector length."""

    centres: np.ndarray
    rotation: np.ndarray

    def codes(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sign bits, lengths and correction factors of the offsets from the cells' centres."""
        offset = (x - self.centres[cell]) @ self.rotation
        length = np.linalg.norm(offset, axis=1)
        plus = offset > 0
        with np.errstate(invalid="ignore", divide="ignore"):
            factor = np.where(length > 0, np.abs(offset).sum(axis=1) / (length * math.sqrt(x.shape[1])), 1.0)
        return np.packbits(plus, axis=1), length, factor


def fit_index(sample: np.ndarray) -> Index:
    """Leaders at least ``APART`` from each other, moved to the means of the sampled nodes nearest to them."""
    size = sample.shape[1]
    most = max(1, len(sample) // PER_CENTRE)
    near = np.full(len(sample), -2.0)
    leaders: list[int] = []
    for i in range(len(sample)):
        if near[i] <= APART:
            leaders.append(i)
            near = np.maximum(near, sample @ sample[i])
            if len(leaders) == most:
                break
    centres = sample[leaders] if leaders else np.zeros((1, size))
    for _ in range(2):
        own = np.concatenate([np.empty(0, np.int64), *[(sample[k : k + BLOCK] @ centres.T).argmax(axis=1) for k in range(0, len(sample), BLOCK)]])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, normal(sums), centres)
    turned, _ = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return Index(centres, turned)


def upper_bounds(home: pd.DataFrame, turned: np.ndarray, far: np.ndarray, size: int) -> np.ndarray:
    """Upper bounds on the cosines of home nodes (rows) and visitors, from codes and the visitors' turned offsets."""
    bits = np.unpackbits(np.frombuffer(b"".join(home["code"]), np.uint8).reshape(len(home), -1), axis=1)[:, :size]
    length, factor = home["length"].to_numpy()[:, None], home["factor"].to_numpy()[:, None]
    unit = turned / np.where(far > 0, far, 1)[:, None]
    signs = (2.0 * bits - 1) / math.sqrt(size)
    estimate = (signs @ unit.T) / factor
    # the part of the signs that is not along the offset points anywhere else
    error = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(1, size - 1))
    inner = np.minimum(estimate + error, 1.0)
    # |x - y|^2 = |x - c|^2 + |y - c|^2 - 2 <x - c, y - c>, and 2 - 2 cos for unit vectors
    return 1 - (length**2 + far[None, :] ** 2 - 2 * length * far[None, :] * inner) / 2


def linked(home: pd.DataFrame, visits: pd.DataFrame, index: Index, cell: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs of a block that are counted in it."""
    size = index.centres.shape[1]
    x, y = matrix(home["unit"], size), matrix(visits["unit"], size)
    turned = (y - index.centres[cell]) @ index.rotation
    i, j = np.nonzero(upper_bounds(home, turned, np.linalg.norm(turned, axis=1), size) >= cosine)
    a, b = home["node"].to_numpy()[i], visits["node"].to_numpy()[j]
    own = visits["home"].to_numpy() == cell
    # both at home in loose blocks meet twice; so do pairs that visit each other's cells
    once = np.where(own[j], (home["core"].to_numpy()[i]) | (a < b), a < b)
    twice = own[j] | mutual(home["cells"].to_numpy(), visits["home"].to_numpy(), i, j)
    use = (a != b) & (once | ~twice)
    i, j = i[use], j[use]
    good = np.empty(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
        good[k : k + len(p)] = np.einsum("ij,ij->i", x[p], y[q]) >= cosine
    return i[good], j[good]


def mutual(cells: np.ndarray, homes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the home node of each pair visits the visitor's cell."""
    wide = max(map(len, cells), default=0)
    table = np.full((len(cells), max(1, wide)), -1, np.int64)
    for row, c in zip(table, cells):
        row[: len(c)] = c
    out = np.empty(len(i), bool)
    for k in range(0, len(i), 1 << 18):
        out[k : k + (1 << 18)] = (table[i[k : k + (1 << 18)]] == homes[j[k : k + (1 << 18)], None]).any(axis=1)
    return out


def parts_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position linked, directly or not, to each of n positions."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


FOUND = "node bigint, links bigint, label bigint"


def meet(shared, cosine: float):
    """Compare a block of home nodes with a block of visitors."""

    def run(key: tuple, home: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        if not len(home) or not len(visits):
            return pd.DataFrame({"node": [], "links": [], "label": []}, dtype=np.int64)
        visits = visits.rename(columns=lambda c: c.removeprefix("v_"))
        i, j = linked(home, visits, Index(*shared.value), int(key[0]), cosine)
        ids, at = np.unique(np.r_[home["node"].to_numpy(), visits["node"].to_numpy()], return_inverse=True)
        a, b = at[: len(home)][i], at[len(home) :][j]
        times = np.zeros(len(ids), np.int64)
        times[at] = np.r_[home["times"].to_numpy(), visits["times"].to_numpy()]
        links = np.bincount(a, times[b], len(ids)) + np.bincount(b, times[a], len(ids))
        label = parts_of(len(ids), a, b)
        own = links > 0
        return pd.DataFrame({"node": ids[own], "links": links[own].astype(np.int64), "label": ids[label[own]]})

    return run


def placed(nodes: DataFrame, shared, cosine: float) -> DataFrame:
    """Home cell, visited cells with the angles to their centres, core flag and code of every node."""
    half = math.acos(cosine) / 2 - SURE_SIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*shared.value)
        for b in batches:
            x = matrix(b.column(2), own.centres.shape[1])
            near = x @ own.centres.T
            home = near.argmax(axis=1)
            best = near[np.arange(len(x)), home]
            row, cell = np.nonzero(near >= best[:, None] - MARGIN)
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(x)))].astype(np.int32))
            code, length, factor = own.codes(x, home)
            made = [
                pa.array(home.astype(np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(cell.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(angles(near[row, cell]))),
                pa.array(angles(best) <= half),
                pa.array([c.tobytes() for c in code], pa.binary()),
                pa.array(length),
                pa.array(factor),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, "home", "cells", "angles", "core", "code", "length", "factor"])

    made = "home int, cells array<int>, angles array<double>, core boolean, code binary, length double, factor double"
    return nodes.select("node", "times", "unit").mapInArrow(run, f"node bigint, times bigint, unit binary, {made}")


def blocks(n: int) -> int:
    return max(1, -(-n // BLOCK))


def links_of(nodes: DataFrame, size: int, cosine: float) -> DataFrame:
    """(node, links, label) rows of nodes with vectors of one length, to be added up and joined up per node."""
    spark = nodes.sparkSession
    drawn = nodes.select(F.xxhash64("node").alias("h"), "unit").orderBy("h").limit(SAMPLE)
    sample = matrix(drawn.toPandas().sort_values("h")["unit"], size)
    index = fit_index(sample)
    shared = spark.sparkContext.broadcast((index.centres, index.rotation))  # at most SAMPLE / PER_CENTRE rows
    found = settled(placed(nodes, shared, cosine), "vectors-placed")

    # cores: linked among themselves, whatever their size; a cell is one row here
    cores = found.where("core").groupBy("home").agg(F.sum("times").alias("all"), F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
    cores = settled(cores, "vectors-cores")
    inside = found.where("core").join(small_side(cores), "home").where("n > 1")
    inside = inside.select("node", (F.col("all") - F.col("times")).alias("links"), F.col("least").alias("label"))

    # how many blocks each side of a cell needs: at most two rows per cell
    theta = math.acos(cosine)
    visits = found.select("node", "times", "unit", "home", F.col("core").alias("inner"), F.explode(F.arrays_zip("cells", "angles")).alias("v"))
    visits = visits.select("node", "times", "unit", "home", "inner", F.col("v.cells").alias("cell"), F.col("v.angles").alias("angle"))
    at_home = F.col("home") == F.col("cell")
    to_core = ~(at_home & F.col("inner")) & (F.col("angle") <= 1.5 * theta + SURE_SIDE)
    to_loose = ~(at_home & F.col("inner"))
    sides = F.array(F.when(to_core, F.lit(True)), F.when(to_loose, F.lit(False)))
    visits = visits.withColumn("core", F.explode(F.filter(sides, lambda s: s.isNotNull())))
    n_home = {(r["home"], r["core"]): r["n"] for r in found.groupBy("home", "core").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_visit = {(r["cell"], r["core"]): r["n"] for r in visits.groupBy("cell", "core").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(c, k, blocks(n), blocks(n_visit[c, k])) for (c, k), n in n_home.items() if (c, k) in n_visit]
    if not rows:
        return inside
    plan = F.broadcast(spark.createDataFrame(rows, "cell int, core boolean, n_home int, n_visit int"))

    def dealt(frame: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        spread = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(names[0])
        return frame.join(plan, ["cell", "core"]).select("*", spread, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1]))

    home = found.select(F.col("home").alias("cell"), "core", "node", "times", "unit", "cells", "code", "length", "factor")
    home = dealt(home, "n_home", "n_visit", ("h", "v")).drop("n_home", "n_visit")
    visits = dealt(visits, "n_visit", "n_home", ("v", "h")).drop("n_home", "n_visit", "angle", "inner")
    by = ["cell", "core", "h", "v"]
    visits = visits.select([F.col(c).alias(f"v_{c}") for c in visits.columns])
    return inside.unionByName(home.groupBy(*by).cogroup(visits.groupBy(*[f"v_{c}" for c in by])).applyInPandas(meet(shared, cosine), FOUND))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id) of every row: other vectors linked directly, smallest id linked directly or not."""
    if not 0 < cosine < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    kind = dict(vectors.dtypes)[ident]
    rows = vectors.select(F.col(ident).alias("id"), F.col(vector).alias("v")).mapInArrow(keyed, f"id {kind}, key binary, size int, unit binary")
    rows = settled(rows, "vectors-rows")
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("times"), F.first("size").alias("size"), F.first("unit").alias("unit")
    )
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors-nodes")
    parts = None
    for r in nodes.select("size").distinct().orderBy("size").collect():
        got = links_of(nodes.where(F.col("size") == r["size"]), r["size"], cosine)
        parts = got if parts is None else parts.unionByName(got)
    slim = nodes.select("node", "key", "first", "times")
    if parts is None:
        slim = slim.select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("first").alias("component"))
    else:
        parts = settled(parts, "vectors-links")
        counts = parts.groupBy("node").agg(F.sum("links").alias("links"))
        labels = components(parts.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b")))
        slim = slim.join(counts, "node", "left").join(labels, "node", "left")
        slim = slim.select("node", "key", "first", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("label", "node").alias("label"))
        slim = settled(slim, "vectors-labelled")
        least = slim.groupBy("label").agg(F.min("first").alias("component"))
        slim = slim.join(least, "label").select("key", "n_links", "component")
    out = rows.join(slim, "key", "left")
    return out.select(
        F.col("id").alias(ident),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )
