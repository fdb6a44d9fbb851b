"""Linked vectors against all cosines."""

import math

import numpy as np
import pytest

from driftline.llm import vectors as v


def made(rng, families, alone, size=24, spread=0.25):
    """Families of different tightness around random directions, and rows on their own."""
    out = [rng.standard_normal((alone, size))]
    for i, n in enumerate(families):
        centre = rng.standard_normal(size)
        centre /= np.linalg.norm(centre)
        out.append(centre + rng.standard_normal((n, size)) * spread * (1 + i % 3) / 3 / math.sqrt(size) * 2)
    return np.concatenate(out)


def truth(x, cosine=0.9):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= cosine
    np.fill_diagonal(link, False)
    return link.sum(1), v.parts_of(len(x), *np.nonzero(link))


def run(corpus, rows, **kw):
    df = corpus.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string").repartition(4)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in v.near_vectors(df, **kw).collect()}


@pytest.mark.parametrize("cosine", [0.9, 0.8])
def test_recall_against_all_pairs(corpus, monkeypatch, cosine):
    monkeypatch.setattr(v, "BLOCK", 100)  # several blocks per cell
    x = made(np.random.default_rng(4), [400, 150, 90, 30, 30, 8, 2, 2], 300)
    got = run(corpus, [(i, r.tolist(), 0, "x") for i, r in enumerate(x)], cosine=cosine)
    links, parts = truth(x, cosine)
    mine = np.array([got[i][0] for i in range(len(x))])
    assert (mine <= links).all() and mine.sum() >= 0.98 * links.sum() and links.sum() > 10_000
    assert np.mean([got[i][1] == parts[i] for i in range(len(x))]) > 0.98


def test_recall_on_the_given_table(corpus):
    df = corpus.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], np.float64)
    links, parts = truth(x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in v.near_vectors(df).collect()}
    ids = [r["vec_id"] for r in rows]
    mine = np.array([got[i][0] for i in ids])
    assert (mine <= links).all() and mine.sum() >= 0.9 * links.sum()
    assert np.mean([got[i][1] == ids[p] for i, p in zip(ids, parts)]) > 0.99


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    size = 64
    centre = np.zeros((1, size))
    x = v.normal(rng.standard_normal((400, size)))
    y = v.normal(0.8 * x[:50] + 0.6 * v.normal(rng.standard_normal((50, size))))
    errors, inside = [], []
    for seed in range(20):
        turned, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
        index = v.Index(centre, turned)
        code, length, factor = index.codes(x, np.zeros(len(x), int))
        bits = np.unpackbits(code, axis=1)[:, :size]
        errors.append((((2.0 * bits - 1) / math.sqrt(size)) @ (y @ turned).T) / factor[:, None] - x @ y.T)
        home = {"code": [c.tobytes() for c in code], "length": length, "factor": factor}
        top = v.upper_bounds(v.pd.DataFrame(home), y @ turned, np.ones(len(y)), size)
        inside.append((top >= x @ y.T - 1e-9).mean())
    assert abs(np.mean(errors)) < 0.002 and np.mean(inside) > 0.998


def test_rows_that_link_with_nothing(corpus):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0, 0.0], 0, ""), (3, [2.0, 0.0, 0.0], 0, ""), (9, [1.0, 0.1, 0.0], 1, ""), (9, [0.0, 0.0, 1.0], 1, ""),
        (1, None, 0, ""), (2, [], 0, ""), (4, [0.0, 0.0, 0.0], 0, ""), (6, [None, 1.0, 0.0], 0, ""), (7, [nan, 1.0, 0.0], 0, ""),
        (8, [inf, 1.0, 0.0], 0, ""), (10, [1.0, 0.0], 0, ""), (None, [1.0, 0.0, 0.0], 0, ""), (None, None, 0, ""), (11, [1e300, 1e299, 0.0], 0, ""),
        (12, [0.0, 5e-324, 0.0], 0, ""), (13, [0.0, 1.0, -0.0], 0, ""),
    ]
    df = corpus.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in v.near_vectors(df).collect()), key=repr)
    want = [
        (5, 4, 3), (3, 4, 3), (9, 4, 3), (9, 0, 9), (1, 0, 1), (2, 0, 2), (4, 0, 4), (6, 0, 6), (7, 0, 7), (8, 0, 8), (10, 0, 10),
        (None, 4, 3), (None, 0, None), (11, 4, 3), (12, 1, 12), (13, 1, 12),
    ]
    assert got == sorted(want, key=repr)


def test_copies_and_empty_tables(corpus):
    got = run(corpus, [(i, [1.0, 2.0, 3.0], 0, "") for i in range(50)] + [(50, [3.0, -2.0, 1.0], 0, "")])
    assert [got[i] for i in range(50)] == [(49, 0)] * 50 and got[50] == (0, 50)
    assert run(corpus, []) == {}
    assert run(corpus, [(1, None, 0, "")]) == {1: (0, 1)}
    with pytest.raises(ValueError):
        run(corpus, [], cosine=1.0)
