"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest
from pyspark.sql import types as T
from revrecon.llm.queries import REGISTRY
from revrecon.llm.whitening import bidiagonalise, blocks_of, differences, squares, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("deviation", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("x", T.StringType()),
    ]
)


def make(spark, rows):
    return spark.createDataFrame([(i, v, "extra", None, "x") for i, v in rows], SCHEMA)


def dense(z):
    def product(ps, q):
        r = z @ q
        return float(r @ r), (z @ ps).T @ r, z.T @ r

    return product


@pytest.mark.parametrize("case", ["plain", "equal values", "low rank", "one direction", "wide", "skewed"])
def test_bidiagonalisation_finds_the_singular_values(case):
    rng = np.random.default_rng(3)
    z = rng.normal(size=(300, 24))
    if case == "equal values":
        z = np.linalg.qr(z)[0] @ np.diag([9.0] * 5 + [4.0] * 10 + [1.0] * 9) @ np.linalg.qr(rng.normal(size=(24, 24)))[0]
    if case == "low rank":
        z = z[:, :4] @ rng.normal(size=(4, 24))
    if case == "one direction":
        z = np.outer(z[:, 0], rng.normal(size=24))
    if case == "wide":
        z = rng.normal(size=(7, 24))
    if case == "skewed":
        z = z * np.logspace(0, -6, 24)
    sigma, axes = bidiagonalise(dense(z), 24, 10, float(np.linalg.norm(z)))
    want = np.pad(np.linalg.svd(z, compute_uv=False), (0, 24))[:10]
    assert np.allclose(sigma, want, atol=1e-12 * want[0], rtol=0)
    assert np.allclose(axes.T @ axes, np.eye(10), atol=1e-13)
    assert np.allclose(np.linalg.norm(z @ axes, axis=0), want, atol=1e-12 * want[0])


def test_steps_stop_when_the_wanted_ones_are_found():
    rng, calls = np.random.default_rng(4), []
    z = rng.normal(size=(500, 60)) * np.array([50.0, 20.0, 10.0] + [0.01] * 57)
    one = dense(z)
    bidiagonalise(lambda ps, q: calls.append(1) or one(ps, q), 60, 3, float(np.linalg.norm(z)))
    assert len(calls) < 15


def check(rows, found, fitted, components):
    live = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max([len(v) for _, v in live] + [1])
    x = np.zeros((len(live), width), object)
    for r, (_, v) in enumerate(live):
        x[r, : len(v)] = [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]
        x[r, len(v) :] = 1_000_000
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    assert len(found) == n
    want = sorted((str(i), int((row * row).sum())) for (i, _), row in zip(live, d, strict=True))
    assert sorted((str(r.vec_id), int(r.deviation)) for r in found) == want
    z = (d / n).astype(float)
    covariance = z.T @ z / n
    values = np.linalg.eigvalsh(covariance)[::-1][: min(components, width)]
    assert np.allclose(fitted.variances, np.where(values > 1e-9 * max(values[0], 1e-300), values, 0), rtol=1e-9, atol=1e-12)
    assert np.allclose(covariance @ fitted.axes, fitted.axes * fitted.variances, atol=1e-10 * max(1.0, values[0]))
    if not fitted.live.any():
        assert all(v is None for r in found for v in r.whitened) and fitted.identity_error is None
        return
    assert np.allclose(fitted.explained, fitted.variances / np.trace(covariance), rtol=1e-12)
    w = np.array([[v for v, up in zip(r.whitened, fitted.live, strict=True) if up] for r in found])
    assert all((v is None) == (not up) for r in found for v, up in zip(r.whitened, fitted.live, strict=True))
    assert np.abs(w.mean(axis=0)).max() < 1e-10
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9 and fitted.identity_error < 1e-9
    ours = sorted(zip([str(r.vec_id) for r in found], [int(r.deviation) for r in found], w.round(6).tolist(), strict=True), key=repr)
    own = z @ fitted.axes[:, fitted.live] / np.sqrt(fitted.variances[fitted.live])
    theirs = sorted(zip([str(i) for i, _ in live], [int((row * row).sum()) for row in d], own.round(6).tolist(), strict=True), key=repr)
    for a, b in zip(ours, theirs, strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2], b[2], atol=2e-6)


def cases():
    rng = np.random.default_rng(5)
    many = [(i, (rng.normal(size=12) * np.linspace(0.2, 3, 12) + 1).tolist()) for i in range(300)]
    yield "many", many
    yield "odd", many[:40] + [(None, [0.5] * 12), (None, [0.5] * 12), (3, many[3][1]), (400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")] * 12), (404, []), (405, [2.0, -3.0])]
    yield "one row", [(1, [0.5, 2.0, 3.0])]
    yield "equal rows", [(i, [0.25] * 5) for i in range(9)]
    yield "fewer rows than components", many[:6]
    yield "only empty vectors", [(1, []), (2, [])]
    yield "large", [(i, [float(np.float32(1e12)) * i, float(-i), 1e9]) for i in range(50)]


@pytest.mark.parametrize("name, rows", list(cases()))
def test_whitened_rows_against_numpy(spark, name, rows):
    found, fitted = whiten(make(spark, rows), 8)
    check(rows, found.collect(), fitted, 8)


def test_an_empty_table(spark):
    found, fitted = whiten(make(spark, []))
    assert found.collect() == [] and fitted.n == 0


def test_differences_stay_exact_beyond_longs():
    x = np.array([[1 << 61, 3], [-(1 << 61), 5]], "<i8")
    d = differences(x.tobytes(), 2, 2, [0, 8])
    assert d.tolist() == [[1 << 62, -2], [-(1 << 62), 2]]
    assert squares(d).tolist() == [(1 << 124) + 4] * 2


def test_blocks_do_not_depend_on_long_batches(spark, monkeypatch):
    monkeypatch.setattr("revrecon.llm.whitening.BLOCK", 30)
    blocks, width = blocks_of(make(spark, [(i, [float(i), 1.0, 2.0]) for i in range(95)]))
    rows = blocks.collect()
    assert width == 3 and max(len(r.ids) for r in rows) == 10 and sum(len(r.ids) for r in rows) == 95


def test_the_query_returns_a_row_per_component(spark):
    df = REGISTRY["op12_whitening"](spark, SF)
    rows = df.collect()
    n = rows[0].n
    assert len(rows) == 32 * n and {r.component for r in rows} == set(range(1, 33))
    assert max(r.identity_error for r in rows) < 1e-4
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
