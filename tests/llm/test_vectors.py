"""Vector search and near copies of vectors against all pairs in numpy."""

import numpy as np
import pytest
from checks.compare import difference, duck
from pyspark.sql import types as T
from revrecon.llm.embedding_dedup import Interval, join_intervals, near_vectors, unit
from revrecon.llm.queries import ORACLES, REGISTRY
from revrecon.llm.topk_search import Best, Tree, top_products, visit

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("row", T.StringType())]
)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)


def padded(rows):
    width = max((len(v) for _, v in rows if usable(v)), default=1)
    return [(i, np.pad(np.array(v, np.float32).astype(np.float64), (0, width - len(v))) if usable(v) else None) for i, v in rows]


def brute_top(rows, every=20, k=20):
    rows, out = padded(rows), []
    points = [(i, np.floor(64 * v)) for i, v in rows if v is not None]
    for n, (q, v) in enumerate(points):
        if q is not None and q % every == 0:
            scored = sorted((-int(v @ w), i is None, i or 0) for m, (i, w) in enumerate(points) if m != n)[:k]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scored)]
    return sorted(out, key=repr)


def brute_near(rows, cosine=0.95):
    rows = padded(rows)
    live = [n for n, (_, v) in enumerate(rows) if v is not None and v.any()]
    linked = {n: set() for n in range(len(rows))}
    if live:
        u = unit(np.array([rows[n][1] for n in live]))
        for a, b in zip(*np.nonzero(u @ u.T >= cosine), strict=True):
            if a != b:
                linked[live[a]].add(live[b])
    out = []
    for n, (i, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in linked[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        least = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, len(linked[n]), least, i == least))
    return sorted(out, key=repr)


def odd_rows(n, dim):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(12, dim))
    rows = [(i, (centres[i % 12] * rng.uniform(0.5, 2) + rng.normal(size=dim) * rng.choice([0.02, 0.25, 0.8])).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(40)] + [(20, rows[3][1]), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(5000, None), (5020, []), (5040, [float("nan")] * dim), (5060, [None] + [1.0] * (dim - 1)), (5080, [float("inf")] + [0.0] * (dim - 1))]
    return rows + [(6000, [0.0] * dim), (6020, [1.0, 2.0]), (6040, [2.0, 4.0]), (6060, [-0.0, 0.0, 1e-30])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def tuples(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("n", "dim"), [(700, 16), (30, 3)])
def test_both_on_odd_vectors(spark, n, dim):
    rows = odd_rows(n, dim)
    vectors = frame(spark, rows)
    assert tuples(top_products(vectors), "query_id", "rank", "vec_id", "score") == brute_top(rows)
    assert tuples(near_vectors(vectors), "vec_id", "n_links", "component_id", "kept") == brute_near(rows)


def test_both_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert difference(REGISTRY["op5_topk_search"](spark, SF), duck(SF), ORACLES["op5_topk_search"]) is None
    got = REGISTRY["op6_embedding_dedup"](spark, SF)
    assert tuples(got, "vec_id", "n_links", "component_id", "kept") == brute_near(rows)


def test_no_vectors(spark):
    for rows in ([], [(20, None)], [(20, [1.0])]):
        vectors = frame(spark, rows)
        assert top_products(vectors).count() == 0
        assert tuples(near_vectors(vectors), "vec_id", "n_links", "component_id", "kept") == brute_near(rows)


def test_boxes_skip_leaves_and_lose_nothing():
    rng = np.random.default_rng(2)
    points = np.floor(64 * (rng.normal(size=(20, 4))[rng.integers(0, 20, 3000)] * 3 + rng.normal(size=(3000, 4)) * 0.1))
    queries, none = points[:50], np.full(50, -1)
    best = Best(50, 5)
    ids = np.arange(3000)
    products = visit(Tree(points, 32), ids, ids, queries, none, best)
    assert products < 0.5 * queries.shape[0] * len(points)
    want = np.sort(queries @ points.T, axis=1)[:, ::-1][:, :5]
    assert (best.score.reshape(50, 5) == want).all()


def test_intervals_find_all_pairs():
    rng = np.random.default_rng(8)
    v = unit(rng.normal(size=(30, 8))[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 8)) * 0.15)
    v = v[np.lexsort(np.floor(v[:, :3] / 0.3162).T[::-1])]
    a, b = Interval(v[:700], np.eye(8)), Interval(v[700:], np.eye(8))
    got = {(i, j + 700) for i, j in zip(*join_intervals(a, b, 0.95), strict=True)} | set(zip(*join_intervals(a, a, 0.95), strict=True))
    want = {(i, j) for i, j in zip(*np.nonzero(v @ v.T >= 0.95), strict=True) if i < j and i < 700}
    assert got == want


def test_large_components_score_exactly(spark):
    rng = np.random.default_rng(17)
    rows = [(0, [1.0, 0.0, 0.0]), (1, [600_000.0, 0.0, 0.0]), (2, [700_000.0, 0.0, 0.0]), (3, [800_000.0, 0.0, 0.0])]
    rows += [(i, rng.integers(-2_000_000, 2_000_000, 3).astype(float).tolist()) for i in range(4, 80)]
    rows += [(i, [2_000_000.0, 2_000_000.0 - (i % 3) / 64, -1_999_999.0]) for i in range(80, 100)]  # differ beyond 53 bits
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_products(df).collect())
    ints = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in v]) for i, v in rows]
    want = []
    for q, v in ints:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints if i != q)[:20]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert [r[2] for r in got[:3]] != [1, 2, 3]


def test_components_beyond_any_score_are_held(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0], "x"), (1, [1e30, 2.0], "x"), (2, [-1e30, 2.0], "x")], SCHEMA)
    rows = sorted((r.rank, r.vec_id) for r in top_products(df).collect())
    assert rows == [(1, 1), (2, 2)]
