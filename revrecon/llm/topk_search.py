"""Exact search for the highest inner products: a KD-tree per shard, leaves visited best first."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revrecon.llm.common import settle, spans, table
from revrecon.llm.vectors import matrix, packed

#: Vectors of a shard and of a leaf, queries of a block, and shards that one task visits in turn for a block.
SHARD, LEAF, BLOCK, LANE = 8192, 128, 512, 16
#: Leaves that a query visits between two updates of its kth score.
STRIDE = 4
#: Sums of products below this size are exact in double precision; larger ones are taken in 64-bit integers.
EXACT = 1 << 53


def limit(width: int) -> int:
    """The largest component for which no product of two vectors of that width can leave 64 bits."""
    return isqrt(((1 << 63) - 1) // width)


def numbers_of(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width)


def fitting(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the type in which their products are exact."""
    largest = int(np.abs(points).max(initial=0)) * int(np.abs(queries).max(initial=0)) * points.shape[1]
    kind = np.float64 if largest < EXACT else np.int64
    return points.astype(kind), queries.astype(kind)


class Tree:
    """Points in leaf order, each leaf with its tight box. Medians of the widest dimension part the leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order, todo, leaves = [], [np.arange(len(points))], []
        while todo:
            part = todo.pop()
            if len(part) <= leaf:
                leaves.append((len(order), len(order) + len(part)))
                order += part.tolist()
                continue
            values = points[part]
            axis = int(np.argmax(values.max(axis=0) - values.min(axis=0)))
            middle = len(part) // 2
            half = np.argpartition(values[:, axis], middle)
            todo += [part[half[middle:]], part[half[:middle]]]
        self.order, self.leaves = np.array(order, np.int64), leaves
        self.points = points[self.order]
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in leaves])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in leaves])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No point of leaf l has a higher product with query q than bounds[q, l]."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.kth = np.full(n, np.iinfo(np.int64).min)

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        q, s, i = (np.concatenate(p) for p in ((self.query, query), (self.score, score.astype(np.int64)), (self.id, id_)))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.query, self.score, self.id = q[keep], s[keep], i[keep]
        last = place == self.k - 1
        self.kth[q[last]] = s[last]


def visit(tree: Tree, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, best: Best) -> int:
    """Takes the leaves of each query from the highest bound down, until the bound is below its kth score.

    That is the order in which a heap over the tree's boxes would give them out. All queries of the block go side by
    side, so a leaf is multiplied with all that want it. Returns the number of products.
    """
    ids, rows = ids[tree.order], rows[tree.order]
    bounds = tree.bounds(queries)
    turn, done, products = np.argsort(-bounds, axis=1, kind="stable"), 0, 0
    active = np.arange(len(queries))
    while len(active) and done < turn.shape[1]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        nxt = turn[active, done : done + STRIDE]
        wanted = bounds[active[:, None], nxt] >= best.kth[active][:, None]
        pairs = np.stack([np.repeat(active, nxt.shape[1])[wanted.ravel()], nxt.ravel()[wanted.ravel()]])
        pairs = pairs[:, np.argsort(pairs[1], kind="stable")]
        for lo, hi in spans(pairs[1]):
            a, b = tree.leaves[pairs[1, lo]]
            q = pairs[0, lo:hi]
            scores = queries[q] @ tree.points[a:b].T
            products += scores.size
            good = (scores >= best.kth[q][:, None]) & (rows[None, a:b] != own[q][:, None])
            x, y = np.nonzero(good)
            found.append((q[x], scores[x, y], ids[a:b][y]))
        if found:
            best.add(*(np.concatenate(p) for p in zip(*found, strict=True)))
        done += STRIDE
        if done < turn.shape[1]:
            active = active[bounds[active, turn[active, done]] >= best.kth[active]]
    return products


def top_products(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for rows whose vec_id is divisible by ``every`` the ``k`` rows with the highest
    inner product of floor(64 * x), ties to the smaller vec_id.

    The vectors are dealt to shards of about ``SHARD`` rows, each a KD-tree; queries go in blocks of ``BLOCK``. A task
    takes a block through up to ``LANE`` shards and hands the kth score on from one to the next, so later shards show
    only leaves whose boxes reach it. Shards and blocks meet by the shard's number; the best of a query's lanes are
    merged at the end.

    Null vectors and those that hold null or non-finite components take no part. Shorter vectors count as padded with
    zeros. Scores are exact integers. Floors beyond :func:`limit` (3.8e8 at 64 dimensions), where a score could leave 64
    bits, are held there. Rows are told apart by their place, so rows with equal vec_id are
    candidates of each other and each a query. A null vec_id is no query and comes last among ties.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    held, width = packed(rows, "row long, vec_id long")
    held = settle(held, "vectors")
    shards = max(1, -(-held.count() // SHARD))
    lanes = -(-shards // LANE)
    no_id = np.iinfo(np.int64).max

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["vec_id"].fillna(no_id).to_numpy(np.int64)
        with np.errstate(over="ignore"):
            points = np.clip(np.floor(64 * matrix(pdf["v"], width)), -limit(width), limit(width)).astype("<i8")
        kind = "<i4" if np.abs(points).max() < 1 << 31 else "<i8"
        rows = pdf["row"].to_numpy(np.int64).tobytes()
        return pd.DataFrame([(int(pdf["part"].iloc[0]), ids.tobytes(), rows, kind, points.astype(kind).tobytes())], columns=["part", "ids", "rows", "kind", "points"])

    shape = "part int, ids binary, rows binary, kind string, points binary"
    filled = held.withColumn("vec_id", F.coalesce("vec_id", F.lit(no_id)))
    corpus = settle(filled.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).groupBy("part").applyInPandas(pack, shape), "shards")
    asked = filled.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != no_id))
    blocks = max(1, -(-asked.count() // BLOCK))
    queries = asked.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).groupBy("part").applyInPandas(pack, shape)
    spread = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns], F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"))
    met = spread.join(corpus, "part").withColumn("lane", F.col("part") % lanes)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, best, ids = None, None, None

        def result() -> pd.DataFrame:
            own_rows, own_ids = ids
            return pd.DataFrame(
                {"query_row": own_rows[best.query], "query_id": own_ids[best.query], "vec_id": best.id, "score": best.score}
            )

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                own = np.frombuffer(r.q_rows, np.int64)
                if now != (r.q_part, r.lane):
                    if best is not None:
                        yield result()
                    now, best, ids = (r.q_part, r.lane), Best(len(own), k), (own, np.frombuffer(r.q_ids, np.int64))
                points, wanted = fitting(numbers_of(r.kind, r.points, width), numbers_of(r.q_kind, r.q_points, width))
                tree = Tree(points)
                visit(tree, np.frombuffer(r.ids, np.int64), np.frombuffer(r.rows, np.int64), wanted, own, best)
        if best is not None:
            yield result()

    dealt = met.repartition("q_part", "lane").sortWithinPartitions("q_part", "lane", "part")
    found = dealt.mapInPandas(search, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    vec_id = F.when(F.col("vec_id") != no_id, F.col("vec_id"))
    return ranked.select("query_id", "rank", vec_id.alias("vec_id"), "score")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest products of every query against all embeddings."""
    return top_products(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
with v as (
 select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as double)) as e
 from embeddings where embedding is not null),
s as (
 select q.r as qr, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
 from v q join v c on q.r <> c.r where q.vec_id % 20 = 0),
k as (select *, row_number() over (partition by qr order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from k where rank <= 20
"""
