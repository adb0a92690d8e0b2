"""Near copies among embeddings by cosine: an epsilon grid order join, and the components of its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revrecon.llm.common import settle, table
from revrecon.llm.components import components, local_roots
from revrecon.llm.vectors import matrix, packed, usable

COSINE = 0.95
#: Vectors that the order's axes are fitted on (they change the cost, never the result), and axes of the grid.
SAMPLE, AXES, KEYED = 20_000, 4, 2
#: Vectors of a block, size under which intervals are compared at once, and partner blocks that come together.
BLOCK, LEAF, PARTNERS = 2048, 256, 8
NO_ID = np.iinfo(np.int64).min


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by the largest component first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Interval:
    """A run of vectors in grid order, with the boxes of its halves, quarters and so on."""

    def __init__(self, units: np.ndarray, axes: np.ndarray):
        self.units, self.places, self.boxes = units, units @ axes, {}

    def box(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if (lo, hi) not in self.boxes:
            part = self.places[lo:hi]
            self.boxes[lo, hi] = part.min(axis=0), part.max(axis=0)
        return self.boxes[lo, hi]


def gap2(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Square of the least distance between two boxes."""
    apart = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(apart @ apart)


def join_intervals(a: Interval, b: Interval, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of a, j of b) with that cosine or more; for a joined with itself only i < j.

    Intervals are halved, the longer one first, and left where their boxes are provably further apart than the radius.
    """
    radius2 = 2 - 2 * cosine + 1e-9
    left, right, todo = [], [], [(0, len(a.units), 0, len(b.units))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a is b and b1 <= a0 or gap2(a.box(a0, a1), b.box(b0, b1)) > radius2:
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            if a1 - a0 >= b1 - b0:
                m = (a0 + a1) // 2
                todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
            else:
                m = (b0 + b1) // 2
                todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
            continue
        i, j = np.nonzero(a.units[a0:a1] @ b.units[b0:b1].T >= cosine)
        i, j = i + a0, j + b0
        if a is b:
            i, j = i[i < j], j[i < j]
        left.append(i)
        right.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def grid_axes(reps: DataFrame, width: int) -> np.ndarray:
    """Orthogonal axes by falling spread, from at most ``SAMPLE`` vectors taken by a hash."""
    n = reps.count()
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / (1 << 30)
    rows = reps.where(place < min(1.0, SAMPLE / max(n, 1))).select("v").toPandas()
    if len(rows) < 2:
        return np.eye(width)
    u = unit(matrix(rows["v"], width))
    values, axes = np.linalg.eigh(np.cov(u.T).reshape(width, width))
    return axes[:, np.argsort(-values)]


def grid_blocks(reps: DataFrame, width: int, axes: np.ndarray, step: float) -> DataFrame:
    """Blocks of up to ``BLOCK`` vectors that follow each other in grid order, with their boxes."""
    cells = [f"c{k}" for k in range(min(AXES, width))]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                at = np.floor((unit(matrix(pdf["v"], width)) @ axes[:, : len(cells)]) / step).astype(np.int32)
                yield pdf.assign(**{c: at[:, k] for k, c in enumerate(cells)})

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, rest = TaskContext.get().partitionId() << 32, []

        def rows(pdf: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            out = []
            for lo in range(0, len(pdf), BLOCK):
                part = pdf.iloc[lo : lo + BLOCK]
                places = unit(matrix(part["v"], width)) @ axes
                low, high = places.min(axis=0), places.max(axis=0)
                grid = [np.floor(e[:KEYED] / step).astype(int).tolist() for e in (low, high)]
                out.append((number, low.tolist(), high.tolist(), *grid, b"".join(part["rep"]), part["copies"].to_numpy("<i8").tobytes(), b"".join(part["v"])))
                number += 1
            return pd.DataFrame(out, columns=["block", "low", "high", "first", "last", "reps", "copies", "v"])

        for pdf in batches:
            rest.append(pdf)
            if sum(map(len, rest)) >= 4 * BLOCK:
                all_ = pd.concat(rest, ignore_index=True)
                cut = len(all_) // BLOCK * BLOCK
                yield rows(all_.iloc[:cut])
                rest = [all_.iloc[cut:]]
        if rest and sum(map(len, rest)):
            yield rows(pd.concat(rest, ignore_index=True))

    schema = "rep binary, copies long, least long, v binary, " + ", ".join(f"{c} int" for c in cells)
    placed = settle(reps.mapInPandas(place, schema), "grid")
    parts = max(1, -(-placed.count() // (4 * BLOCK)))
    ordered = placed.repartitionByRange(parts, *cells, "rep").sortWithinPartitions(*cells, "rep")
    shape = "block long, low array<double>, high array<double>, first array<int>, last array<int>, reps binary, copies binary, v binary"
    return settle(ordered.mapInPandas(block, shape), "blocks")


def near_blocks(blocks: DataFrame, width: int, radius2: float) -> DataFrame:
    """a, b: pairs of blocks (a <= b) whose boxes come within the radius, found by the grid cells that they cover."""
    keyed = blocks.select("block", "low", "high", "first", "last")
    keys = [f"k{d}" for d in range(min(KEYED, width))]
    one, two = keyed, keyed
    for d, key in enumerate(keys):
        one = one.withColumn(key, F.explode(F.sequence(F.get("first", F.lit(d)) - 1, F.get("last", F.lit(d)) + 1)))
        two = two.withColumn(key, F.explode(F.sequence(F.get("first", F.lit(d)), F.get("last", F.lit(d)))))
    one = one.select(*keys, F.col("block").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    two = two.select(*keys, F.col("block").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    over = F.zip_with("a_low", "b_high", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    under = F.zip_with("b_low", "a_high", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    apart = F.aggregate(F.zip_with(over, under, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    met = one.join(two, keys).where((F.col("a") <= F.col("b")) & (apart <= radius2 + 1e-9))
    return met.select("a", "b").distinct()


def block_links(blocks: DataFrame, pairs: DataFrame, width: int, axes: np.ndarray, cosine: float) -> DataFrame:
    """rep, links, lead from every pair of near blocks: weighted numbers of links, and who hangs together with whom."""
    data = blocks.select("block", "reps", "copies", "v")
    lots = pairs.withColumn("lot", F.pmod(F.xxhash64("b"), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("a")) / PARTNERS)))
    firsts = lots.select("a", "lot", F.col("a").alias("block"), F.lit(False).alias("partner")).distinct()
    seconds = lots.select("a", "lot", F.col("b").alias("block"), F.lit(True).alias("partner"))
    rows = firsts.union(seconds).join(data, "block")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine, name = None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids = np.array([r.reps[k : k + 16] for k in range(0, len(r.reps), 16)], object)
                copies = np.frombuffer(r.copies, "<i8").astype(np.float64)
                if not r.partner:
                    mine, name = (Interval(unit(matrix([r.v], width)), axes), ids, copies), r.block
                    continue
                a, a_ids, a_copies = mine
                same = r.block == name
                b = a if same else Interval(unit(matrix([r.v], width)), axes)
                i, j = join_intervals(a, b, cosine)
                if not len(i):
                    continue
                if same:
                    all_ids, all_copies = a_ids, a_copies
                else:
                    all_ids, all_copies, j = np.concatenate([a_ids, ids]), np.concatenate([a_copies, copies]), j + len(a_ids)
                n = len(all_ids)
                links = np.bincount(i, all_copies[j], n) + np.bincount(j, all_copies[i], n)
                some = np.flatnonzero(links)
                roots = local_roots(n, i, j)
                yield pd.DataFrame({"rep": all_ids[some], "links": links[some].astype(np.int64), "lead": all_ids[roots[some]]})

    dealt = rows.repartition("a", "lot").sortWithinPartitions("a", "lot", "partner")
    return dealt.mapInPandas(work, "rep binary, links long, lead binary")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row; links join rows with that cosine or more.

    Equal vectors are one vector with a number of copies. The others are sorted by the cells of a grid on their leading
    principal axes, as wide as the radius that the cosine allows; blocks of that order are joined where their boxes are
    within the radius, interval by interval. A pair of blocks gives each vector's number of links and a spanning forest,
    never its pairs, so dense groups stay small. Cosines are computed in double precision.

    Null and zero vectors and those that hold null or non-finite components link with nothing. Shorter vectors count as
    padded with zeros. Rows with equal vec_id are vectors of their own; the smallest id of a component that has only
    null ids is null, and its rows are kept.
    """
    key = F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID))
    rows = vectors.select(key.alias("key"), "embedding")
    held, width = packed(rows, "key long")

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            some = [np.frombuffer(v, "<f8").any() for v in pdf["v"]]
            pdf = pdf[some]
            yield pdf.assign(rep=[xxhash.xxh3_128_digest((np.frombuffer(v, "<f8") + 0.0).tobytes()) for v in pdf["v"]])

    named = settle(held.mapInPandas(name, "key long, v binary, rep binary"), "named")
    least = F.min(F.when(F.col("key") != NO_ID, F.col("key")))
    reps = settle(named.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"), least.alias("least"), F.first("v").alias("v")), "vector-reps")
    axes, step = grid_axes(reps, width), float(np.sqrt(2 - 2 * cosine))
    blocks = grid_blocks(reps, width, axes, step)
    links = settle(block_links(blocks, near_blocks(blocks, width, step * step), width, axes, cosine), "vector-links")
    roots = components(links.select(F.col("rep").alias("a"), F.col("lead").alias("b")))
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    full = reps.select("rep", "copies", "least").join(counted, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    full = settle(full.select("rep", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root")), "vector-classes")
    smallest = full.groupBy("root").agg(F.min("least").alias("component_id"))
    sets = full.join(smallest, "root").select("rep", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = named.select("key", "rep").join(sets, "rep").select("key", "n_links", "component_id")
    good = F.col("embedding").cast("array<double>")
    idle = rows.where(~F.coalesce(_taking_part(good), F.lit(False))).select("key", F.lit(0).cast("long").alias("n_links"), F.when(F.col("key") != NO_ID, F.col("key")).alias("component_id"))
    vec_id = F.when(F.col("key") != NO_ID, F.col("key"))
    return linked.union(idle).select(vec_id.alias("vec_id"), "n_links", "component_id", vec_id.eqNullSafe(F.col("component_id")).alias("kept"))


def _taking_part(vector: Column) -> Column:
    return usable(vector) & F.exists(vector, lambda x: x != 0)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
