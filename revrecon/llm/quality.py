"""Document quality by Bradley-Terry ranking: scores learned from pairs of a better and a worse document."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrecon.llm.common import batch_slices, held, slices, spans, table, text_of

#: Labelled documents that a fit uses at most, half of each label where there are so many; pairs drawn from them, and
#: pairs whose differences exist at one time.
SAMPLE, PAIRS, CHUNK = 20_000, 60_000, 2048
#: Scores at or above this are predicted to be good.
CUT = 0.3
FOLDS = 5
ADDED = ("quality_score", "quality_kept")
#: Characters whose pairs of bytes are counted at one time.
AT_ONCE = 250_000
_MARKS = ".,|!?'\"-#"
KINDS = 7 + len(_MARKS)
WORDY = 6
WIDTH = KINDS * KINDS + WORDY


def _kind(b: int) -> int:
    c = chr(b)
    if c in _MARKS:
        return 7 + _MARKS.index(c)
    if b >= 128:
        return 5
    return 0 if c == " " else 1 if c in "\t\n\r\x0b\x0c" else 2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit() else 6


_KIND_OF = np.array([_kind(b) for b in range(256)], np.uint8)


def features(texts: list[str]) -> np.ndarray:
    """A row per text: how often each kind of byte follows each other kind, and word measures, over the whole text."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64) // AT_ONCE
    parts = [_features(texts[lo:hi]) for lo, hi in spans(ends)]
    return np.concatenate(parts) if parts else np.zeros((0, WIDTH))


def _features(texts: list[str]) -> np.ndarray:
    raw = [f" {t} ".encode("utf-8", "replace") for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    kinds = _KIND_OF[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
    doc = np.repeat(np.arange(len(raw)), lengths)
    pairs = doc[1:] * KINDS * KINDS + kinds[:-1] * KINDS + kinds[1:]
    inside = doc[1:] == doc[:-1]
    counts = np.bincount(pairs[inside], minlength=len(raw) * KINDS * KINDS).reshape(len(raw), -1)
    out = np.zeros((len(raw), WIDTH))
    out[:, :-WORDY] = np.sqrt(counts / (lengths - 1)[:, None])
    for i, t in enumerate(texts):
        words, lines = t.split(), t.split("\n")
        n, distinct = max(1, len(words)), len(set(words))
        out[i, -WORDY:] = (
            math.log1p(len(words)),
            distinct / n,
            math.log1p(len(t)) - math.log1p(len(words)),
            len(set(lines)) / len(lines),
            math.log1p(len(words) / len(lines)),
            distinct / math.sqrt(n),
        )
    return out


@dataclass
class Ranker:
    """Score of features x: the logistic function of (x - mean) / spread · weights - shift."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.spread) @ self.weights - self.shift + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def drawn(members: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """n members in random order, each equally often, give or take one."""
    return rng.permutation(np.resize(members, n))


def fit_ranker(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 3.0, seed: int = 7) -> Ranker | None:
    """Newton steps on the logistic loss of feature differences; None without both labels.

    There are ``pairs`` pairs, or more where a label has more documents; each document of a label is in equally many, give
    or take one. Gradient and Hessian are added up over ``CHUNK`` pairs at a time.
    The threshold is the quantile of the labelled scores, weighted back to the labels' own shares, that parts them best.
    """
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return None
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1
    z, rng = (x - mean) / spread, np.random.default_rng(seed)
    n = max(pairs, len(better), len(worse))
    above, below = drawn(better, n, rng), drawn(worse, n, rng)
    w = np.zeros(x.shape[1])
    for _ in range(12):
        gradient, hessian = -ridge * w, ridge * np.eye(len(w))
        for lo in range(0, n, CHUNK):
            d = z[above[lo : lo + CHUNK]] - z[below[lo : lo + CHUNK]]
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            gradient += d.T @ p
            hessian += (d * (p * (1 - p))[:, None]).T @ d
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Ranker(mean, spread, w, 0.0)


def quantile_cut(scores: np.ndarray, good: np.ndarray, weight: np.ndarray) -> float:
    """The score at the quantile below which labels are mostly 0: fewest weighted errors, in the middle of a tie."""
    order = np.argsort(scores, kind="stable")
    s, g, w = scores[order], good[order], weight[order]
    wrong = np.concatenate([[0], np.cumsum(np.where(g, w, 0))]) + np.concatenate([np.cumsum(np.where(g, 0, w)[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    at = int(best[len(best) // 2])
    return float((s[max(at - 1, 0)] + s[min(at, len(s) - 1)]) / 2)


def held_out() -> F.Column:
    """True for the fold that no fit may read: crc32 of the doc_id's text divisible by FOLDS (null doc_ids: text '')."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pairs: int = PAIRS) -> Ranker | None:
    """A ranker from labelled documents outside the held-out fold.

    Reads at most ``sample`` labelled documents, chosen by a hash of doc_id, half of each label where there are so many.
    Rows with the same doc_id are one document, the text with the least hash, before any of them is described.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = {q: min(1.0, max(sample // 2, sample - n) / sizes[q]) for q, n in ((1, sizes[0]), (0, sizes[1]))}
    chosen = known.where(place < F.when(F.col("quality") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    texts = one.select("doc_id", "quality", "one.text")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held("quality")
        for pdf in slices(batches, "text"):
            x = features(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "x": [r.astype("<f4").tobytes() for r in x]})

    rows = texts.mapInPandas(work, "doc_id long, quality int, x binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["doc_id", "x"])
    x = np.frombuffer(b"".join(rows["x"]), "<f4").reshape(len(rows), -1).astype(np.float64)
    good = rows["quality"].to_numpy() == 1
    ranker = fit_ranker(x, good, pairs)
    if ranker:
        raw = ((x - ranker.mean) / ranker.spread) @ ranker.weights
        ranker.shift = quantile_cut(raw, good, np.where(good, 1 / share[1], 1 / share[0]))
    return ranker


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pairs: int = PAIRS) -> DataFrame:
    """The documents with quality_score (0 to 1) and quality_kept (score at or above ``CUT``).

    Null texts are scored as empty ones. Without labels of both kinds every score is 0.5. Repeated rows get equal
    scores, an empty table none. Texts are read whole, however long, some two million characters at a time. Only the text
    is read for a score; other columns stay as they are, but for columns named quality_score or quality_kept, in any
    case: the new ones take their place.
    """
    ranker = learn(docs, labels, sample, pairs)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("quality")
        for batch in batch_slices(batches, "text"):
            texts = [t or "" for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            scores = np.full(len(texts), 0.5) if ranker is None else ranker.scores(features(texts))
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array(scores >= CUT, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *ADDED])

    added = [T.StructField(c, kind) for c, kind in zip(ADDED, (T.DoubleType(), T.BooleanType()), strict=True)]
    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, *added]))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("quality_score") >= CUT).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), predicted.alias("predicted"))
