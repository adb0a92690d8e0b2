"""Vectors as bytes: which rows take part, and their components padded to one length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components; null and empty vectors take no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def packed(rows: DataFrame, keep: str) -> tuple[DataFrame, int]:
    """The usable rows with ``v``: their components as little-endian doubles, shorter vectors padded with zeros; and the
    common length. ``keep`` is the schema of the other columns."""
    vector = F.col("embedding").cast("array<double>")
    good = rows.withColumn("embedding", vector).where(usable(F.col("embedding")))
    width = good.agg(F.max(F.size("embedding"))).first()[0] or 1

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for x in pdf["embedding"]:
                v = np.zeros(width, "<f8")
                v[: len(x)] = x
                out.append(v.tobytes())
            yield pdf.drop(columns="embedding").assign(v=out)

    return good.mapInPandas(work, f"{keep}, v binary"), width


def matrix(values, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(-1, width)
