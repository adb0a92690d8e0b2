"""Shared helpers: tables, the scratch folder, texts without nulls, and writing an intermediate table once."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, in a character class.
BLANK = "\\x20\\x09-\\x0D"
#: The folder of a local session that names none.
_own: list[str] = []
#: What this worker holds from one task to the next, and for which operator.
_held: dict[str, dict] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of its own, which the session keeps using.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="corpus-"))
        root = _own[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut of the lineage that survives lost executors.

    The write's own shuffle files go when it ends; later reads come from the table.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = scratch(spark, name), spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> F.Column:
    """The column as text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pd.DataFrame], column: str, most: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """The batches cut to about ``most`` characters each, so that memory does not follow the longest batch."""
    for pdf in batches:
        if len(pdf):
            ends = np.cumsum(pdf[column].str.len().to_numpy(dtype=np.int64)) // most
            for lo, hi in spans(ends):
                yield pdf.iloc[lo:hi].reset_index(drop=True)


def batch_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same cuts as ``slices`` for Arrow's batches; a null text has no characters."""
    for batch in batches:
        texts = batch.column(batch.schema.names.index(column))
        sizes = pc.fill_null(pc.utf8_length(texts.cast(pa.string()) if pa.types.is_null(texts.type) else texts), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // most
        for lo, hi in spans(ends):
            yield batch.slice(lo, hi - lo)


def held(owner: str) -> dict:
    """What this worker keeps for ``owner`` between tasks; it starts empty.

    Workers serve all stages of a session in turn, and an idle one keeps its memory. So what it held for another owner
    goes as soon as this one asks, and operators that keep nothing ask too.
    """
    if owner not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[owner] = {}
    return _held[owner]


def spans(keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal neighbours."""
    if not len(keys):
        return []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def quiet_threads() -> None:
    """One thread for each task: Spark already runs a task on every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")
