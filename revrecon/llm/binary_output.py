"""Token-id output: every document's ids in compressed blocks, in ascending doc_id order, and reading them back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm import rans
from revrecon.llm.common import scratch, settle, slices, table, text_of
from revrecon.llm.tokens import reader, vocabulary_path

#: Ids after which a block is closed at the next document's end, and ids of a shard.
BLOCK, SHARD = 1 << 18, 1 << 24
BLOCKS = "shard int, first_ids long, n_ids long, doc_ids array<long>, payload binary"


def token_ids(docs: DataFrame, end_id: int, path: str) -> DataFrame:
    """doc_id, width (bytes of an id), ids: every document's ids with the end id."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader(path)
        end = np.array([end_id], read.kind).tobytes()
        for pdf in slices(batches, "text", 4_000_000):
            pdf["ids"] = [i.tobytes() + end for i in read.encode(pdf["text"].tolist())]
            pdf["width"] = np.int32(read.kind.itemsize)
            yield pdf[["doc_id", "width", "ids"]]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(work, "doc_id long, width int, ids binary")


def token_counts(ids: DataFrame) -> DataFrame:
    """How often each id occurs in all documents: one row per id of the vocabulary at most."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, np.int64)
        for pdf in batches:
            for width, group in pdf.groupby("width"):
                found = np.bincount(np.frombuffer(b"".join(group["ids"]), f"<u{width}"))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    return ids.select("width", "ids").mapInPandas(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, folder: str, end_id: int = 1, vocabulary: str | None = None) -> tuple[str, str]:
    """Writes ``folder``/blocks and ``folder``/counts (the shared table's counts); returns both paths.

    A block is a row: its shard, ids before it in the shard, its number of ids, its documents' doc_ids and the coded ids
    (see ``rans``). Documents are dealt to shards by ranges of doc_id; rows with equal doc_id go on by a hash of their
    ids, so one doc_id with very many rows spreads over several shards. There are as many shards as the counted ids ask
    for, about ``SHARD`` each. The table of id counts has at most one row per
    id of the vocabulary, so it is sent to every task. Texts are tokenised once: the ids are kept in the shared folder
    while the counts and the ranges are found.

    Null or empty texts are the end id alone, null doc_ids come first, repeated rows are written each.
    """
    path = vocabulary or vocabulary_path()
    ids = settle(token_ids(docs, end_id, path), "ids")
    spark, counts, blocks = docs.sparkSession, f"{folder}/counts", f"{folder}/blocks"
    token_counts(ids).write.parquet(counts)
    shared = shared_table(spark, counts)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, names, shard, first, size = [], [], TaskContext.get().partitionId(), 0, 0

        def close() -> pd.DataFrame:
            row = (shard, first, size, names, rans.encode(held, shared))
            return pd.DataFrame([row], columns=["shard", "first_ids", "n_ids", "doc_ids", "payload"])

        for pdf in batches:
            for doc_id, width, raw in zip(pdf["doc_id"], pdf["width"], pdf["ids"], strict=True):
                if size >= BLOCK:
                    yield close()
                    held, names, first, size = [], [], first + size, 0
                held.append(np.frombuffer(raw, f"<u{width}"))
                names.append(None if pd.isna(doc_id) else int(doc_id))
                size += len(held[-1])
        if held:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    n_ids = spark.read.parquet(counts).agg(F.sum("n")).first()[0] or 0
    parts = max(2, spark.sparkContext.defaultParallelism, -(-n_ids // SHARD))
    dealt = ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.select("doc_id", "width", "ids").mapInPandas(work, BLOCKS).write.parquet(blocks)
    return blocks, counts


def shared_table(spark: SparkSession, counts: str) -> rans.Table:
    """The frequency table: as many rows as the vocabulary has ids at most."""
    rows = spark.read.parquet(counts).toPandas()
    return rans.Table(rows["id"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


def read_ids(spark: SparkSession, blocks: str, counts: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian u32), read from the files."""
    shared = shared_table(spark, counts)
    stored = spark.read.schema(BLOCKS).parquet(blocks)
    # one row per shard: as many as the writing job had tasks
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).toPandas().sort_values("shard")
    base = dict(zip(sizes["shard"], sizes["n"].cumsum() - sizes["n"], strict=True))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard, first, doc_ids, payload in zip(pdf["shard"], pdf["first_ids"], pdf["doc_ids"], pdf["payload"], strict=True):
                docs = rans.decode(payload, shared)
                lengths = np.array([len(d) for d in docs], np.int64)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if pd.isna(x) else int(x) for x in doc_ids], "Int64"),
                        "start": base[shard] + first + np.cumsum(lengths) - lengths,
                        "ids": [d.astype("<u4").tobytes() for d in docs],
                    }
                )

    return stored.select("shard", "first_ids", "doc_ids", "payload").mapInPandas(work, "doc_id long, start long, ids binary")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written in blocks in doc_id order and read back."""
    blocks, counts = write_ids(table(spark, sf_dir, "documents"), scratch(spark, "token-files"))
    return read_ids(spark, blocks, counts).select(
        "doc_id",
        "start",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )

