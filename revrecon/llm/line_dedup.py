"""Removing lines that repeat across documents, with a sharded minimal perfect hash over the repeated lines."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrecon.llm.common import batch_slices, held, settle, slices, table, text_of

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Keys in one shard of the index, and bits per key in a level of its hash.
SHARD, GAMMA = 1 << 18, 2
#: The index is sent to all tasks up to this many bytes; beyond, lines go to the counts by a join.
SENT_MB = 64
GONE = "_lines_gone"
NO_ID = np.iinfo(np.int64).min
INDEX = "shard int, levels array<binary>, marks binary, counts binary, last binary"


def line_hashes(lines: list[str], min_chars: int) -> np.ndarray:
    """Two words per line from a 128-bit hash of its key (stripped, A-Z lower-cased); 0, 0 where the key is too short."""
    digest, none, parts = xxhash.xxh3_128_digest, bytes(16), []
    for line in lines:
        key = line.strip(BLANKS)
        parts.append(digest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= min_chars else none)
    return np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)


def scrambled(keys: np.ndarray, marks: np.ndarray, level: int) -> np.ndarray:
    """A hash of both words for one level."""
    x = keys.astype(np.uint64) + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= marks.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_levels(keys: np.ndarray, marks: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of a minimal perfect hash: each level keeps the keys that are alone in their slot, the rest go on."""
    levels = []
    while len(keys):
        slot = (scrambled(keys, marks, len(levels)) % np.uint64(GAMMA * len(keys))).astype(np.int64)
        alone = np.bincount(slot, minlength=GAMMA * len(keys)) == 1
        levels.append(alone)
        keys, marks = keys[~alone[slot]], marks[~alone[slot]]
    return levels


class Shard:
    """One shard of the index: a key's number from the level arrays, then its mark, count and last document."""

    def __init__(self, levels: list[np.ndarray], marks: np.ndarray, counts: np.ndarray, last: np.ndarray):
        self.levels, self.marks, self.counts, self.last, self.ranks, before = levels, marks, counts, last, [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())

    @classmethod
    def load(cls, row) -> Shard:
        bits = [(np.frombuffer(b, np.uint8, offset=8), int.from_bytes(b[:8], "little")) for b in row["levels"]]
        levels = [np.unpackbits(b, count=n).astype(bool) for b, n in bits]
        return cls(levels, np.frombuffer(row["marks"], "<i8"), np.frombuffer(row["counts"], "<i4"), np.frombuffer(row["last"], "<i8"))

    def numbers(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The number of each key; for keys that are not in the index any number or -1."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            slot = (scrambled(keys[left], marks[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[slot]
            found[left[hit]] = ranks[slot[hit]]
            left = left[~hit]
        return found

    def probe(self, keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and last document of each line; count 0 where the line is not in the index."""
        at = self.numbers(keys, marks)
        known = at >= 0
        known[known] = self.marks[at[known]] == marks[known]
        at = np.where(known, at, 0)
        return np.where(known, self.counts[at], 0), np.where(known, self.last[at], NO_ID)


def shard_row(shard: int, keys: np.ndarray, marks: np.ndarray, counts: np.ndarray, last: np.ndarray) -> dict:
    levels = build_levels(keys, marks)
    order = Shard(levels, marks, counts, last).numbers(keys, marks)
    placed = [np.empty_like(a) for a in (marks, counts, last)]
    for to, a in zip(placed, (marks, counts, last), strict=True):
        to[order] = a
    packed = [len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in levels]
    arrays = {n: a.astype(k).tobytes() for n, a, k in zip(("marks", "counts", "last"), placed, ("<i8", "<i4", "<i8"), strict=True)}
    return {"shard": shard, "levels": packed, **arrays}


def doc_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """key, mark, doc_id: each distinct long line of each document once; a null doc_id is less than any other."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held("lines")
        for pdf in slices(batches, "text"):
            found = [np.unique(line_hashes(t.split("\n"), min_chars), axis=0) for t in pdf["text"]]
            rows = np.concatenate(found)
            ids = np.repeat(pdf["doc_id"].to_numpy(np.int64), [len(f) for f in found])
            keep = rows.any(axis=1)
            yield pd.DataFrame({"key": rows[keep, 0], "mark": rows[keep, 1], "doc_id": ids[keep]})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(work, "key long, mark long, doc_id long")


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """key, mark, n, last: lines of at least ``min_docs`` documents, with the largest doc_id that holds them."""
    counted = doc_lines(docs, min_chars).groupBy("key", "mark").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("doc_id").alias("last"))
    return settle(counted.where(F.col("n") >= min_docs), "repeated-lines")


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """The shards of the minimal perfect hash with their arrays."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        arrays = [pdf[c].to_numpy() for c in ("key", "mark", "n", "last")]
        return pd.DataFrame([shard_row(int(pdf["shard"].iloc[0]), *arrays)])

    dealt = lines.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    return settle(dealt.groupBy("shard").applyInPandas(work, INDEX), "line-index")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, sent_mb: float = SENT_MB
) -> DataFrame:
    """The documents with repeated lines taken out of their text, and n_lines and n_dropped (of the text before).

    A line's key is the line stripped of blanks and with A-Z lower-cased. A key of ``min_chars`` or more that stands in
    ``min_docs`` or more rows loses its lines in every row but those with the largest doc_id that holds it. Documents
    carry no line to another task: they probe arrays of marks (64 bits), counts and last documents through a minimal
    perfect hash, which takes the other 64 bits of a line's hash. The arrays hold repeated lines only. They are sent to
    all tasks while they are under ``sent_mb``; beyond that, the lines' hashes are joined with the counts instead.

    Null texts become empty ones: one empty line. A null doc_id is less than any other; among equal largest doc_ids all
    keep the line. Other columns stay as they are, whatever their names, but for n_lines and n_dropped.
    """
    spark, lines = docs.sparkSession, repeated_lines(docs, min_chars, min_docs)
    shards = max(1, -(-lines.count() // SHARD))
    index = build_index(lines, shards)
    size = F.octet_length("marks") + F.octet_length("counts") + F.octet_length("last")
    if (index.agg(F.sum(size)).first()[0] or 0) > sent_mb * 1e6:
        return _dedup_by_join(docs, lines, min_chars)
    sent, name = spark.sparkContext.broadcast([r.asDict() for r in index.collect()]), uuid.uuid4().hex

    def doomed(rows: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
        opened = held("line-index")
        if name not in opened:
            opened.clear()
            opened[name] = {r["shard"]: Shard.load(r) for r in sent.value}
        drop, which = np.zeros(len(rows), bool), rows[:, 0] % shards
        for s, shard in opened[name].items():
            at = np.flatnonzero((which == s) & rows.any(axis=1))
            count, last = shard.probe(rows[at, 0], rows[at, 1])
            drop[at] = (count > 0) & (last != doc_ids[at])
        return drop

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            yield cut(batch, doomed, min_chars)

    return docs.withColumn("text", text_of()).mapInArrow(work, output_schema(docs))


def output_schema(docs: DataFrame) -> T.StructType:
    fields = [f if f.name != "text" else T.StructField("text", T.StringType()) for f in docs.schema.fields]
    return T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def cut(batch: pa.RecordBatch, doomed: Callable[[np.ndarray, np.ndarray], np.ndarray], min_chars: int) -> pa.RecordBatch:
    """The batch with doomed lines out of its texts and the two counts behind."""
    names, doc_ids = batch.schema.names, batch.column(batch.schema.names.index("doc_id"))
    ids = np.array([NO_ID if x is None else int(x) for x in doc_ids.to_pylist()], np.int64)
    lines = [t.split("\n") for t in batch.column(names.index("text")).to_pylist()]
    n = np.array([len(x) for x in lines], np.int64)
    rows = line_hashes([line for x in lines for line in x], min_chars)
    drop = doomed(rows, np.repeat(ids, n))
    texts, dropped, at = [], [], 0
    for x in lines:
        gone = drop[at : at + len(x)]
        at += len(x)
        texts.append("\n".join(line for line, d in zip(x, gone, strict=True) if not d) if gone.any() else "\n".join(x))
        dropped.append(int(gone.sum()))
    columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(names)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(n, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, "n_lines", "n_dropped"]
    )


def _dedup_by_join(docs: DataFrame, lines: DataFrame, min_chars: int) -> DataFrame:
    """The same for any number of repeated lines: hashes of lines meet the counts in a join, and come back per text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held("lines")
        for pdf in slices(batches, "text"):
            for text, doc_id, content in zip(pdf["text"], pdf["doc_id"], pdf["content"], strict=True):
                rows = np.unique(line_hashes(text.split("\n"), min_chars), axis=0)
                rows = rows[rows.any(axis=1)]
                yield pd.DataFrame({"key": rows[:, 0], "mark": rows[:, 1], "doc_id": np.int64(doc_id), "content": content})

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                gone = set(one.column(one.schema.names.index(GONE)).to_pylist()[0] or ())
                rest = one.drop_columns([GONE])
                yield cut(rest, lambda rows, _, gone=gone: np.array([(k ^ m) in gone for k, m in rows.tolist()], bool), min_chars)

    doc_id, content = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.sha2(text_of(), 256)
    rows = docs.select(doc_id.alias("doc_id"), text_of().alias("text"), content.alias("content"))
    found = rows.mapInPandas(work, "key long, mark long, doc_id long, content string").join(lines, ["key", "mark"])
    pair = F.col("key").bitwiseXOR(F.col("mark"))
    gone = found.where(F.col("last") != F.col("doc_id")).groupBy("doc_id", "content").agg(F.collect_set(pair).alias(GONE))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_content"), GONE)
    joined = docs.withColumn("text", text_of()).join(gone, (doc_id == F.col("gone_id")) & (content == F.col("gone_content")), "left")
    return joined.select(*docs.columns, GONE).mapInArrow(drop, output_schema(docs))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = """
with l as (
 select doc_id, r, i, line, lower_key as key from (
  select doc_id, r, i, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_key
  from (select doc_id, r, unnest(lines) as line, unnest(range(len(lines))) as i
   from (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as lines from documents) a) b) c),
k as (
 select key, max(doc_id) as last from (select distinct key, doc_id, r from l where length(key) >= 20) d group by key having count(*) >= 3)
select l.doc_id, cast(count(*) as bigint) as n_lines,
 cast(sum(case when k.key is not null and k.last <> l.doc_id then 1 else 0 end) as bigint) as n_dropped,
 sha256(coalesce(string_agg(l.line, chr(10) order by l.i) filter (where k.key is null or k.last = l.doc_id), '')) as kept_sha256
from l left join k on l.key = k.key group by l.doc_id, l.r
"""
