"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import settle, table
from revrecon.llm.jaccard_join import without_near_copies
from revrecon.llm.line_dedup import dedup_lines
from revrecon.llm.mixing import mix, repeated
from revrecon.llm.packing import pack
from revrecon.llm.quality import score_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranker keeps. It learns from the labelled ones among them."""
    return score_quality(docs, table(spark, sf_dir, "labels")).where("quality_kept").select(*COLUMNS)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stand in three or more; one keeps each line. Null texts become empty."""
    kept = dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    return without_near_copies(docs).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them: not at all, once, or up to three times."""
    return repeated(mix(docs), COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 ids."""
    return pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", own_lines),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources", mixed_sources),
    ("packing", packed),
]

#: The ranker's weights are learned, so no SQL gives the rows; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
