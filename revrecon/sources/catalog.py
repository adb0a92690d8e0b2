"""File listings, load log and table refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon import rules, schemas
from revrecon.operators.lookups import lookup


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder: file_name, source_id (path), modified, size. File contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("source_id"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def cache_status(load_log: DataFrame) -> DataFrame:
    """Latest log row per table, ordered by table name."""
    return (
        load_log.groupBy("table_name")
        .agg(F.max_by(F.struct("source_id", "modified", "loaded_at"), F.struct("loaded_at", "modified")).alias("r"))
        .select("table_name", "r.source_id", "r.modified", "r.loaded_at")
        .orderBy("table_name")
    )


def changed_sources(listing: DataFrame, load_log: DataFrame, force: bool = False) -> DataFrame:
    """Listed sources (table_name, source_id, modified) to load again: unknown, changed, or forced."""
    if force:
        return listing
    latest = load_log.groupBy("table_name").agg(F.max_by("modified", "loaded_at").alias("modified"))
    return listing.join(latest, ["table_name", "modified"], "left_anti")


def refresh_table(
    spark: SparkSession,
    source: DataFrame,
    table_name: str,
    source_id: str,
    modified: dt.datetime,
    warehouse: str,
    force: bool = False,
    loaded_at: dt.datetime | None = None,
) -> bool:
    """Load a table again when its source changed, and append its load-log row. False if current.

    Each load has a folder of its own and the log row makes it the current one, so a load that
    fails half-way leaves the table as it was.
    """
    if not force:
        row = spark.createDataFrame([(table_name, source_id, modified)],
                                    "table_name string, source_id string, modified timestamp")
        if changed_sources(row, read_load_log(spark, warehouse)).isEmpty():
            return False
    stamp = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    source.write.mode("overwrite").parquet(_location(warehouse, table_name, stamp))
    entry = spark.createDataFrame([(table_name, source_id, modified, stamp)], schemas.LOAD_LOG_DDL)
    entry.coalesce(1).write.mode("append").parquet(f"{warehouse}/load_log")
    return True


def _location(warehouse: str, table_name: str, loaded_at: dt.datetime) -> str:
    return f"{warehouse}/{table_name}/load_{loaded_at:%Y%m%d_%H%M%S_%f}"


def read_table(spark: SparkSession, warehouse: str, table_name: str) -> DataFrame:
    """The last complete load of a table; its log row is all the driver looks at."""
    current = read_load_log(spark, warehouse).filter(F.col("table_name") == table_name)
    row = current.agg(F.max("loaded_at").alias("loaded_at")).first()
    if row["loaded_at"] is None:
        raise ValueError(f"{table_name} was never loaded")
    return spark.read.parquet(_location(warehouse, table_name, row["loaded_at"]))


def read_load_log(spark: SparkSession, warehouse: str) -> DataFrame:
    """The load log, empty when nothing was loaded yet."""
    try:
        return spark.read.schema(schemas.LOAD_LOG_DDL).parquet(f"{warehouse}/load_log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.LOAD_LOG_DDL)


def latest_snapshot(listing: DataFrame) -> DataFrame:
    """Newest file per prefix by modification time; the greater name wins a tie."""
    return listing.groupBy("prefix").agg(
        F.max_by("file_name", F.struct("modified", "file_name")).alias("file_name"),
        F.max("modified").alias("modified"),
    )


def snapshot_retention_plan(
    listing: DataFrame,
    prefixes: Sequence[str],
    as_of: dt.datetime,
    max_age_days: int = rules.SNAPSHOT_MAX_AGE_DAYS,
) -> DataFrame:
    """keep/delete per file. Within (prefix, extension) the newest stamp stays unless too old.

    The stamp ``YYYYMMDD_HHMMSS`` comes from the name; a newest file without a stamp stays. The
    newest per group is an aggregate joined back, so a prefix with very many files is never one task.
    """
    name = F.col("file_name")
    prefix = F.coalesce(*[F.when(name.startswith(p), F.lit(p)) for p in prefixes])
    files = (
        listing.select("file_name")
        .withColumn("prefix", prefix)
        .filter(F.col("prefix").isNotNull())
        .withColumn("extension", F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
        .withColumn("stamp", F.regexp_extract("file_name", r"(\d{8}_\d{6})", 1))
    )
    newest = files.groupBy("prefix", "extension").agg(
        F.max(F.struct("stamp", "file_name"))["file_name"].alias("newest_name")
    )
    taken = F.try_to_timestamp("stamp", F.lit("yyyyMMdd_HHmmss"))
    cutoff = F.lit(as_of - dt.timedelta(days=max_age_days))
    keep = (F.col("file_name") == F.col("newest_name")) & ~F.coalesce(taken < cutoff, F.lit(False))
    return lookup(files, newest, ["prefix", "extension"], "inner", spread_by="file_name").select(
        "file_name", "prefix", "extension", "stamp", F.when(keep, "keep").otherwise("delete").alias("action")
    )


def register_sql(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Ad-hoc SQL over the loaded tables, each visible under its name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(sql)
