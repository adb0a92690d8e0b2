"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder of a local session that names none.
_own: list[str] = []


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the plans are written for.

    On a cluster leave both arguments out: the master comes from spark-submit. Shuffles then start
    with many partitions and AQE merges them up to the advisory size, so the same setting fits a
    small month and the whole history.
    """
    builder = (
        SparkSession.builder.appName("revrecon")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # call-site capture costs milliseconds per column expression on the driver
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8192").config(
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB"
        )
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the folder every executor can reach. A machine-local folder is
    used only where that setting is absent, that is in local tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="revrecon-"))
        root = _own[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(spark: SparkSession, df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Results that several outputs read are computed once; the written table survives lost executors.
    """
    path = f"{folder.rstrip('/')}/{name}" if folder else scratch_dir(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
