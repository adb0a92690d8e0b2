"""Tables out: CSV, JSON, metric bundles and result sets per run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.functions.money import as_double
from revrecon.sinks.runs import Output, read_run, save_run


def as_table(spark: SparkSession, data: DataFrame | Mapping | list) -> DataFrame:
    """A DataFrame as it is; a dict of columns, a dict of values or a list of dicts as a small table."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, Mapping):
        if data and all(isinstance(v, (list, tuple)) for v in data.values()):
            data = [dict(zip(data, row)) for row in zip(*data.values())]
        else:
            data = [dict(data)]
    return spark.createDataFrame(data)


def _flat(df: DataFrame) -> DataFrame:
    """CSV has no nesting: arrays become text joined by `` | ``."""
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " | ") for c in arrays})


def export_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    """CSV part files with a header; written in parallel, one per task."""
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _flat(df).write.mode(mode).options(header=True, escape='"', **keep_spaces).csv(path)
    return path


def export_json(df: DataFrame, path: str, mode: str = "error") -> str:
    """JSON lines, amounts as numbers."""
    as_double(df).write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def run_stamp(now: dt.datetime | None = None) -> str:
    """``YYYYMMDD_HHMMSS``, the stamp the retention plan reads."""
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


# metric -> (file name, format)
_BUNDLE = {
    "executive_summary": ("summary", "json"),
    "provider_performance": ("providers", "csv"),
    "insurance_analysis": ("insurance", "csv"),
    "facility_comparison": ("facilities", "csv"),
    "visit_stage_breakdown": ("stages", "csv"),
    "red_flags": ("red_flags", "json"),
}


def _as_csv(df: DataFrame, path: str) -> DataFrame:
    export_csv(df, path)
    return _flat(df)


def _as_json(df: DataFrame, path: str) -> DataFrame:
    export_json(df, path)
    return as_double(df)


def _as_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("error").parquet(path)
    return df


_WRITERS = {"csv": _as_csv, "json": _as_json, "parquet": _as_parquet}


def export_metrics_bundle(metrics: Mapping[str, DataFrame], folder: str, stamp: str) -> dict[str, str]:
    """The six metric outputs of a run, valid together: see :func:`revrecon.sinks.runs.save_run`."""
    outputs = {
        f"{file_name}_{kind}": Output(metrics[name], kind, _WRITERS[kind])
        for name, (file_name, kind) in _BUNDLE.items()
        if name in metrics
    }
    if not outputs:
        return {}
    return save_run(next(iter(outputs.values())).table.sparkSession, outputs, folder, stamp)


def read_metrics_bundle(spark: SparkSession, folder: str, stamp: str | None = None) -> dict[str, DataFrame]:
    """The metric tables of a complete run, by default the last."""
    names = {f"{file_name}_{kind}": name for name, (file_name, kind) in _BUNDLE.items()}
    return {names[output]: df for output, df in read_run(spark, folder, stamp).items() if output in names}


def save_result_sets(
    results: Mapping[str, DataFrame], folder: str, stamp: str, skip_empty: Iterable[str] = ()
) -> dict[str, str]:
    """Named results of a run as Parquet, valid together; listed names are not saved when empty."""
    skippable = set(skip_empty)
    outputs = {
        name: Output(df, "parquet", _as_parquet)
        for name, df in results.items()
        if not (name in skippable and df.isEmpty())
    }
    if not outputs:
        return {}
    return save_run(next(iter(outputs.values())).table.sparkSession, outputs, folder, stamp)
