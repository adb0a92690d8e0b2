"""Outputs of a run that become valid together: written aside, and named by one run manifest that readers consult."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from revrecon.sources.commits import SharedFolder, made_at, new_name

_RUNS = "_runs"


class RunExists(RuntimeError):
    """A run of that stamp is complete already."""


@dataclass(frozen=True)
class Output:
    """A table of a run and the form it is kept in: ``parquet``, ``csv`` or ``json``."""

    table: DataFrame
    form: str
    write: Callable[[DataFrame, str], DataFrame]


def save_run(spark: SparkSession, outputs: Mapping[str, Output], folder: str, stamp: str) -> dict[str, str]:
    """Writes all outputs, then the manifest of the run; returns their paths.

    Each output goes to ``<folder>/<name>/run_ts=<stamp>/<attempt>``. If one fails, there is no manifest, so readers see
    none of them, and the run may be started again under the same stamp. Of two attempts at once the first to write the
    manifest is the run; the other raises :class:`RunExists`, as does a run that is complete already. ``write`` stores a
    table and gives it back as it is stored, which tells the columns to read it with.
    """
    shared, attempt = SharedFolder(spark, folder), new_name("attempt")
    if (f"{stamp}.json") in {name for name, _ in shared.names(_RUNS)}:
        raise RunExists(f"run {stamp} already exists in {folder}")
    facts = {}
    for name, output in outputs.items():
        place = f"{name}/run_ts={stamp}/{attempt}"
        stored = output.write(output.table, shared.path(place))
        facts[name] = {"place": place, "form": output.form, "schema": stored.schema.json()}
    if not shared.put_new(json.dumps(facts), _RUNS, f"{stamp}.json"):
        raise RunExists(f"run {stamp} already exists in {folder}")
    return {name: shared.path(fact["place"]) for name, fact in facts.items()}


def complete_runs(spark: SparkSession, folder: str) -> list[str]:
    """Stamps of the runs that are complete, the oldest first."""
    names = [name for name, _ in SharedFolder(spark, folder).names(_RUNS)]
    return sorted(name.removesuffix(".json") for name in names if name.endswith(".json") and not name.startswith("."))


def read_run(spark: SparkSession, folder: str, stamp: str | None = None) -> dict[str, DataFrame]:
    """The outputs of a complete run, by default the last, by name."""
    runs = complete_runs(spark, folder)
    stamp = stamp or (runs[-1] if runs else None)
    if stamp not in runs:
        raise ValueError(f"no complete run {stamp or ''} in {folder}")
    shared = SharedFolder(spark, folder)
    out = {}
    for name, fact in json.loads(shared.read(_RUNS, f"{stamp}.json")).items():
        reader = spark.read.schema(T.StructType.fromJson(json.loads(fact["schema"])))
        if fact["form"] == "csv":
            reader = reader.options(header=True, escape='"', multiLine=True)
        out[name] = reader.format(fact["form"]).load(shared.path(fact["place"]))
    return out


def remove_abandoned(spark: SparkSession, folder: str, grace: dt.timedelta = dt.timedelta(days=1), now: float | None = None) -> list[str]:
    """Removes what attempts that never became a run have left, if older than ``grace``; returns those folders."""
    shared, now = SharedFolder(spark, folder), time.time() if now is None else now
    valid = set()
    for stamp in complete_runs(spark, folder):
        valid |= {fact["place"] for fact in json.loads(shared.read(_RUNS, f"{stamp}.json")).values()}
    removed = []
    for name, _ in shared.names():
        if name.startswith("_"):
            continue
        for run, _ in shared.names(name):
            for attempt, _ in shared.names(name, run) if run.startswith("run_ts=") else ():
                place = f"{name}/{run}/{attempt}"
                if attempt.startswith("attempt-") and place not in valid and now - made_at(attempt) >= grace.total_seconds():
                    removed.append(place)
    for place in removed:
        shared.remove(place)
    return removed
