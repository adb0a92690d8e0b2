"""A table kept up to date file by file: what changed is loaded again, what did not stays on disk as it is."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revrecon.sources.commits import CommitConflict, CommitLog, made_at, new_name
from revrecon.sources.files import BROADCAST_FILES, FILE_BITS, by_name, file_of_row

MANIFEST_DDL = "source_id string, modified timestamp, size long, place string, source_no long"
_DATA, _LISTS = "data", "manifests"


@dataclass(frozen=True)
class Refreshed:
    """The version after a refresh and how many sources were loaded, kept and dropped by it."""

    version: int
    loaded: int
    kept: int
    dropped: int


@dataclass(frozen=True)
class Appended:
    """The version that holds a run's rows, how many this call added, and whether they were there before."""

    version: int
    rows: int
    already: bool


class FileTable:
    """A table whose rows belong to source files.

    Every version has a manifest: its sources, their state when loaded, and the folder of their rows. A refresh
    compares a listing with the last manifest, loads new and changed sources into folders of their own, and commits a
    manifest in which those replace their former ones only; all other folders are referred to as they are. The commit
    succeeds only on the version that was compared, so of two writers at once one starts again on the other's result.
    A refresh that dies before its commit leaves folders that no version names.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, root)

    def manifest(self, version: int | None = None) -> DataFrame:
        """Sources of a version, by default the last; empty before the first."""
        commit = self.log.read(version)
        if commit is None:
            return self.spark.createDataFrame([], MANIFEST_DDL)
        return self.spark.read.schema(MANIFEST_DDL).parquet(self.log.folder.path(_LISTS, commit.facts["manifest"]))

    def changed(self, listing: DataFrame, force: bool = False, version: int | None = None) -> DataFrame:
        """Listed sources (source_id, modified, size) that the version lacks or holds in another state."""
        if force:
            return listing
        return listing.join(self.manifest(version).select("source_id", "modified", "size"), ["source_id", "modified", "size"], "left_anti")

    def refresh(
        self,
        listing: DataFrame,
        load: Callable[[list[str]], DataFrame],
        source_of_row: Column | None = None,
        drop_missing: bool = False,
        force: bool = False,
        tries: int = 5,
    ) -> Refreshed:
        """Loads what changed and commits a version; without a change there is none.

        ``load`` reads the listed sources and gives rows whose source is ``source_of_row``, its place in the list that
        was handed over: by default the file part of ``row_no``, as the readers of one file per source number it.
        Sources that are no longer listed stay, unless ``drop_missing``. Only the names of changed sources reach the
        driver.
        """
        listing = listing.select("source_id", "modified", "size")
        for _ in range(tries):
            base = self.log.latest()
            done = self._refresh_on(base, listing, load, source_of_row, drop_missing, force)
            if done is not None:
                return done
        raise CommitConflict(f"{self.log.folder.root}: other writers were first {tries} times")

    def _refresh_on(self, base, listing, load, source_of_row, drop_missing, force) -> Refreshed | None:
        before = self.manifest(base or None)
        names = sorted((r[0] for r in self.changed(listing, force, base or None).select("source_id").distinct().collect()), key=by_name)
        here = listing.select("source_id").distinct()
        gone = before.join(here, "source_id", "left_anti").count() if drop_missing else 0
        n_before = before.count()
        if not names and not gone:
            return Refreshed(base, 0, n_before, 0)
        name, schema = new_name("load"), self._schema(base)
        if names:
            rows = load(names)
            self._store(rows, file_of_row() if source_of_row is None else source_of_row, name)
            schema = _widened(schema, rows.schema)
        numbers = self._placed(names, name)
        latest = listing.groupBy("source_id").agg(F.max(F.struct("modified", "size")).alias("s"))
        fresh = latest.join(numbers, "source_id").select("source_id", "s.modified", "s.size", "place", "source_no")
        kept = before.join(numbers.select("source_id"), "source_id", "left_anti")
        if drop_missing:
            kept = kept.join(here, "source_id", "left_semi")
        version = self._commit(base, kept.unionByName(fresh), schema, {"loaded": len(names), "dropped": gone})
        if version is None:
            return None
        replaced = before.join(numbers, "source_id", "left_semi").count()
        return Refreshed(version, len(names), n_before - replaced - gone, gone)

    def _placed(self, names: Sequence[str], name: str) -> DataFrame:
        """source_id, place, source_no of the sources of a load; one without rows has no place."""
        with_rows = {part for part, _ in self.log.folder.names(_DATA, name)} if names else set()
        rows = [(s, name if f"_source={i}" in with_rows else None, i) for i, s in enumerate(names)]
        return self.spark.createDataFrame(rows, "source_id string, place string, source_no long")

    def replace(self, base: int, names: Sequence[str], rows: DataFrame, source_of_row: Column, at: dt.datetime, note: dict) -> int | None:
        """A version in which the rows of the named parts are ``rows`` and all others are as in ``base``.

        ``source_of_row`` is a row's place among ``names``; a part without rows goes. ``note`` becomes part of the commit.
        None if another writer has made a version on the same base.
        """
        schema, name = self._schema(base) if base else None, new_name("load")
        fresh = self.spark.createDataFrame([], MANIFEST_DDL)
        if names:
            self._store(rows, source_of_row, name)
            placed = self._placed(names, name).where("place is not null")
            fresh = placed.select("source_id", F.lit(at).alias("modified"), F.lit(0).cast("long").alias("size"), "place", "source_no")
            schema = _widened(schema, rows.schema)
        named = self.spark.createDataFrame([(n,) for n in names], "source_id string")
        kept = self.manifest(base or None).join(named, "source_id", "left_anti")
        return self._commit(base, kept.unionByName(fresh), schema, note)

    def _store(self, rows: DataFrame, source: Column, name: str) -> None:
        rows.withColumn("_source", source.cast("long")).write.partitionBy("_source").parquet(self.log.folder.path(_DATA, name))

    def _commit(self, base: int, manifest: DataFrame, schema: T.StructType | None, facts: dict) -> int | None:
        """The new version, or None if another writer has made one on the same base."""
        listed = new_name("list")
        manifest.coalesce(1).write.parquet(self.log.folder.path(_LISTS, listed))  # one row per source file
        try:
            return self.log.commit(base, {"manifest": listed, "schema": schema.json() if schema else None, "based_on": base, **facts})
        except CommitConflict:
            return None

    def append(self, run_id: str, rows: Callable[[DataFrame | None], DataFrame], at: dt.datetime, tries: int = 5) -> Appended:
        """Adds the rows of a run once: a second call with its ``run_id`` finds them there and adds nothing.

        ``rows`` is called with the table as it is (None before the first commit). The result is written aside and
        becomes part of the table with its commit; if another run commits first, it is made anew from the table that
        holds that run's rows too. A run that dies before its commit has added nothing and may be started again.
        """
        for _ in range(tries):
            base = self.log.latest()
            before = self.manifest(base or None)
            if not before.where(F.col("source_id") == run_id).isEmpty():
                return Appended(base, 0, True)
            schema = self._schema(base) if base else None
            added, name = rows(self.read(base) if schema else None), new_name("load")
            self._store(added, F.lit(0), name)
            n = self.spark.read.schema(added.schema).parquet(self.log.folder.path(_DATA, name)).count()
            own = self._placed([run_id], name).select("source_id", F.lit(at).alias("modified"), F.lit(n).cast("long").alias("size"), "place", "source_no")
            version = self._commit(base, before.unionByName(own), _widened(schema, added.schema), {"run": run_id, "rows": n})
            if version is not None:
                return Appended(version, n, False)
        raise CommitConflict(f"{self.log.folder.root}: other writers were first {tries} times")

    def _schema(self, version: int) -> T.StructType | None:
        commit = self.log.read(version) if version else None
        return T.StructType.fromJson(json.loads(commit.facts["schema"])) if commit and commit.facts["schema"] else None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the last, with their ``source_id``.

        ``row_no``, if there, follows the order of the sources' names again, whichever load they come from.
        """
        commit = self.log.read(version)
        if commit is None:
            raise ValueError(f"{self.log.folder.root} was never loaded")
        schema = self._schema(commit.version)
        if schema is None:
            raise ValueError(f"{self.log.folder.root} never had a source")
        return self._rows(self.manifest(commit.version), schema)

    def rows_of(self, sources: Sequence[str], version: int | None = None) -> DataFrame:
        """The rows of some sources in a version."""
        commit = self.log.read(version)
        schema = self._schema(commit.version) if commit else None
        if commit is None or schema is None:
            raise ValueError(f"{self.log.folder.root} was never loaded")
        wanted = self.spark.createDataFrame([(s,) for s in sources], "source_id string")
        return self._rows(self.manifest(commit.version).join(wanted, "source_id", "left_semi"), schema)

    def _rows(self, manifest: DataFrame, schema: T.StructType) -> DataFrame:
        folder, held = self.log.folder, manifest.select("source_id", "place", "source_no").collect()
        ranked = sorted(held, key=lambda r: by_name(r.source_id))
        live = [(i, r.source_id, f"{r.place}/_source={r.source_no}") for i, r in enumerate(ranked) if r.place is not None]
        if not live:
            return self.spark.createDataFrame([], schema).withColumn("source_id", F.lit(None).cast("string"))
        rows = self.spark.read.schema(schema).parquet(*[folder.path(_DATA, part) for _, _, part in live])
        part = F.regexp_extract("_metadata.file_path", r"([^/]+/_source=\d+)/[^/]*$", 1)
        ranks = self.spark.createDataFrame(live, "_rank long, source_id string, _part string")
        if len(live) <= BROADCAST_FILES:
            ranks = F.broadcast(ranks)
        out = rows.withColumn("_part", part).join(ranks, "_part")
        if "row_no" in schema.fieldNames():
            line = F.col("row_no").bitwiseAND(F.lit((1 << FILE_BITS) - 1))
            out = out.withColumn("row_no", F.shiftleft("_rank", FILE_BITS) + line)
        return out.drop("_part", "_rank")

    def changed_between(self, older: int, newer: int | None = None) -> DataFrame:
        """Sources that a version has in another state than an older one: source_id, old_place, new_place (null if not there)."""
        key = ["place", "source_no"]
        old = (self.manifest(older) if older else self.spark.createDataFrame([], MANIFEST_DDL)).select("source_id", F.struct(*key).alias("old_place"))
        new = self.manifest(newer).select("source_id", F.struct(*key).alias("new_place"))
        return old.join(new, "source_id", "full").where(~F.col("old_place").eqNullSafe(F.col("new_place")))

    def clean(self, keep: int = 2, grace: dt.timedelta = dt.timedelta(days=1), now: float | None = None) -> list[str]:
        """Removes the folders of loads and manifests that none of the last ``keep`` versions names; returns them.

        A version that was cleaned can no longer be read; what is derived from versions (monthly tables) should have caught
        up before. A folder younger than ``grace`` stays: its writer may not have committed yet. Within a load that is still named,
        the folders of sources that were loaded again go too. Commit files stay.
        """
        folder, now = self.log.folder, time.time() if now is None else now
        versions = sorted(self.log.versions())[-max(1, keep) :]
        commits = [c for c in map(self.log.read, versions) if c]
        lists = {c.facts["manifest"] for c in commits}
        manifests = [self.manifest(c.version).select("place", "source_no") for c in commits]
        live = {(r.place, f"_source={r.source_no}") for r in reduce(DataFrame.union, manifests).distinct().collect() if r.place} if manifests else set()
        removed = []
        for kind, names in ((_LISTS, lists), (_DATA, {place for place, _ in live})):
            for name, _ in folder.names(kind):
                if now - made_at(name) < grace.total_seconds():
                    continue
                if name not in names:
                    removed.append(f"{kind}/{name}")
                elif kind == _DATA:
                    parts = [part for part, _ in folder.names(kind, name) if part.startswith("_source=") and (name, part) not in live]
                    removed += [f"{kind}/{name}/{part}" for part in parts]
        for path in removed:
            folder.remove(path)
        return removed


def _widened(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The columns of both; a column keeps its first type, and another type later is an error."""
    fields = {f.name: f.dataType for f in old.fields} if old else {}
    for f in new.fields:
        if fields.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} was {fields[f.name].simpleString()} and is now {f.dataType.simpleString()}")
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
