"""Tables by version, runs that append once, and runs whose outputs are valid together."""

import datetime as dt
import time

import pytest
from helpers import visits
from pyspark.sql import functions as F

from revrecon.operators import patient
from revrecon.sinks import runs
from revrecon.sinks.tables import export_metrics_bundle, read_metrics_bundle, save_result_sets
from revrecon.sources import exports
from revrecon.sources.catalog import list_files
from revrecon.sources.commits import CommitConflict, CommitLog
from revrecon.sources.versions import FileTable

LATER = dt.timedelta(0)


def write(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("Patient,Total Paid\n" + "".join(f"{p},{n}\n" for p, n in rows))


def listing(spark, folder):
    return list_files(spark, str(folder))


def load(spark, calls=None):
    def read(names):
        if calls is not None:
            calls.append([n.rsplit("/", 1)[1] for n in names])
        return exports.read_visits(spark, names, allow_empty=True)

    return read


def content(table, version=None):
    return [(r.patient_name, int(r.total_paid)) for r in table.read(version).orderBy("row_no").collect()]


def on_disk(root):
    return sorted(str(p.relative_to(root)) for p in root.glob("data/*/_source=*/*.parquet"))


def test_one_of_three_files_changes(spark, tmp_path):
    land, root = tmp_path / "in", tmp_path / "table"
    write(land, "v2.csv", ("b", 2), ("bb", 22))
    write(land, "v10.csv", ("c", 3))
    write(land, "v1.csv", ("a", 1))
    table, calls = FileTable(spark, str(root)), []
    first = table.refresh(listing(spark, land), load(spark, calls))
    assert (first.version, first.loaded, first.kept, first.dropped) == (1, 3, 0, 0)
    assert content(table) == [("a", 1), ("b", 2), ("bb", 22), ("c", 3)]
    before = on_disk(root)

    again = table.refresh(listing(spark, land), load(spark, calls))
    assert (again.version, again.loaded, again.kept) == (1, 0, 3) and len(calls) == 1

    write(land, "v2.csv", ("B", 9))
    second = table.refresh(listing(spark, land), load(spark, calls))
    assert (second.version, second.loaded, second.kept) == (2, 1, 2)
    assert calls == [["v1.csv", "v2.csv", "v10.csv"], ["v2.csv"]]
    assert content(table) == [("a", 1), ("B", 9), ("c", 3)]  # in the order of the files, whichever load they are from
    assert content(table, 1) == [("a", 1), ("b", 2), ("bb", 22), ("c", 3)]
    assert set(before) < set(on_disk(root))  # what did not change is where it was
    ids = {r.patient_name: r.source_id.rsplit("/", 1)[1] for r in table.read().collect()}
    assert ids == {"a": "v1.csv", "B": "v2.csv", "c": "v10.csv"}
    changed = [r.source_id.rsplit("/", 1)[1] for r in table.changed_between(1).collect()]
    assert changed == ["v2.csv"]
    assert len({r.row_no for r in table.read().collect()}) == 3


def test_new_missing_and_empty_files_and_other_columns(spark, tmp_path):
    land, table = tmp_path / "in", FileTable(spark, str(tmp_path / "t"))
    write(land, "a.csv", ("a", 1))
    write(land, "b.csv")
    assert table.refresh(listing(spark, land), load(spark)).loaded == 2
    assert content(table) == [("a", 1)]
    (land / "a.csv").unlink()
    (land / "c.csv").write_text("Patient,Total Paid,Provider\nc,3,P\n")
    kept = table.refresh(listing(spark, land), load(spark))
    assert (kept.loaded, kept.kept, kept.dropped) == (1, 2, 0)
    assert [(r.patient_name, r.provider) for r in table.read().orderBy("row_no").collect()] == [("a", None), ("c", "P")]
    gone = table.refresh(listing(spark, land), load(spark), drop_missing=True)
    assert (gone.version, gone.loaded, gone.kept, gone.dropped) == (3, 0, 2, 1)
    assert content(table) == [("c", 3)]
    assert table.refresh(listing(spark, land), load(spark), force=True).loaded == 2
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)
    with pytest.raises(ValueError, match="never loaded"):
        FileTable(spark, str(tmp_path / "none")).read()


def test_two_writers_at_once_leave_one_valid_version(spark, tmp_path):
    land, root = tmp_path / "in", str(tmp_path / "t")
    write(land, "a.csv", ("a", 1))
    one, two = FileTable(spark, root), FileTable(spark, root)
    one.refresh(listing(spark, land), load(spark))
    write(land, "a.csv", ("a", 5))
    write(land, "b.csv", ("b", 2))
    seen, other = listing(spark, land), []

    def slow(names):
        if not other:  # while this writer loads, the other one does it all
            other.append(two.refresh(seen, load(spark)))
        return load(spark)(names)

    late = one.refresh(seen, slow)
    assert other[0].version == 2 and late.version == 2 and late.loaded == 0
    assert content(one) == content(two) == [("a", 5), ("b", 2)]
    with pytest.raises(CommitConflict):
        CommitLog(spark, root).commit(1, {})
    assert [c.version for c in one.log.history()] == [1, 2]


def test_a_load_that_fails_changes_nothing_and_is_cleaned(spark, tmp_path):
    land, root = tmp_path / "in", tmp_path / "t"
    write(land, "a.csv", ("a", 1))
    write(land, "b.csv", ("b", 1))
    table = FileTable(spark, str(root))
    table.refresh(listing(spark, land), load(spark))
    write(land, "a.csv", ("a", 22))
    with pytest.raises(Exception, match="torn"):
        table.refresh(listing(spark, land), lambda names: load(spark)(names).withColumn("x", F.raise_error(F.lit("torn")).cast("string")))
    assert table.log.latest() == 1 and content(table) == [("a", 1), ("b", 1)]
    assert table.clean(grace=dt.timedelta(hours=1)) == []  # it could still be at work
    removed = table.clean(grace=LATER)
    assert [r.split("/")[0] for r in removed] == ["data"]
    table.refresh(listing(spark, land), load(spark))
    assert content(table) == [("a", 22), ("b", 1)]
    removed = table.clean(keep=1, grace=LATER)
    assert sorted(r.split("/")[0] for r in removed) == ["data", "manifests"] and [r for r in removed if r.endswith("_source=0")]
    assert content(table) == [("a", 22), ("b", 1)] and len(on_disk(root)) == 2
    assert table.clean(keep=1, grace=LATER, now=time.time() + 1) == []


def unbilled(spark, *rows):
    ddl = "patient_id string, dos date, visit_stage string, provider string, facility string"
    return spark.createDataFrame([(p, dt.date.fromisoformat(d), "Open", "A", "N") for p, d in rows], ddl)


def tracked(table):
    return sorted((r.patient_id, str(r.dos), str(r.run_date)) for r in table.read().collect())


def test_a_run_appends_once(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "tracker"))
    september = unbilled(spark, ("p1", "2025-09-01"), ("p2", "2025-09-02"))
    first = patient.append_unbilled(table, september, "2025-10-02")
    assert (first.version, first.rows, first.already) == (1, 2, False)
    again = patient.append_unbilled(table, september, "2025-10-02")
    assert (again.version, again.rows, again.already) == (1, 0, True)
    more = patient.append_unbilled(table, unbilled(spark, ("p2", "2025-09-02"), ("p3", "2025-09-03")), "2025-11-02")
    assert (more.version, more.rows) == (2, 1)
    assert tracked(table) == [("p1", "2025-09-01", "2025-10-02"), ("p2", "2025-09-02", "2025-10-02"), ("p3", "2025-09-03", "2025-11-02")]
    nothing = patient.append_unbilled(table, september, "2025-12-02")
    assert (nothing.version, nothing.rows) == (3, 0) and len(tracked(table)) == 3


def test_a_run_killed_half_way_is_run_again(spark, tmp_path, monkeypatch):
    table = FileTable(spark, str(tmp_path / "tracker"))
    rows = unbilled(spark, ("p1", "2025-09-01"))
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        patient.append_unbilled(table, rows, "2025-10-02")
    monkeypatch.undo()
    assert table.log.latest() == 0
    assert patient.append_unbilled(table, rows, "2025-10-02").rows == 1
    assert tracked(table) == [("p1", "2025-09-01", "2025-10-02")]


def test_two_runs_at_once_add_a_visit_once(spark, tmp_path):
    root = str(tmp_path / "tracker")
    rows, calls = unbilled(spark, ("p1", "2025-09-01")), []

    def late(known):
        if not calls:
            calls.append(patient.append_unbilled(FileTable(spark, root), rows, "2025-10-02", "other"))
        return patient.append_new_unbilled(rows.limit(0) if known is None else known, rows, "2025-10-02")

    done = FileTable(spark, root).append("own", late, dt.datetime(2025, 10, 2))
    assert calls[0].rows == 1 and (done.version, done.rows) == (2, 0)
    assert len(tracked(FileTable(spark, root))) == 1


def test_outputs_of_a_run_are_valid_together(spark, tmp_path):
    folder, a = str(tmp_path / "out"), spark.createDataFrame([(1, "x\ny"), (2, None)], "n int, t string")
    broken = a.withColumn("t", F.raise_error(F.lit("torn")).cast("string"))
    with pytest.raises(Exception, match="torn"):
        save_result_sets({"one": a, "two": a, "three": broken}, folder, "20250901_000000")
    assert runs.complete_runs(spark, folder) == []
    with pytest.raises(ValueError, match="no complete run"):
        runs.read_run(spark, folder)
    written = save_result_sets({"one": a, "two": a.limit(0)}, folder, "20250901_000000", skip_empty=["two"])
    assert list(written) == ["one"] and runs.complete_runs(spark, folder) == ["20250901_000000"]
    with pytest.raises(runs.RunExists, match="already exists"):
        save_result_sets({"one": a}, folder, "20250901_000000")
    save_result_sets({"one": a.limit(1), "two": a}, folder, "20250902_000000")
    assert runs.read_run(spark, folder)["one"].count() == 1
    assert sorted(map(tuple, runs.read_run(spark, folder, "20250901_000000")["one"].collect())) == [(1, "x\ny"), (2, None)]
    assert runs.remove_abandoned(spark, folder) == []
    gone = runs.remove_abandoned(spark, folder, LATER)
    assert {g.split("/")[0] for g in gone} >= {"one", "two"} and all("20250901" in g for g in gone)
    assert runs.read_run(spark, folder, "20250901_000000")["one"].count() == 2


def test_a_metrics_bundle_reads_back_as_it_was(spark, tmp_path):
    from revrecon.plans.report import all_metrics

    v = visits(spark, {}, {"patient_id": "p2", "provider": 'B "Q"\nx', "total_paid": 7, "facility": None}, {"visit_stage": "Open"})
    tables = all_metrics(v).tables
    written = export_metrics_bundle(tables, str(tmp_path), "20250901_000000")
    assert sorted(written) == ["facilities_csv", "insurance_csv", "providers_csv", "red_flags_json", "stages_csv", "summary_json"]
    back = read_metrics_bundle(spark, str(tmp_path))
    for name, df in back.items():
        numbers = [f.name for f in df.schema.fields if f.dataType.typeName() != "array"]
        want = tables[name].select(*[F.col(c).cast("double") if tables[name].schema[c].dataType.typeName() == "decimal" else F.col(c) for c in numbers])
        have = df.select(*[F.col(c).cast("double") if df.schema[c].dataType.typeName() == "decimal" else F.col(c) for c in numbers])
        assert sorted(map(str, have.collect())) == sorted(map(str, want.collect()))


def monthly_of(spark, tmp_path):
    from revrecon.functions.dates import month_key
    from revrecon.plans.incremental import refresh_months

    facts, monthly, derived = FileTable(spark, str(tmp_path / "facts")), FileTable(spark, str(tmp_path / "monthly")), []

    def derive(rows):
        derived.append(sorted({str(r.dos)[:7] for r in rows.select("dos").distinct().collect()}))
        return rows.groupBy(month_key("dos").alias("month")).agg(F.count("*").alias("n"), F.sum("total_paid").alias("paid"))

    def refresh():
        return refresh_months(facts, monthly, derive)

    def held():
        return sorted((str(r.month), r.n, int(r.paid)) for r in monthly.read().collect())

    return facts, monthly, derived, refresh, held


def dated(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("DOS,Patient,Total Paid\n" + "".join(f"{d},p,{n}\n" for d, n in rows))


def test_only_touched_months_are_derived_again(spark, tmp_path):
    land = tmp_path / "in"
    facts, monthly, derived, refresh, held = monthly_of(spark, tmp_path)
    dated(land, "a.csv", ("01/05/2025", 1), ("02/05/2025", 2))
    dated(land, "b.csv", ("02/06/2025", 4), ("03/05/2025", 8), ("", 16))
    facts.refresh(listing(spark, land), load(spark))
    assert refresh().months == ("2025-01", "2025-02", "2025-03", "undated")
    assert held() == [("2025-01", 1, 1), ("2025-02", 2, 6), ("2025-03", 1, 8), ("None", 1, 16)]
    assert refresh().months == () and len(derived) == 1

    dated(land, "a.csv", ("02/05/2025", 3), ("12/31/2025", 5))  # January goes, December comes
    facts.refresh(listing(spark, land), load(spark))
    before = {r.source_id: r.place for r in monthly.manifest().collect()}
    done = refresh()
    assert done.months == ("2025-01", "2025-02", "2025-12") and done.facts_version == 2
    assert derived[1] == ["2025-02", "2025-12"]
    assert held() == [("2025-02", 2, 7), ("2025-03", 1, 8), ("2025-12", 1, 5), ("None", 1, 16)]
    after = {r.source_id: r.place for r in monthly.manifest().collect()}
    assert {m for m in after if after[m] == before.get(m)} == {"2025-03", "undated"}

    dated(land, "c.csv", ("03/09/2025", 1))
    (land / "b.csv").unlink()
    facts.refresh(listing(spark, land), load(spark), drop_missing=True)
    assert refresh().months == ("2025-02", "2025-03", "undated")
    assert held() == [("2025-02", 1, 3), ("2025-03", 1, 1), ("2025-12", 1, 5)]


def test_a_monthly_run_that_dies_is_run_again(spark, tmp_path, monkeypatch):
    land = tmp_path / "in"
    facts, monthly, derived, refresh, held = monthly_of(spark, tmp_path)
    dated(land, "a.csv", ("01/05/2025", 1))
    facts.refresh(listing(spark, land), load(spark))
    refresh()
    dated(land, "a.csv", ("01/05/2025", 9), ("01/06/2025", 1))
    facts.refresh(listing(spark, land), load(spark))
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        refresh()
    monkeypatch.undo()
    assert held() == [("2025-01", 1, 1)]
    assert refresh().months == ("2025-01",) and held() == [("2025-01", 2, 10)]
