import datetime as dt
import itertools
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revrecon.sinks.tables import as_table, export_csv, export_json, save_result_sets
from revrecon.sources import catalog, exports, files, ledger_sheet


def test_visits_file(spark, tmp_path):
    f = tmp_path / "visits.csv"
    f.write_text(
        "DOS,Patient,Patient Account Number,Total Paid,Last Billed,Unused\n"
        '09/01/2025,"Doe, Jane",p1,"$1,234.56",(5.00),x\n'
        "13/45/2025,Roe,p2,abc,,y\n"
    )
    a, b = exports.read_visits(spark, str(f)).orderBy("row_no").collect()
    assert (a.patient_id, a.patient_name, a.dos, a.total_paid, a.last_billed) == (
        "p1", "Doe, Jane", dt.date(2025, 9, 1), Decimal("1234.56"), None,
    )
    assert (b.dos, b.total_paid) == (None, None)
    zero = exports.read_visits(spark, str(f), missing_money_is_zero=True).orderBy("row_no").collect()
    assert [r.last_billed for r in zero] == [Decimal("5.00"), Decimal("0.00")]


def test_quotes_and_line_breaks_in_cells(spark, tmp_path):
    f = tmp_path / "visits.csv"
    f.write_text('Patient,Provider,Total Paid\n"Doe, ""JJ"" Jane",A,"$1,000.00"\n"Roe,\nRob",B,2\n')
    rows = exports.read_visits(spark, str(f), quoted_newlines=True).orderBy("row_no").collect()
    assert [(r.patient_name, r.provider, r.total_paid) for r in rows] == [
        ('Doe, "JJ" Jane', "A", Decimal("1000.00")), ("Roe,\nRob", "B", Decimal("2.00"))]
    g = tmp_path / "plain.csv"
    g.write_text('Patient,Total Paid\n"Doe, ""JJ"" Jane",1\n')
    assert exports.read_visits(spark, str(g)).first().patient_name == 'Doe, "JJ" Jane'
    out = export_csv(spark.createDataFrame([(' say "hi", you ',)], "t string"), str(tmp_path / "out"))
    lines = {line for part in (tmp_path / "out").glob("part-*") for line in part.read_text().splitlines()}
    assert lines == {"t", '" say ""hi"", you "'}
    assert spark.read.csv(out, header=True, escape='"').first().t == ' say "hi", you '


def test_deposits_by_path_pattern(spark, tmp_path):
    line = ",Transaction date,Transaction type,Num,Customer,Vendor,Memo,Cleared,Amount\nX,09/01/2025,Deposit,,,,m,C,{}\n"
    for name in ("north", "southern"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(line.format(len(name)))
    got = exports.read_deposits(spark, {"North": f"{tmp_path}/north/*.csv", "South": f"{tmp_path}/southern/*.csv"}).collect()
    assert {(r.facility, int(r.amount)) for r in got} == {("North", 5), ("South", 8)}


def test_empty_visits_are_rejected(spark, tmp_path):
    f = tmp_path / "visits.csv"
    f.write_text("DOS,Patient\n")
    with pytest.raises(ValueError, match="no data rows"):
        exports.read_visits(spark, str(f))


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_claims_file_in_utf16(spark, tmp_path, newline):
    f = tmp_path / "claims.tsv"
    lines = [
        "Patient Name (First Last)\tService Date\tCharges\tCurrent Balance",
        "Jané Doe\t9/1/2025\t$1,000.00\t(5.00)",
        "Rob Roe\t2025-09-02\t\t7",
    ]
    f.write_bytes((newline.join(lines) + newline).encode("utf-16"))  # with byte-order mark
    rows = exports.read_claims(spark, str(f)).orderBy("row_no").collect()
    assert [(r.patient_name, str(r.service_date), r.charges, r.current_balance) for r in rows] == [
        ("Jané Doe", "2025-09-01", Decimal("1000.00"), Decimal("5.00")),
        ("Rob Roe", "2025-09-02", Decimal("0.00"), Decimal("7.00")),
    ]


def test_line_ordinal_follows_the_file_when_it_is_split(spark, tmp_path):
    f = tmp_path / "long.csv"
    f.write_text("n,pad\n" + "".join(f"{i},{'x' * (i % 50)}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = files.read_delimited(spark, str(f))
        assert raw.rdd.getNumPartitions() > 5
        rows = raw.select(F.col("n").cast("int").alias("n"), "row_no").orderBy("row_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.n for r in rows] == list(range(5000))
    assert len({r.row_no for r in rows}) == 5000


def test_deposit_file(spark, tmp_path):
    f = tmp_path / "deposits.csv"
    f.write_text(
        "Some Clinic,,,,,,,,\n"
        ",01/01/2025,,,,,,,9.00\n"
        ",Transaction date,Transaction type,Num,Customer,Vendor,Memo,Cleared,Amount\n"
        "Checking,,,,,,,,\n"
        ',09/01/2025,Deposit,,,,card,Cleared,"1,000.00"\n'
        ',09/01/2025,Deposit,,,,card,Reconciled,"1,000.00"\n'
        ",09/02/2025,Deposit,,,,,Cleared,\n"
        ",as of 09/03/2025,Deposit,,,,late,Cleared,5\n"
        'Total for Checking,,,,,,,,"2,000.00"\n'
    )
    rows = exports.read_deposits(spark, {"North": str(f)}).orderBy("row_no").collect()
    assert [(str(r.txn_date), r.amount, r.cleared, r.facility) for r in rows] == [
        ("2025-09-01", Decimal("1000.00"), "Cleared", "North"),
        ("2025-09-01", Decimal("1000.00"), "Reconciled", "North"),
        ("None", Decimal("5.00"), "Cleared", "North"),
    ]


SHEET = """Some Clinic LLC,,,,
Profit and Loss,,,,
Distribution account,September 2025,October 2025,November 2025,Total
Income,,,,
Services,"$1,000.00",-,$3.00,
SUBLEASE,50,,0,
Total for Income,"$1,050.00",,$3.00,
Cost of Goods Sold,,,,
Supplies,9,9,9,
Gross Profit,1,1,1,
Expenses,,,,
Contract labor,20,30,bad,
   Rent   ,5,,,
Total for Expenses,25,30,,
Net Income,"$1,025.00",-30,3,
Services,7,7,7,
"""


def test_pl_sheet(spark, tmp_path):
    f = tmp_path / "pl.csv"
    f.write_text(SHEET)
    rows = ledger_sheet.read_pl_long(spark, {"North": str(f)}, ["Services"]).collect()
    got = {(r.type, r.category, r.month): (r.amount, r.is_patient_revenue) for r in rows}
    assert got == {
        ("Income", "Services", "2025-09"): (Decimal("1000.00"), True),
        ("Income", "Services", "2025-11"): (Decimal("3.00"), True),
        ("Income", "SUBLEASE", "2025-09"): (Decimal("50.00"), False),
        ("Expense", "Contract labor", "2025-09"): (Decimal("20.00"), False),
        ("Expense", "Contract labor", "2025-10"): (Decimal("30.00"), False),
        ("Expense", "Rent", "2025-09"): (Decimal("5.00"), False),
    }
    cells = ledger_sheet.read_pl_cells(spark, {"North": str(f)})
    assert {r.month for r in cells.collect()} == {"2025-09", "2025-10", "2025-11"}
    lines = {(r.line_item, r.month): r.amount for r in ledger_sheet.pl_key_lines(cells).collect()}
    assert lines["Net Income", "2025-10"] == Decimal("-30.00")
    assert lines["Total for Expenses", "2025-11"] == 0
    assert len(lines) == 12
    cell = ledger_sheet.pl_cell_lookup(cells, "Contract labor", "2025-11").collect()
    assert [r.amount for r in cell] == [None]
    assert ledger_sheet.pl_cell_lookup(cells, "Rent", "2031-01").count() == 0


def test_two_pl_sheets_with_other_months(spark, tmp_path):
    a, b = tmp_path / "A Clinic_Profit and Loss.csv", tmp_path / "B+1.csv"
    a.write_text(SHEET)
    b.write_text(
        '"Acct, all",May 2024,June 2024,July 2024,August 2024\r\nIncome,,,,\r\n'
        '"Fees, ""net""",1,2,"3,000.50",\r\nTotal for Income,1,2,3,4\r\n'
    )
    rows = ledger_sheet.read_pl_long(spark, {"A": str(a), "B": str(b)}, ["Services"]).filter("facility = 'B'").collect()
    assert {(r.category, r.month, r.amount) for r in rows} == {
        ('Fees, "net"', "2024-05", Decimal("1.00")), ('Fees, "net"', "2024-06", Decimal("2.00")),
        ('Fees, "net"', "2024-07", Decimal("3000.50")),
    }


def test_patient_master_shapes(spark, tmp_path):
    listed = tmp_path / "listed.json"
    listed.write_text(json.dumps({"patients": [
        {"master_id": "p1", "patient_name": "Jane Doe", "date_of_birth": "1/2/1980"},
        {"master_id": "p2", "patient_name": "Rob Roe", "date_of_birth": "1/3/1980"},
    ]}, indent=1))
    flat = tmp_path / "flat.json"
    flat.write_text(json.dumps({"JANE DOE": "p1", "ROB ROE": "p2"}, indent=1))
    a = exports.read_patients(spark, str(listed)).orderBy("row_no").collect()
    b = exports.read_patients(spark, str(flat)).orderBy("row_no").collect()
    assert [(r.master_id, r.patient_name, r.date_of_birth) for r in a] == [
        ("p1", "Jane Doe", "1/2/1980"), ("p2", "Rob Roe", "1/3/1980")]
    assert [(r.master_id, r.patient_name, r.date_of_birth) for r in b] == [("p1", "JANE DOE", None), ("p2", "ROB ROE", None)]


def test_refresh_only_when_changed(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    old, new = dt.datetime(2025, 9, 1), dt.datetime(2025, 9, 2)
    assert catalog.refresh_table(spark, spark.range(3), "t", "f", old, warehouse, loaded_at=old)
    assert not catalog.refresh_table(spark, spark.range(9), "t", "f", old, warehouse)
    assert catalog.refresh_table(spark, spark.range(5), "t", "f", new, warehouse, loaded_at=new)
    assert catalog.refresh_table(spark, spark.range(4), "t", "f", new, warehouse, force=True, loaded_at=dt.datetime(2025, 9, 3))
    assert catalog.read_table(spark, warehouse, "t").count() == 4
    with pytest.raises(ValueError, match="never loaded"):
        catalog.read_table(spark, warehouse, "u")
    status = catalog.cache_status(catalog.read_load_log(spark, warehouse)).collect()
    assert [(r.table_name, r.modified, r.loaded_at) for r in status] == [("t", new, dt.datetime(2025, 9, 3))]


def test_file_listing_and_snapshots(spark, tmp_path):
    names = ["run_20250901_000000.csv", "run_20250903_000000.csv", "run_20250902_000000.md", "old_20250101_000000.csv",
             "plain_.csv", "other.csv"]
    for n in names:
        (tmp_path / n).write_text("x")
    listing = catalog.list_files(spark, str(tmp_path))
    assert sorted(r.file_name for r in listing.collect()) == sorted(names)
    plan = catalog.snapshot_retention_plan(listing, ["run_", "old_", "plain_"], dt.datetime(2025, 9, 5))
    assert {r.file_name: r.action for r in plan.collect()} == {
        "run_20250901_000000.csv": "delete", "run_20250903_000000.csv": "keep", "run_20250902_000000.md": "keep",
        "old_20250101_000000.csv": "delete", "plain_.csv": "keep",
    }


def test_exports_read_back(spark, tmp_path):
    df = as_table(spark, {"a": [1, 2], "b": ["x", None]})
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, None)]
    assert as_table(spark, {"a": 1, "b": "x"}).count() == 1
    path = export_csv(df.withColumn("c", F.array(F.lit(1), F.lit(2))), str(tmp_path / "csv"))
    back = spark.read.csv(path, header=True).orderBy("a").collect()
    assert [(r.a, r.b, r.c) for r in back] == [("1", "x", "1 | 2"), ("2", None, "1 | 2")]
    money = spark.createDataFrame([(Decimal("1.50"),)], "m decimal(18,2)")
    assert spark.read.json(export_json(money, str(tmp_path / "json"))).first().m == 1.5
    written = save_result_sets({"full": df, "empty": df.limit(0)}, str(tmp_path / "run"), "20250901_000000", ["empty"])
    assert list(written) == ["full"]
    with pytest.raises(Exception, match="already exists"):
        save_result_sets({"full": df}, str(tmp_path / "run"), "20250901_000000")


def test_row_numbers_follow_file_names_and_never_repeat(spark, tmp_path):
    names = [f"claims_2025_{m}.csv" for m in range(1, 13)] + ["x/part-00000-u-c000.csv", "x/part-00000-u-c001.csv", "y/part-00000-u-c000.csv"]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"Key\n{i}a\n{i}b\n")
    rows = files.read_delimited(spark, [f"{tmp_path}/*.csv", f"{tmp_path}/[xy]/*.csv"]).orderBy("row_no").collect()
    assert [r.Key for r in rows] == [f"{i}{c}" for i in range(len(names)) for c in "ab"]
    assert len({r.row_no for r in rows}) == len(rows)


def test_exports_with_other_columns(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("Patient,Total Paid\nJane,1\n")
    b.write_text("Total Paid,Provider,Patient\n2,A,Rob\n")
    rows = exports.read_visits(spark, [str(a), str(b)]).orderBy("row_no").collect()
    assert [(r.patient_name, r.provider, r.total_paid) for r in rows] == [("Jane", None, 1), ("Rob", "A", 2)]
    b.write_text("Total Paid,Patient\n2,Rob\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        exports.read_visits(spark, f"{tmp_path}/*.csv").collect()
    b.write_text("Patient,Total Paid\n")
    with pytest.raises(ValueError, match="no data rows in .*b.csv"):
        exports.read_visits(spark, [str(a), str(b)])


def test_deposit_header_per_file(spark, tmp_path):
    (tmp_path / "2024.csv").write_text("Transaction date\nX,09/01/2024,Deposit,,,,m,C,1\n")
    (tmp_path / "2025.csv").write_text("X,09/01/2025,Deposit,,,,m,C,2\n,Transaction date\nX,09/02/2025,Deposit,,,,m,C,3\n")
    rows = exports.read_deposits(spark, {"North": f"{tmp_path}/*.csv"}).collect()
    assert sorted((str(r.txn_date), r.amount) for r in rows) == [("2024-09-01", 1), ("2025-09-02", 3)]
    (tmp_path / "2026.csv").write_text("X,09/01/2026,Deposit,,,,m,C,4\n")
    with pytest.raises(Exception, match="no header line"):
        exports.read_deposits(spark, {"North": f"{tmp_path}/*.csv"}).collect()


def test_two_years_of_one_facility(spark, tmp_path):
    (tmp_path / "2024.csv").write_text("x,January 2024,February 2024,March 2024\nIncome,,,\nServices,1,2,3\n")
    (tmp_path / "2025.csv").write_text("x,March 2025,February 2025,January 2025\nServices,7,7,7\nExpenses,,,\nRent,4,5,6\n")
    rows = ledger_sheet.read_pl_long(spark, {"North": f"{tmp_path}/*.csv"}, ["Services"]).collect()
    assert {(r.type, r.category, r.month): int(r.amount) for r in rows} == {
        ("Income", "Services", "2024-01"): 1, ("Income", "Services", "2024-02"): 2, ("Income", "Services", "2024-03"): 3,
        ("Expense", "Rent", "2025-03"): 4, ("Expense", "Rent", "2025-02"): 5, ("Expense", "Rent", "2025-01"): 6,
    }
    (tmp_path / "2026.csv").write_text("x,January 2026\nIncome,\n")
    with pytest.raises(Exception, match="no line of months"):
        ledger_sheet.read_pl_long(spark, {"North": f"{tmp_path}/*.csv"}, []).collect()


@pytest.mark.parametrize(
    "line, is_open",
    [
        ('a,b,c', False), ('"a",b', False), ('"a', True), ('a,"b', True), ('a,"b ""c', True), ('a,"b ""c"', False), ('a,"b""', True),
        ('5" pipe,b', False), ('5" pipe,"note', True), ('"a","b","c d', True), ('"a"x,"b', True), ('"a"x,b"', False), ('', False), ('"', True),
        ('""', False), ('"""', True), (',,"', True), ('a, "b', False), ('"a,b', True), ('"a,b",c', False), ('"' + 'x' * 200_000, True),
        ('a,' * 3000 + '"b', True),
    ],
)
def test_lines_that_end_inside_a_cell(spark, line, is_open):
    pattern = files._open_cell(",")
    assert spark.createDataFrame([(line,)], "value string").select(F.col("value").rlike(pattern)).first()[0] is is_open


def test_line_breaks_in_cells_are_found(spark, tmp_path):
    folder = tmp_path / "visits export [1]"
    folder.mkdir()
    head = "Patient,Provider,Total Paid\n"
    (folder / "v1.csv").write_text(head + '"Roe,\nRob ""X""\n\nend",A,1\nplain,5" b,2\n')
    (folder / "v2.csv").write_text(head + "".join(f'P{i},"B, ""{i}""",3\n' for i in range(3000)))
    (folder / "v10.csv").write_text(head + 'x,"first\nsecond",4\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        path = str(folder).replace("[", "\\[").replace("]", "\\]")
        visits = exports.read_visits(spark, path)
        rows = visits.orderBy("row_no").collect()
        n_tasks = visits.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n_tasks > 5  # the long file without such cells is still split
    assert [r.patient_name for r in rows[:2]] == ['Roe,\nRob "X"\n\nend', "plain"] and rows[1].provider == '5" b'
    assert [r.patient_name for r in rows[2:-1]] == [f"P{i}" for i in range(3000)]
    assert (rows[-1].patient_name, rows[-1].provider, rows[-1].total_paid) == ("x", "first\nsecond", Decimal("4.00"))
    assert len({r.row_no for r in rows}) == len(rows) == 3003


def test_only_files_with_open_cells_are_read_whole(spark, tmp_path):
    for name, cell in (("a", '"one\ntwo"'), ("b", "one")):
        (tmp_path / f"{name}.csv").write_text(f"Patient,Provider\n{cell},{name}\n")
    found = files.files_with_open_cells(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.csv"]
    reads = []

    def read(whole):
        reads.append(whole)
        return spark.read.options(header=True, multiLine=whole).csv(str(tmp_path))

    split, whole = files.whole_and_split(read, found)
    assert reads == [False, True]
    assert [r.Provider for r in split.collect()] == ["b"] and [r.Patient for r in whole.collect()] == ["one\ntwo"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # a task per file
    try:
        counts = [df.rdd.getNumPartitions() for df in (read(False), split, whole)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert counts == [2, 1, 1]  # the other file is not opened


def test_line_breaks_in_claims_and_deposits(spark, tmp_path):
    folder = tmp_path / "claims"
    folder.mkdir()
    head, last = "Patient Name (First Last)\tService Date\tOffice Key\tCharges\r\n", 'Rob Roe\t9/2/2025\t5" y\t2\r\n'
    (folder / "a.tsv").write_bytes((head + '"Jané\r\nDoe"\t9/1/2025\tx\t$1.00\r\n' + last).encode("utf-16"))
    (folder / "b.tsv").write_bytes((head + last).encode("utf-16"))
    for path, n in ((folder / "a.tsv", 2), (folder, 3)):
        rows = exports.read_claims(spark, str(path)).orderBy("row_no").collect()
        got = [(r.patient_name.replace("\r", ""), r.charges) for r in rows]
        assert got == [("Jané\nDoe", Decimal("1.00")), ("Rob Roe", Decimal("2.00")), ("Rob Roe", Decimal("2.00"))][:n]
    g = tmp_path / "deposits.csv"
    g.write_text(
        ",Transaction date,Transaction type,Num,Customer,Vendor,Memo,Cleared,Amount\n"
        ',09/01/2025,Deposit,,,,"card\nof two ""lines""",Cleared,"1,000.00"\n'
        ",09/02/2025,Deposit,,,,m,Cleared,5\n"
    )
    plain = tmp_path / "plain.csv"
    plain.write_text(",Transaction date,Transaction type,Num,Customer,Vendor,Memo,Cleared,Amount\nX,09/03/2025,Deposit,,,,n,C,7\n")
    rows = exports.read_deposits(spark, {"North": str(g), "South": str(plain)}).orderBy("row_no").collect()
    assert [(r.memo, r.amount, r.facility) for r in rows] == [
        ('card\nof two "lines"', Decimal("1000.00"), "North"), ("m", Decimal("5.00"), "North"), ("n", Decimal("7.00"), "South")]


def test_open_lines_are_those_of_the_pattern(spark):
    lines = ["".join(x) for n in range(8) for x in itertools.product('",a', repeat=n)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    row = df.select(files._ends_open(",").alias("fast"), F.col("value").rlike(files._open_cell(",")).alias("full")).agg(
        F.count_if("full").alias("n"), F.count_if(F.col("fast") != F.col("full")).alias("other")).first()
    assert row.n > 100 and row.other == 0


def test_deposit_lines_stay_where_they_are_read(spark, tmp_path):
    """What depends on the file alone is worked out once per file; only header positions are exchanged."""
    line = ",Transaction date,Transaction type,Num,Customer,Vendor,Memo,Cleared,Amount\nX,09/01/2025,Deposit,,,,m,C,{}\n"
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}+1 x.csv").write_text(line.format(ord(name)))
    df = exports.read_deposits(spark, {"North": f"{tmp_path}/a*", "South": f"{tmp_path}/[bc]*"})
    assert [(r.facility, int(r.amount)) for r in df.orderBy("row_no").collect()] == [("North", 97), ("South", 98), ("South", 99)]
    plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "regexp_replace" not in plan


def test_several_patient_masters_in_order(spark, tmp_path):
    (tmp_path / "master_2.json").write_text(json.dumps({"patients": [{"master_id": "1", "patient_name": "Doe, Jane"}, {"master_id": "2", "patient_name": "Roe, Rob"}]}))
    (tmp_path / "master_10.json").write_text(json.dumps({"DOE, JANE": "7", "POE, PAT": "3"}))
    (tmp_path / "master_1.json").write_text(json.dumps({"patients": [{"master_id": "9", "patient_name": "Doe, Jane"}]}))
    rows = exports.read_patients(spark, f"{tmp_path}/*.json").orderBy("row_no").collect()
    assert [(r.master_id, r.patient_name) for r in rows] == [
        ("9", "Doe, Jane"), ("1", "Doe, Jane"), ("2", "Roe, Rob"), ("7", "DOE, JANE"), ("3", "POE, PAT")]
    assert len({r.row_no for r in rows}) == 5
    assert {r.patient_name.upper(): r.master_id for r in rows}["DOE, JANE"] == "7"
