"""Run registered queries and their SQL counterparts side by side: ``python -m checks.compare SF_DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def canonical(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results agree, else what differs first."""
    got = spark_df.collect()
    cursor = con.execute(sql)
    names, kinds = [d[0] for d in cursor.description], {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    share = {"long": ("BIGINT",), "integer": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR", "STRING"), "boolean": ("BOOLEAN",)}
    for f in spark_df.schema.fields:
        if kinds[f.name].upper() not in share[f.dataType.typeName()]:
            return f"type of {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}"
    a, b = rows_of(spark_df.columns, [tuple(r) for r in got]), rows_of(names, want)
    if a == b:
        return None
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return f"{len(a)} rows vs {len(b)}; only spark {only_a}; only sql {only_b}"


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import REGISTRY
    from revrecon.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        if name not in ORACLES:
            print("NO SQL", name)
            continue
        try:
            problem = difference(REGISTRY[name](spark, sf_dir), con, ORACLES[name])
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print("ok  " if problem is None else "DIFF", name, f"{time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
