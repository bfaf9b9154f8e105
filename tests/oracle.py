"""Runs registered queries against their SQL in DuckDB and reports differences. Also a script:

python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def kind(data_type: pa.DataType) -> str:
    """Types that hold the same values count as equal: large and small strings, timestamp units."""
    if pa.types.is_string(data_type) or pa.types.is_large_string(data_type):
        return "string"
    if pa.types.is_timestamp(data_type):
        return "timestamp" if data_type.tz is None else "timestamp with zone"
    return str(data_type)


def canonical(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    types = {name: kind(table.schema.field(name).type) for name in names}
    rows = [tuple(row[name] for name in names) for row in table.to_pylist()]
    return types, sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    (types, rows), (sql_types, sql_rows) = canonical(spark_table), canonical(sql_table)
    problems = []
    if types != sql_types:
        names = [n for n in {**types, **sql_types} if types.get(n) != sql_types.get(n)]
        problems += [f"column {n}: spark {types.get(n)}, sql {sql_types.get(n)}" for n in names]
    if len(rows) != len(sql_rows):
        problems.append(f"rows: spark {len(rows)}, sql {len(sql_rows)}")
    if rows != sql_rows:
        ours, theirs = set(map(repr, rows)), set(map(repr, sql_rows))
        problems += [f"only spark: {row}" for row in sorted(ours - theirs)[:2]]
        problems += [f"only sql:   {row}" for row in sorted(theirs - ours)[:2]]
        if ours == theirs and not problems:
            problems.append("rows repeat differently")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from layerloom.session import local_session

    spark, con = local_session(8), connect(sf_dir)
    queries, sqls, failed = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            ours = queries[name](spark, sf_dir).toArrow()
            spent = time.time() - start
            start = time.time()
            problems = differences(ours, con.sql(sqls[name]).to_arrow_table()) if name in sqls else []
            note = f"{len(ours)} rows, spark {spent:.2f}s, sql {time.time() - start:.2f}s"
        except Exception as error:  # the report goes on with the other queries
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        state = "FAIL" if problems else "ok  " if name in sqls else "rows"
        print(f"{state} {name}: {note}", *problems, sep="\n       ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(bool(main(sf, args)))
