"""Run registered queries in Spark and their SQL in DuckDB and compare names, types and rows.

    python tools/compare.py [folder with the test tables] [name prefixes ...]
"""

from __future__ import annotations

import collections
import pathlib
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from arrears_mart.registry.queries import ORACLES, QUERIES  # noqa: E402

_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def local_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark frame and the SQL's result, or nothing."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    mine = {f.name: f.dataType.simpleString() for f in df.schema}
    if sorted(mine) != sorted(theirs):
        return f"columns {sorted(set(mine) ^ set(theirs))}"
    types = {n: (t, theirs[n]) for n, t in mine.items() if _TYPES.get(t, t.upper()) != theirs[n].replace(" ", "")}
    if types:
        return f"types {types}"
    names = sorted(mine)
    order = [list(theirs).index(n) for n in names]
    expected = collections.Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = collections.Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if expected == found:
        return None
    extra, missing = list((found - expected).items())[:2], list((expected - found).items())[:2]
    return f"{found.total()} rows, expected {expected.total()}; only in Spark {extra}; only in SQL {missing}"


def main(folder: str, prefixes: list[str]) -> int:
    spark, con, bad = local_session(), connect(folder), 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = difference(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None and not found.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(args[0], args[1:]) > 0)
