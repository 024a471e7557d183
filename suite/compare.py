"""Run registered queries against their SQL twins: ``python -m suite.compare <sf_dir> [names]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from basketline.session import configured
from suite.oracle import ORACLE_SQL
from suite.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("basketline")
    local = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = configured(builder, **local).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(v is not None, str(v)) for v in row])


def _same(a, b, tolerance: float) -> bool:
    if isinstance(a, float) and isinstance(b, float) and tolerance:
        return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance) or (math.isnan(a) and math.isnan(b))
    return a == b and isinstance(a, type(b))


def differences(
    ours: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, tolerance: float = 0.0
) -> list[str]:
    """What differs between a frame and the result of ``sql``; empty when equal to the last bit."""
    result = con.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    if sorted(ours.columns) != sorted(theirs_columns):
        return [f"columns {sorted(ours.columns)} against {sorted(theirs_columns)}"]
    theirs = _rows(theirs_columns, result.fetchall())
    mine = _rows(ours.columns, [tuple(r) for r in ours.collect()])
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows against {len(theirs)}"]
    pairs = zip(mine, theirs, strict=True)
    wrong = [(a, b) for a, b in pairs if not all(map(_same, a, b, [tolerance] * len(a)))]
    return [f"{len(wrong)} rows differ; {a} against {b}" for a, b in wrong[:3]]


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.perf_counter()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLE_SQL:
                found = differences(frame, con, ORACLE_SQL[name])
                note = "; ".join(found) or "equal"
            else:
                found, note = [], f"{len(frame.collect())} rows, no SQL twin"
        except Exception as error:  # report every query, then fail
            found = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.perf_counter() - started:6.2f}s {name}: {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
