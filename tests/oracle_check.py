"""Run registered queries next to their SQL twins and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_on(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, run, sql: str) -> list[str]:
    """Differences between the two results, empty when they agree."""
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    types = dict(zip(names, (str(d[1]) for d in cursor.description)))
    expected = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if name in types and expected.get(kind) != types[name]:
            problems.append(f"type of {name}: {kind} vs {types[name]}")
    if ours != theirs:
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; "
            f"only ours {list((ours - theirs).items())[:2]}; "
            f"only theirs {list((theirs - ours).items())[:2]}"
        )
    return problems


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_on(sf_dir)
    sqls = contract.oracle_sql()
    bad = 0
    for name, run in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            problems = compare(spark, con, sf_dir, run, sqls[name])
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - begin:.1f}s", flush=True)
        for problem in problems:
            print("    ", problem)
    print("failed:", bad)


if __name__ == "__main__":
    main()
