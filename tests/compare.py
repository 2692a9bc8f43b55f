"""Run registered queries beside their SQL and compare row counts, columns and values."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def value_rows(rows, names) -> list[tuple]:
    """Rows with columns in name order, as sorted tuples of exact texts."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs; empty if equal."""
    spark_rows, spark_names = spark_df.collect(), spark_df.columns
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    rows = cursor.fetchall()
    found = []
    if sorted(names) != sorted(spark_names):
        return [f"columns {sorted(spark_names)} against {sorted(names)}"]
    if len(rows) != len(spark_rows):
        found.append(f"{len(spark_rows)} rows against {len(rows)}")
    ours, theirs = value_rows(spark_rows, spark_names), value_rows(rows, names)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}")
    return found


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from plaudit.session import build_session

    spark = build_session(
        "compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, con, oracle[name]) if name in oracle else [f"(no SQL) {df.count()} rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found) and name in oracle
        print(f"{'ok  ' if not found else 'DIFF' if name in oracle else 'rows'} {name:30s} {time.time() - start:6.1f}s {'; '.join(found)}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
