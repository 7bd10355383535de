"""Run the registered queries beside their SQL and compare.

    python tools/check_queries.py [sf_dir] [query ...]
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from scanledger.plans.checks import all_checks  # noqa: E402
from scanledger.plans.queries import all_queries  # noqa: E402
from scanledger.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if value != value else round(value, 9)
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name, query, sql):
    start = time.time()
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    middle = time.time()
    if sql is None:
        return f"rows only, {len(got)} rows, {middle - start:.1f}s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    took = f"spark {middle - start:.1f}s duckdb {time.time() - middle:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} against {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in result.description}
    differ = [
        f"{f.name} {f.dataType.simpleString()}/{types[f.name]}"
        for f in df.schema
        if SQL_TYPES.get(f.dataType.simpleString()) != types[f.name]
    ]
    if differ:
        return f"FAIL types {differ}"
    if got == want:
        return f"ok, {len(got)} rows, {took}"
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"FAIL {len(got)} against {len(want)} rows, {took}\n   spark {str(only_got)[:700]}\n   duckdb {str(only_want)[:700]}"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    checks = all_checks()
    failed = 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            outcome = compare(spark, con, sf_dir, name, query, checks.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            outcome = f"FAIL {type(error).__name__}: {str(error)[:900]}"
        failed += outcome.startswith("FAIL")
        print(f"{name:32s} {outcome}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
