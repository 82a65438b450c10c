"""Run queries and their SQL side by side: python tests/oracle_check.py SF_DIR [NAME ...]"""

import datetime
import decimal
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(value):
    if isinstance(value, bool):
        return "bool"
    return {int: "int", float: "float", str: "str", datetime.date: "date", type(None): None,
            decimal.Decimal: "decimal", datetime.datetime: "datetime"}.get(type(value),
                                                                        type(value).__name__)


def differences(spark_df, con, sql):
    """A list of what differs: column names, row counts, types, values."""
    names = sorted(spark_df.columns)
    ours = [tuple(r[n] for n in names) for r in spark_df.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(columns) != names:
        return [f"columns {names} != {sorted(columns)}"]
    order = [columns.index(n) for n in names]
    theirs = [tuple(r[i] for i in order) for r in rows]
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    ours, theirs = sorted(ours, key=repr), sorted(theirs, key=repr)
    for a, b in zip(ours, theirs):
        for name, x, y in zip(names, a, b):
            if kind(x) != kind(y) or x != y:
                found.append(f"{name}: {x!r} != {y!r}")
    return found


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, con, sqls[name]) if name in sqls else [
                ] if df.collect() else ["no rows"]
        except Exception as e:  # report and go on
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        label = "ok  " if not found else "FAIL"
        print(f"{label} {name} {time.time() - started:.1f}s "
              f"{'' if name in sqls else '(rows only)'} {len(found)} {found[:3]}", flush=True)
        failed += [name] * bool(found)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
