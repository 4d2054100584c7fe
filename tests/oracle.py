"""Runs registered queries beside their SQL and compares the rows.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    """A value both engines agree on."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else float(f"{value:.10g}")
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(frame, connection, sql):
    """None when equal, else a short description of the difference."""
    got = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}", len(got)
    if got == want:
        return None, len(got)
    extra, missing = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
    return f"{len(got)} rows against {len(want)}; only Spark {extra}; only SQL {missing}", len(got)


def main(sf_dir, chosen):
    import __spark_entry__ as entry
    from shelfmark.session import build_session
    spark = build_session("oracle", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(sf_dir), entry.oracle_sql(), []
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = function(spark, sf_dir)
            if name in sqls:
                difference, rows = compare(frame, connection, sqls[name])
            else:
                difference, rows = None, len(frame.collect())
        except Exception as error:  # report and go on with the next query
            difference, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        label = "FAIL" if difference else ("ok" if name in sqls else "rows-only")
        print(f"{label:9} {name:32} {rows:8} rows {time.time() - start:6.1f}s "
              f"{difference or ''}", flush=True)
        if difference:
            bad.append(name)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
