"""Run each query in Spark and its statement in DuckDB over the same tables and compare whole results."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def database(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET threads = 4")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value):
    if value is None or isinstance(value, bool | str):
        return value
    if isinstance(value, int):
        return value
    number = float(value)
    return None if math.isnan(number) else float(f"{number:.12g}")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(row[k]) for k in order) for row in rows), key=repr)


def compare(spark, db, key, run, sql, sf_dir):
    """Differences between the two results as text, empty when they agree."""
    df = run(spark, sf_dir)
    mine = df.collect()
    if sql is None:
        return "" if mine else "no rows"
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    left, right = rows_of(df.columns, mine), rows_of(names, theirs)
    if left == right:
        return ""
    a, b = set(left), set(right)
    extra, missing = sorted(a - b, key=repr)[:2], sorted(b - a, key=repr)[:2]
    return f"rows {len(left)} / {len(right)}; only Spark {len(a - b)} {extra}; only SQL {len(b - a)} {missing}"


if __name__ == "__main__":
    import __spark_entry__ as entry

    from bazaar.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark, db, sql = local_session(8), database(folder), entry.oracle_sql()
    bad = 0
    for key in wanted:
        start = time.time()
        try:
            found = compare(spark, db, key, entry.queries()[key], sql.get(key), folder)
        except Exception as error:  # noqa: BLE001
            found = "ERROR " + str(error)[:600]
        bad += bool(found)
        kind = "sql" if key in sql else "rows"
        print(f"{'DIFF' if found else 'ok':5}{kind:5}{time.time() - start:7.2f}s {key} {found}", flush=True)
    print("differences:", bad)
