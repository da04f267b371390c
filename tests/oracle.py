"""Compare a registered query with its oracle; ``python tests/oracle.py <sf_dir> [name ..]`` prints a table."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return v.item()
    return v


def differs(spark, con, fn, sql, sf) -> str | None:
    df = fn(spark, sf)
    cols = sorted(df.columns)
    mine = sorted([tuple(norm(r[c]) for c in cols) for r in df.collect()], key=repr)
    if sql is None:
        return None if mine else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} / {sorted(rel.columns)}"
    theirs = sorted([tuple(norm(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()], key=repr)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} / {b}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for c, t in df.dtypes:
        if TYPES.get(t) != kinds[c]:
            return f"type of {c}: {t} / {kinds[c]}"
    return None if mine else "both empty"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as e
    from gaugeworks.session import build_session
    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con, oracles = connect(sf), e.oracle_sql()
    for name, fn in e.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            bad = differs(spark, con, fn, oracles.get(name), sf)
        except Exception as ex:  # noqa: BLE001
            bad = f"{type(ex).__name__}: {str(ex)[:400]}"
        mark = "ok " if bad is None else "BAD"
        print(f"{mark} {name} {'sql' if name in oracles else 'rows'} {time.time() - t:.1f}s {bad or ''}", flush=True)


if __name__ == "__main__":
    main()
