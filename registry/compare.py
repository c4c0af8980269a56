"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    return x


def canonical(names, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))
    return [names[i] for i in order], out


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    arrow = df.toArrow()
    got = canonical(df.columns, zip(*[c.to_pylist() for c in arrow.columns]))
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canonical(names, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        lacking = [r for r in want[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} rows != {len(want[1])} rows; only Spark {extra}, only SQL {lacking}"
    return None if got[1] else "no rows"


def main(sf_dir: str, keys: list[str]) -> int:
    from pyspark.sql import SparkSession

    from registry.entries import ENTRIES

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for key in keys or ENTRIES:
        start = time.time()
        try:
            problem = difference(ENTRIES[key].run(spark, sf_dir), con, ENTRIES[key].sql)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{key:22} {time.time() - start:6.2f}s {'ok' if problem is None else problem}",
              flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1], sys.argv[2:]))
