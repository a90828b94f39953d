"""Run registered queries and compare each with its SQL twin in DuckDB.

    python tools/check_queries.py [data_dir] [name ...]
"""

from __future__ import annotations

import importlib.util
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Spark type to the DuckDB types that hold the same values.
TYPES = {"bigint": ("BIGINT",), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR",), "boolean": ("BOOLEAN",)}


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def connect(data_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", repr(v + 0.0))
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("i", str(v))
    if hasattr(v, "item"):
        return norm(v.item())
    return ("s", str(v))


def key(row):
    return tuple(norm(v) for v in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    names = sorted(spark_df.columns)
    left = sorted(key(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    if sorted(cols) != names:
        return False, f"columns {names} vs {sorted(cols)}"
    types = {c[0]: str(c[1]) for c in rel.description}
    odd = {n: (t, types[n]) for n, t in spark_df.dtypes if types[n] not in TYPES.get(t, (types[n],))}
    order = [cols.index(n) for n in names]
    right = sorted(key([r[i] for i in order]) for r in rel.fetchall())
    if len(left) != len(right):
        return False, f"rows {len(left)} vs {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(left)} rows differ, e.g. {dict(zip(names, bad[0][0]))} vs {dict(zip(names, bad[0][1]))}"
    return True, f"{len(left)} rows" + (f"; TYPES {odd}" if odd else "")


def main(argv: list[str]) -> int:
    from arealis.session import build_session

    data_dir = argv[0] if argv else "/root/testdata/sf0.01"
    entry = load_entry()
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = argv[1:] or list(queries)
    spark = build_session("check", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(data_dir)
    failed = 0
    for name in wanted:
        t = time.time()
        try:
            df = queries[name](spark, data_dir)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{df.count()} rows (no SQL twin)"
        except Exception as e:  # report and go on with the other queries
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - t:6.1f}s {name}: {note}", flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
