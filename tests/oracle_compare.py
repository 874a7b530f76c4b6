"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]

Comparison as the driver does it: row count, column names, and the
order-insensitive multiset of rows (columns sorted by name, floats rounded).
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
              "BOOLEAN": "boolean", "FLOAT": "float", "DATE": "date"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("ORACLE_STRICT") else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, str]:
    import __spark_entry__ as entry
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        if name not in oracle:
            results[name] = f"rows-only ({len(s_rows)} rows)"
        else:
            try:
                rel = con.sql(oracle[name])
                d_cols = rel.columns
                d_types = [str(t) for t in rel.types]
                d_rows = rel.fetchall()
            except Exception as e:  # noqa: BLE001
                results[name] = f"DUCKDB ERROR {e}"[:300]
                if verbose:
                    print(name, results[name], flush=True)
                continue
            s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            type_diff = {c: (s_types.get(c), t) for c, t in zip(d_cols, d_types)
                         if DUCK_TYPES.get(t, t.lower()) != s_types.get(c)}
            if sorted(s_cols) != sorted(d_cols):
                results[name] = f"COLUMNS spark={s_cols} duck={d_cols}"
            elif type_diff:
                results[name] = f"TYPES {type_diff}"
            elif len(s_rows) != len(d_rows):
                results[name] = f"ROWCOUNT spark={len(s_rows)} duck={len(d_rows)}"
            elif _rows(s_cols, s_rows) != _rows(d_cols, d_rows):
                a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                results[name] = f"VALUES differ, e.g. {diff}"
            else:
                results[name] = f"ok ({len(s_rows)} rows)"
        if verbose:
            print(f"{name}: {results[name]}  [{time.time() - t0:.1f}s]", flush=True)
    return results


if __name__ == "__main__":
    from lakenorm.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakenorm-oracle-"))
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} fine; failing: {sorted(bad)}")
