"""Runs queries beside their DuckDB SQL: python tests/compare.py [sf] [name …]. Prints one line per query."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def compare(spark, con, query, sql, sf_dir):
    """'' when equal, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted(tuple(canonical(r[n]) for n in names) for r in df.collect())
    if sql is None:
        return f"rows only ({len(ours)})"
    got = con.execute(sql)
    theirs_names = [d[0] for d in got.description]
    if sorted(theirs_names) != names:
        return f"columns {names} / {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = sorted(tuple(canonical(r[i]) for i in at) for r in got.fetchall())
    if ours == theirs:
        return "" if ours else "EMPTY"
    only = [r for r in ours if r not in set(theirs)][:2]
    lack = [r for r in theirs if r not in set(ours)][:2]
    return f"rows {len(ours)} / {len(theirs)}; {names}; ours {only}; theirs {lack}"


def main():
    from meterloom.plans.oracle import ORACLE
    from meterloom.plans.queries import QUERIES
    from meterloom.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, bad = local_session("8", "compare"), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            said = compare(spark, con, QUERIES[name], ORACLE.get(name), sf_dir)
        except Exception as exc:
            said = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(said) and not said.startswith("rows only")
        print(f"{time.time() - start:6.1f}s {name}: {said or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
