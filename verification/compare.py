"""Run queries and their SQL counterparts on one folder and compare rows, columns and values."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain values."""
    df = df[sorted(df.columns)]

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, (pd.Timestamp,)):
            return v.isoformat()
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and abs(v) < 1e15 and v == int(v):
            return int(v)
        if hasattr(v, "isoformat"):
            return v.isoformat()[:19]
        return v

    rows = [tuple(plain(v) for v in row) for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (int, float)) else (False, "n", x) for x in r))


def compare(spark, folder: str, names: list[str] | None = None) -> dict[str, str]:
    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    con, out = duck(folder), {}
    for name in names or list(ORACLES):
        t = time.time()
        try:
            ours = QUERIES[name](spark, folder).toPandas()
            t1 = time.time()
            theirs = con.execute(ORACLES[name]).df()
            t2 = time.time()
            if sorted(ours.columns) != sorted(theirs.columns):
                out[name] = f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
            elif len(ours) != len(theirs):
                out[name] = f"rows {len(ours)} vs {len(theirs)}"
            else:
                a, b = normal(ours), normal(theirs)
                bad = [(x, y) for x, y in zip(a, b) if x != y]
                kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns if str(ours[c].dtype) != str(theirs[c].dtype)}
                if kinds and not bad:
                    print(f"  {name}: column kinds differ {kinds}", flush=True)
                out[name] = "ok" if not bad else f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}"
            print(f"{name:26s} {t1 - t:6.1f}s {t2 - t1:6.1f}s {len(ours):8d} {out[name][:600]}", flush=True)
        except Exception as problem:
            out[name] = f"error {str(problem)[:700]}"
            print(f"{name:26s} {out[name]}", flush=True)
    return out


if __name__ == "__main__":
    from basketspark.session import build_session

    session = build_session(master="local[8]", shuffle_partitions=8, driver_memory="12g")
    result = compare(session, sys.argv[1], sys.argv[2:] or None)
    print(sum(v == "ok" for v in result.values()), "of", len(result), "ok")
