"""Row sets of two engines, made comparable."""

import math
import os

import duckdb
import numpy as np


def plain(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType") or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (float, np.floating)):
        return int(v) if float(v).is_integer() else float(f"{float(v):.9g}")
    if isinstance(v, (int, np.integer)):
        return int(v)
    return str(v)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(map(plain, r)) for r in frame[columns].itertuples(index=False)), key=repr)


def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}'")
    return c
