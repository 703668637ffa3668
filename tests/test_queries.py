"""Every query of the core against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest
from conftest import DATA

from derrickflow.plans import registry

CON = duckdb.connect()
CON.sql("SET timezone = 'UTC'")
for path in glob.glob(f"{DATA}/*.parquet"):
    CON.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: "" if v is None else f"{round(v, 6) + 0.0:.6f}" if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, DATA)
    rows = df.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    rel = CON.sql(sql)
    assert canon(rows, df.columns) == canon(rel.fetchall(), rel.columns)
