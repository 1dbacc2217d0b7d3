import os

import duckdb
import pytest

from veilgrid.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the tables")
@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    out = con.execute(oracle.SQL[name])
    columns = [c[0] for c in out.description]
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, out.fetchall())) and df.columns == columns
