"""Every registered query of the time-series part against its DuckDB oracle, at the smallest scale."""

import math

import duckdb
import pytest

from tidemark.plans.catalog_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    asked = con.execute(ORACLES[name])
    names = [c[0] for c in asked.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    key = lambda r: str([v for v in r if not isinstance(v, float)])
    want = sorted(([plain(v) for v in r] for r in asked.fetchall()), key=key)
    got = sorted(([plain(r[c]) for c in names] for r in df.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert [v for v in a if not isinstance(v, float)] == [v for v in b if not isinstance(v, float)]
        assert [v for v in a if isinstance(v, float)] == pytest.approx([v for v in b if isinstance(v, float)], rel=1e-3, abs=2e-4)
