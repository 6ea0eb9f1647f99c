"""The evaluation queries against DuckDB on the smallest tables."""

import pytest
from test_plans import SF, duck, rounded  # noqa: F401

from strandflow.plans.event_queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert rounded(tuple(r[c] for c in cols) for r in df.collect()) == rounded(want)
