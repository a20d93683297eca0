"""Every registered query against its DuckDB oracle on the sf0.001 fixtures."""

import pytest

from tradewh.registry import ORACLE, QUERIES
from tests.compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)
    assert res[name] == "OK", res[name]


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "variacion_pct_yoy" in df.columns
