"""Some registered queries against their SQL, on the smallest test tables."""

from pathlib import Path

import pytest

import check
from tillstar.catalog import QUERIES
from tillstar.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables are not here")
@pytest.mark.parametrize(
    "name",
    ["fact_order_items", "dim_product", "quarantine_rows", "monthly_trend", "product_performance",
     "product_affinity", "ingredient_exposure", "profile_numeric", "heatmap_pivot"],
)
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for t in ("lineitem", "orders", "part", "events"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    want = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert check.rows(df.collect(), df.columns) == check.rows(want.fetchall(), want.columns)
