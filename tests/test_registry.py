"""A few registered queries against their SQL on the smallest tables; all run in tools/verify.py."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.verify import compare

NAMES = (
    "A07_deduplicate_last", "C07_asof_join", "E19_rank_descending", "F10_asset_features",
    "F16_avg_pairwise_corr", "F19_breadth", "L15_score_candidates", "P04_backtest_banded",
    "T06_impute_and_scale", "M08_ranking_metrics", "U01_price_audit",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def test_entry_has_rows(spark):
    assert len(entry.entry(spark).take(3)) == 3


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert compare(got, duck.sql(entry.oracle_sql()[name]).df()) == "OK"
