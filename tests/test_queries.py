"""Registered queries against their SQL. All of them with ALL_QUERIES=1, else a cross-section."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"
FEW = ["two_path_expand", "find_peaks", "median_impute", "hist_by_class", "model_summary_table", "error_by_bin",
       "iqr_outlier_report", "stratified_split", "standard_scale", "plateau_early_stop", "smote", "dbscan",
       "silhouette", "reg_ridge", "wave_profile", "scan_csv_dir"]
NAMES = list(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else FEW


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert compare(rows, df.columns, cur.fetchall(), cols) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
