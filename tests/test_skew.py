"""Queries against their SQL on tables where one key holds a third of all rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.001"

SKEWED = {
    # One brand, hence one back image.
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#23' ELSE p_brand END AS p_brand) FROM t",
    # One order with very many positions, some written more than once.
    "lineitem": """SELECT * EXCLUDE (n) REPLACE (
        CASE WHEN n % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN n % 3 = 0 THEN n % 700 ELSE l_linenumber END AS l_linenumber)
        FROM (SELECT *, CAST(row_number() OVER () AS INTEGER) AS n FROM t)""",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM t",
    "labels": "SELECT * FROM t UNION ALL SELECT l.* REPLACE (13 AS doc_id) FROM t l",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 99 ELSE doc_id END AS doc_id) FROM t",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in TABLES:
        source, target = f"{SF}/{table}.parquet", f"{folder}/{table}.parquet"
        if table in SKEWED:
            query = SKEWED[table].replace("FROM t", f"FROM '{source}'")
            duckdb.sql(f"COPY ({query}) TO '{target}' (FORMAT parquet)")
        else:
            os.symlink(source, target)
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "q07_distinct_fetch",
        "q08_image_join",
        "q12_infer",
        "q15_failed_ledger",
        "q16_ledger_append",
        "q19_name_filter",
        "q20_batch_assign",
        "q21_archive_last_wins",
        "q23_nested_rebuild",
        "q25_stream_dedupe",
        "q28_enriched_documents",
        "q29_model_calls",
    ],
)
def test_skewed_table(spark, skewed, name):
    assert compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], skewed) == []
