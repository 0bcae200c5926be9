import pytest

import __spark_entry__ as entry
from catalogue_enrich.queries import QUERIES
from catalogue_enrich.session import configure
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF) == []


def test_queries_set_what_they_rely_on(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    assert entry.queries()["q05_option_map"](spark, SF).count() > 0
    configure(spark)


def test_entry(spark):
    assert entry.entry(spark).columns == ["product_id", "pos", "attribute_id", "result"]
