from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

import __spark_entry__  # noqa: F401  (ships the package to the Python workers)
from catalogue_enrich.session import configure


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture()
def folder():
    """A new folder per test; nothing is ever cleared."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
