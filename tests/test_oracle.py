"""Every query that has SQL gives the same rows as that SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from tests.compare import assert_same_rows

ROWS_ONLY = {
    "cluster_points",
    "cluster_centers",
    "cluster_hotspots",
    "cluster_silhouette",
}


# Without the text operators, which may be absent and have tests of their own.
OWN = set(spark_entry._QUERIES)


def test_every_key_has_sql_or_is_listed():
    assert OWN - set(spark_entry.oracle_sql()) == ROWS_ONLY
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(OWN & set(spark_entry.oracle_sql())))
def test_same_rows_as_sql(spark, sf_dir, name):
    rows = assert_same_rows(spark_entry.queries()[name](spark, sf_dir), spark_entry.oracle_sql()[name], sf_dir)
    assert rows > 0 or name == "sample_trips"


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, sf_dir, name):
    df = spark_entry.queries()[name](spark, sf_dir)
    assert df.count() >= 1


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 24
