"""Listings derived from the given tables."""

import re
from collections import Counter

import pytest

from kvartal import fixtures

USED = ("lineitem", "orders", "part", "customer", "nation", "region", "documents")


@pytest.fixture
def odd_tables(spark, sf_dir, folder):
    """The given tables with repeated rows and missing keys; every line is of a few orders."""
    for name in USED:
        rows = fixtures.table(spark, sf_dir, name)
        if name in ("orders", "part", "customer", "documents"):
            key = rows.columns[0]
            rows = rows.unionByName(rows.limit(40)).unionByName(
                rows.limit(5).selectExpr(f"CAST(NULL AS bigint) AS {key}", *rows.columns[1:])
            )
        if name == "lineitem":
            rows = rows.limit(600).unionByName(rows.limit(20)).unionByName(
                rows.limit(5).selectExpr("CAST(NULL AS bigint) AS l_orderkey", *rows.columns[1:])
            )
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("partitions", [None, 7])
def test_narrow_joins_give_the_same_listings(spark, odd_tables, partitions):
    for name in USED:
        fixtures.table(spark, odd_tables, name).createOrReplaceTempView(name)
    narrow = spark.sql(fixtures.narrow_listings_sql(partitions))
    told = spark.sql(fixtures.LISTINGS_SQL)
    assert narrow.schema == told.schema
    found = Counter(narrow.collect())
    assert found == Counter(told.collect()) and len(found) > 600


def test_partitions_grow_with_the_lines(spark, odd_tables, monkeypatch):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    monkeypatch.setattr(fixtures, "PARTITION_ROWS", 25)
    try:
        rows = fixtures.listings(spark, odd_tables)
        assert spark.conf.get(setting) == "25"
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [l_orderkey" in plan and "], 25" in plan
        # the lines that meet the orders, and those that tell which documents have none
        assert len(re.findall(r"RepartitionByExpression \[l_orderkey#\d+L?\], 25", plan)) == 2
    finally:
        spark.conf.set(setting, before)
    monkeypatch.setattr(fixtures, "PARTITION_ROWS", 10**9)
    fixtures.listings(spark, odd_tables)
    assert spark.conf.get(setting) == before
