"""Lookups with hot keys: results equal a plain join, and hot facts are dealt over many tasks."""

import pytest
from pyspark.sql import functions as F

from glossa.operators.lookup import materialise, skew_join


@pytest.fixture(scope="module")
def tables(spark):
    facts = spark.range(6000).select(
        F.col("id"), F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE concat('k', id % 700) END").alias("key"))
    counts = facts.where("key IS NOT NULL AND key != 'k5'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return facts, materialise(counts.withColumn("value", F.length("key")))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_equals_a_plain_join(tables, how, max_rows):
    facts, dim = tables
    got = skew_join(facts, dim, ["key"], "n", ["id"], how, max_rows=max_rows, shares=64)
    want = facts.join(dim, ["key"], how)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)


def test_facts_are_read_once_and_hot_ones_split(tables, spark):
    facts, dim = tables
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew_join(facts, dim, ["key"], "n", ["id"], max_rows=0, shares=64)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (") == 1 and plan.count("SortMergeJoin") == 1
        parts = joined.where("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) > 4 and max(r["count"] for r in parts) < 1000
        nulls = joined.where("key IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(nulls) > 4
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_empty_dimension(tables, spark):
    facts, dim = tables
    none = materialise(dim.where(F.lit(False)))
    assert skew_join(facts, none, ["key"], "n", ["id"], max_rows=-1).where("value IS NOT NULL").count() == 0


def test_written_tables_leave_no_shuffle_files(spark):
    """The shuffle files of a written table go when it is there, and the setting is put back."""
    import time

    from glossa.operators.lookup import SHUFFLE_CLEANUP
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in disk.getAllFiles().mkString("|").split("|") if "shuffle_" in x and x.endswith(".data")}
    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP)
    df = spark.range(20_000).groupBy((F.col("id") % 999).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    written = materialise(df, more=(df.where("g < 5"),))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert written.count() == 999 + 5 and df.count() == 999
