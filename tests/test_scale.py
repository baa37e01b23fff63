"""Plan shapes that have to hold when one key owns a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import dedup, quality
from ledgerlark.operators.joins import left_join_many, splittable_join
from ledgerlark.operators.revenue import ad_hierarchy, attribute_clicks
from ledgerlark.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SPLITS}
    for key, value in SMALL_SPLITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark, n=120_000):
    """A third of the rows carry key 1; payload keeps partitions from compressing away."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        "id",
    )


def test_hot_key_of_an_aggregated_side_is_split(spark, no_broadcast, executed):
    rows = hot_rows(spark)
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = splittable_join(rows, per_key, ["k"])
    assert "skew=true" in executed(joined)
    assert joined.agg(F.count(F.lit(1)), F.sum("n")).first()[0] == rows.count()
    # The plain join reuses the aggregate's partitioning and stays unsplit.
    assert "skew=true" not in executed(rows.join(per_key, "k"))


def test_semi_and_left_joins_split_too(spark, no_broadcast, executed):
    rows = hot_rows(spark)
    assert "skew=true" in executed(dedup.duplicate_key_rows(rows, ["k"]))
    assert "skew=true" in executed(dedup.conflicting_rows(rows, ["k"]))
    keys = rows.select("k").distinct().withColumn("found", F.lit(True))
    assert "skew=true" in executed(splittable_join(rows, keys, ["k"], "left"))
    assert "skew=true" in executed(quality.relationships(rows, "k", keys.where("k > 5"), "k"))


def test_left_join_with_a_hot_right_side(spark, no_broadcast, executed):
    many = hot_rows(spark)
    one = spark.range(0, 130_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = left_join_many(one, many, ["k"])
    assert "skew=true" in executed(joined)
    plain = one.join(many, "k", "left")
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain.select(joined.columns)).count() == 0


def test_copies_of_a_hot_key_collapse_before_the_shuffle(spark, executed):
    plan = executed(dedup.dedup_source(hot_rows(spark).withColumnRenamed("k", "key"), ["key"]))
    # Reading bottom up: the partial aggregate comes before the exchange.
    assert re.search(r"Exchange hashpartitioning\(key.*?partial_min", plan, re.S)


def test_attribution_leaves_the_rows_where_they_are(spark, tmp_path, executed):
    for name, n in (("ads", 20_000), ("groups", 5_000), ("campaigns", 1_250)):
        frame = spark.range(n).select("id", F.col("id").cast("string").alias("headline"), F.col("id").cast("string").alias("name"),
                                      (F.col("id") % 5_000).alias("ad_group_id"), (F.col("id") % 1_250).alias("campaign_id"))
        frame.write.parquet(str(tmp_path / name))
    lookup = ad_hierarchy(*[spark.read.parquet(str(tmp_path / n)) for n in ("ads", "groups", "campaigns")])
    clicks = spark.range(100_000).select("id", F.concat(F.lit("gclid-"), "id", F.lit("-x")).alias("gclid"))
    plan = executed(attribute_clicks(clicks, lookup))
    assert plan.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in plan


def test_as_of_cuts_a_key_with_very_many_versions(spark, no_broadcast):
    """A key with 100,000 versions and facts spans many tasks, and no fact meets all of its versions."""
    from ledgerlark.operators.history import as_of

    at = F.timestamp_seconds(F.col("id") * 60)
    history = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("v"), at.alias("valid_from"),
                                          F.timestamp_seconds((F.col("id") + 1) * 60).alias("valid_to"))
    facts = spark.range(100_000).select(F.lit(1).alias("k"), "id", F.timestamp_seconds(F.col("id") * 60 + 30).alias("at"),
                                        F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    joined = as_of(facts, history, ["k"], "at", ["v"])
    parts = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("v").alias("n"), F.max("payload")).collect()
    assert joined.where("v = id").count() == 100_000
    assert len(parts) >= 4 and max(r.n for r in parts) < 50_000


def test_planning_a_dedupe_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    dedup.dedup_source(hot_rows(spark), ["k"])
    dedup.duplicate_key_rows(hot_rows(spark), ["k"])
    assert list(tracker.getJobIdsForGroup("planning")) == []


LAZY = sorted(set(QUERIES) - {"gated_publish"})
# Its windows run over one key's rows of one partition, and over one row per partition of a key.
WINDOWED = {"scd2_as_of"}


@pytest.mark.parametrize("name", LAZY)
def test_no_query_needs_a_single_task_or_a_product(spark, name):
    """No cross or nested-loop join, no window over everything, no Python in the plan."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "ArrowEvalPython", "BatchEvalPython"):
        assert forbidden not in plan or (forbidden == "Window" and name in WINDOWED)
    # A single partition may only receive global aggregates, that is, one row per task.
    for above in re.findall(r"([^\n]*)\n[^\n]*Exchange SinglePartition", plan):
        assert "Aggregate" in above, above


def test_pushdown_reaches_the_scan(spark):
    plan = QUERIES["item_rollup"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schema == "l_orderkey:bigint,l_quantity:double,l_extendedprice:double"
    plan = QUERIES["refund_rollup"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,O)" in plan


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
