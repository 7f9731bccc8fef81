"""Salting of heavy keys only: results, the plan, and the size of the largest task."""

import pytest
from pyspark.sql import functions as F

from shortfall.operators import legacy, skew, waterfall


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 rows: 80 % at one destination, 8 % without one, the rest over many."""
    k = F.col("id") % 25
    dest = F.when(k < 20, "d0").when(k < 22, None).otherwise(F.concat(F.lit("d"), (F.col("id") % 997).cast("string")))
    return spark.range(20_000).select("id", dest.alias("dest_pincode"), (F.col("id") % 7).alias("fsn"))


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(f"d{i}", i) for i in range(0, 60, 2)] + [(None, -1)], "dest_pincode string, zone int")


def test_only_heavy_keys_are_found(hot):
    found = skew.heavy_keys(hot, ["dest_pincode"], share=1 / 16)
    by_hash = {
        r.h: r.dest_pincode for r in hot.select("dest_pincode", F.xxhash64("dest_pincode").alias("h")).distinct().collect()
    }
    assert {by_hash[h]: n for h, n in found.parts.items()} == {"d0": 13, None: 2}


@pytest.mark.parametrize("how", skew.KEPT_TYPES)
def test_join_equals_the_plain_join(hot, small, how):
    want = hot.join(small, "dest_pincode", how)
    got = skew.heavy_join(hot, small, ["dest_pincode"], ["id"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_no_salt_without_heavy_keys(spark, small):
    even = spark.range(1000).select("id", F.concat(F.lit("d"), (F.col("id") % 200).cast("string")).alias("dest_pincode"))
    found = skew.heavy_keys(even, ["dest_pincode"])
    assert not found.parts
    plan = skew.heavy_join(even, small, ["dest_pincode"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "part_" not in plan and "Generate" not in plan
    assert not skew.heavy_keys(even.limit(0), ["dest_pincode"]).parts


def test_small_side_is_repeated_for_heavy_keys_only(hot, small):
    heavy = skew.heavy_keys(hot, ["dest_pincode"])
    right = small.withColumn("parts", heavy.parts_of())
    repeated = {r.dest_pincode: r.parts for r in right.collect()}
    assert repeated.pop("d0") == 52 and repeated.pop(None) == 6
    assert set(repeated.values()) == {1}


def test_largest_task_of_a_hot_destination(spark, hot, small):
    """With 80 % of the rows at one destination no task gets much more than its share."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest(joined):
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            return max(r["count"] for r in sizes)

        merge = small.hint("merge")
        plain = largest(hot.join(merge, "dest_pincode", "left"))
        salted = largest(skew.heavy_join(hot, merge, ["dest_pincode"], ["id"], "left"))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert plain >= 16_000
    assert salted < 20_000 / 32 * 4


def test_wrong_uses(spark, hot, small):
    with pytest.raises(ValueError):
        skew.heavy_join(hot, small, ["dest_pincode"], ["id"], "full")
    with pytest.raises(ValueError):
        skew.heavy_keys(hot, ["dest_pincode"], share=0)
    heavy = skew.heavy_keys(hot, ["dest_pincode"])
    with pytest.raises(ValueError):
        skew.heavy_join(hot, small, ["fsn"], ["id"], heavy=heavy)
    with pytest.raises(ValueError):  # equal values of another type have other hashes
        skew.heavy_join(hot, small.withColumn("dest_pincode", F.lit(1)), ["dest_pincode"], ["id"], heavy=heavy)


def test_operators_on_a_hot_destination(spark, hot):
    """The lookups by destination give the rows of plain joins."""
    detail = hot.withColumn("sales", F.lit(1.0))
    sales = hot.select("fsn", "dest_pincode", (F.col("fsn") + 100).alias("product_id_key"), F.lit(7).alias("destination_pincode_key"))
    preferred = spark.createDataFrame([("d0", "c1"), ("d4", "c2")], "pincode string, preferred_fc_non_large string")
    got = waterfall.attach_keys(detail, sales, preferred)
    assert got.count() == 20_000
    at_d0 = hot.where("dest_pincode = 'd0'").count()
    assert got.where("preferred_fc = 'c1'").count() == at_d0 >= 16_000
    assert got.where("destination_pincode_key is null").count() == hot.where("dest_pincode is null").count()
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "fsn bigint, title string")
    zones = spark.createDataFrame([("d0", "north")], "dest_pincode string, Zone string")
    fcs = spark.createDataFrame([("d0", "a"), ("d0", "b")], ["dest_pincode", "LZ-FC"])
    out = legacy.enrich_output(detail, titles, zones, fcs)
    assert out.count() == 20_000 + at_d0 and out.where("Zone = 'north'").count() == 2 * at_d0
