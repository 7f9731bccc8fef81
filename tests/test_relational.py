import pytest
from pyspark.sql import functions as F

from shortfall.operators import relational as rel


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    large = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k")
    )
    small = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c")], "k bigint, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = large.join(small, "k", how)
        salted = rel.salted_join(large, small, ["k"], ["id"], how, parts=4)
        assert sorted(map(tuple, salted.select(*plain.columns).collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str
        )
    with pytest.raises(ValueError):
        rel.salted_join(large, small, ["k"], ["id"], "full")


def test_salt_spreads_a_hot_key(spark):
    large = spark.range(2000).withColumn("k", F.lit(1))
    salt = F.pmod(F.xxhash64("id"), F.lit(rel.SALT_PARTS))
    counts = [r["count"] for r in large.groupBy(salt).count().collect()]
    assert len(counts) == rel.SALT_PARTS and max(counts) < 2000 / rel.SALT_PARTS * 1.6


def test_ragged_union_and_natural_join(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(1, 2.0)], "k int, b double")
    got = rel.union_ragged(a, b).collect()
    assert {(r.k, r.a, r.b) for r in got} == {(1, "x", None), (1, None, 2.0)}
    assert rel.natural_join(a, b).columns == ["k", "a", "b"]


def test_join_on_upper_keeps_left_spelling(spark):
    left = spark.createDataFrame([("Acme", 1), ("none", 2)], "brand string, v int")
    right = spark.createDataFrame([("ACME", 9)], "brand string, w int")
    got = {r.brand: r.w for r in rel.join_on_upper(left, right, "brand").collect()}
    assert got == {"Acme": 9, "none": None}


def test_wide_to_long_keeps_nulls_and_counts(spark):
    df = spark.createDataFrame([("d", "x", None, "0")], "id string, L1 string, L2 string, Z1 string")
    long = rel.wide_to_long(df, ["id"], "slot", "fc")
    assert {(r.slot, r.fc) for r in long.collect()} == {("L1", "x"), ("L2", None), ("Z1", "0")}
    assert rel.columns_like(df, prefixes=["L"]) == ["L1", "L2"]
    assert df.select(rel.count_where_in(["L1", "Z1"], ["", "0"])).first()[0] == 1


def test_overwrite_audit_and_tail(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (2, "b", 3.0)], "k int, v string, x double")
    got = rel.overwrite_where(df, F.col("k") == 2, ["x"], 0.0)
    assert sorted(r.x for r in got.collect()) == [0.0, 0.0, 1.0]
    assert rel.fanout_audit(df, "k", "v").first().asDict() == {"k": 2, "value_count": 2}
    assert [r.x for r in rel.last_rows(df, ["k", "v"], 2).collect()] == [3.0, 2.0]
    assert rel.totals(df, ["x"]).first().x == 6.0
    assert {r.v: r.n for r in rel.frequency(df, "v").collect()} == {"a": 2, "b": 1}
    empty = df.where("false")
    assert rel.fanout_audit(empty, "k", "v").count() == 0


def test_few_distinct_is_exact_below_its_limit(spark):
    """One product holds most rows; values repeat; missing ones do not count."""
    rows = [("hot", i % 5000) for i in range(40000)] + [("none", None)] * 3 + [(None, 1), (None, 1), (None, 2)]
    rows += [(f"k{n}", v) for n in range(70) for v in range(n) for _ in range(3)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(5)
    for limit in (1, 2, 30, 64):
        got = {r.k: r.n for r in rel.few_distinct(df, ["k"], "v", limit, "n").collect()}
        want = {f"k{n}": n for n in range(1, min(70, limit))} | {"none": 0}
        assert got == want | ({None: 2} if limit > 2 else {})
    plan = rel.few_distinct(df, ["k"], "v", 30, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan
