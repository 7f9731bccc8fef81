import datetime as dt
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.plans.earlier import EarlierInputs, plan_file_anchor, plan_of_files, with_plan_files
from shortfall.sources import files, stage
from shortfall.sources.schemas import SCHEMAS

SCHEMA = "k string, v double, d date"
ROWS = [("a", 1.5, dt.date(2020, 1, 1)), ("b", None, None), (None, -2.0, dt.date(2020, 2, 29))]


@pytest.mark.parametrize("write, read", [
    (files.write_csv, files.read_csv),
    (files.write_tsv, files.read_tsv),
])
def test_round_trip_keeps_missing_values(spark, tmp_path, write, read):
    path = str(tmp_path / "t")
    write(spark.createDataFrame(ROWS, SCHEMA), path)
    got = read(spark, path, SCHEMA).collect()
    assert sorted(map(tuple, got), key=str) == sorted(ROWS, key=str)


def test_row_cap(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_csv(spark.range(50).toDF("k"), path)
    assert files.read_limited(spark, path, "k bigint", 7).count() == 7


def test_weekly_files_by_date(spark, tmp_path):
    anchor = dt.date(2017, 3, 7)
    for k, day in enumerate(files.weekly_dates(anchor, 4)):
        df = spark.createDataFrame([(day.isoformat(), k)], "day string, k int")
        files.write_csv(df, str(tmp_path / f"plan_{day}"))
    got = files.read_dated(
        spark, str(tmp_path / "plan_{date}"), anchor, "day string, k int", weeks=3
    )
    assert sorted(r.k for r in got.collect()) == [0, 1, 2]
    assert got.filter("k = 2").first().day == "2017-02-21"


def test_week_partition_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "weeks")
    spark.range(10).withColumn("week", (F.col("id") % 3).cast("int")).write.partitionBy(
        "week"
    ).parquet(path)
    got = files.read_week(spark, path, 1)
    assert {r.id for r in got.collect()} == {1, 4, 7}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week" in plan


def test_stage_is_written_below_the_named_folder(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2.0)
    staged = stage.stage(df, "numbers")
    assert staged.dtypes == df.dtypes
    assert sorted(r.x for r in staged.collect()) == [0.0, 2.0, 4.0, 6.0, 8.0]
    assert all(stage.stage_root(spark) in f for f in staged.inputFiles())


def test_declared_schemas_parse(spark):
    for ddl in SCHEMAS.values():
        assert spark.createDataFrame([], ddl).columns


def test_plan_files_are_anchored_before_the_week():
    assert plan_file_anchor(Period(dt.date(2017, 3, 5), dt.date(2017, 3, 11))) == dt.date(2017, 2, 28)


PLAN = "reco_date string, FSN string, FC string, `Qty.Generated` double"


def plan_files(spark, tmp_path, days):
    """Each file holds its own week, restates product a of the week before and gives missing keys twice."""
    for k, day in enumerate(days):
        own, older = day.strftime("%d/%m/%Y"), (day - dt.timedelta(days=7)).strftime("%d/%m/%Y")
        rows = [(own, "a", "X", 1.0), (own, "a", "X", 2.0), (own, "b", "X", 4.0), (older, "a", "X", 100.0), ("01/01/2017", None, "X", 10.0 + k)]
        files.write_csv(spark.createDataFrame(rows, PLAN), str(tmp_path / f"plan_{day}"))


def test_newest_plan_file_wins(spark, tmp_path):
    anchor = dt.date(2017, 3, 7)
    days = files.weekly_dates(anchor, 3)
    plan_files(spark, tmp_path, days)
    dated = files.read_dated_files(spark, str(tmp_path / "plan_{date}"), anchor, PLAN, weeks=3)
    assert {r[files.FILE_DAY] for r in dated.collect()} == set(days) and dated.count() == 15
    keys = ["FSN", "FC", "reco_date"]
    got = files.newest_rows(dated, keys)
    assert got.columns == ["reco_date", "FSN", "FC", "Qty.Generated"]
    want = []
    for row in map(tuple, dated.collect()):
        same = [r for r in map(tuple, dated.collect()) if r[:3] == row[:3]]
        if row[4] == max(r[4] for r in same):
            want.append(row[:4])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) == 9
    assert [r["Qty.Generated"] for r in got.where("FSN is null").collect()] == [10.0]


def test_missing_plan_file_is_named(spark, tmp_path):
    period = Period.ending_before(dt.date(2017, 3, 7))
    days = files.weekly_dates(plan_file_anchor(period))
    for day in days[:4] + days[5:]:
        files.write_csv(spark.createDataFrame([("01/03/2017", "a", "X", 1.0)], PLAN), str(tmp_path / f"plan_{day}"))
    with pytest.raises(FileNotFoundError, match=f"plan_{days[4]}$"):
        plan_of_files(spark, str(tmp_path / "plan_{date}"), period)


def test_run_takes_its_plan_from_files(spark, tmp_path):
    period = Period.ending_before(dt.date(2017, 3, 7))
    anchor = plan_file_anchor(period)
    schema = SCHEMAS["auto_reco"]
    for k, day in enumerate(files.weekly_dates(anchor)):
        rows = [(anchor.strftime("%d/%m/%Y"), "a", "X", 1.0, 1.0, 1.0, 1.0, float(k), 2.0)]
        files.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / f"plan_{day}"))
    none = {f.name: None for f in fields(EarlierInputs)}
    inputs = with_plan_files(EarlierInputs(**none), spark, str(tmp_path / "plan_{date}"), period)
    assert [r["Qty.Recommended"] for r in inputs.reco_file.collect()] == [0.0]
    every = plan_of_files(spark, str(tmp_path / "plan_{date}"), period, newest=False)
    assert sorted(r["Qty.Recommended"] for r in every.collect()) == [float(k) for k in range(10)]
