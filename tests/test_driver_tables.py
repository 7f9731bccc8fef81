import datetime as dt

import pytest

from shortfall.plans.driver_tables import DriverTables

DAY = dt.datetime(1998, 1, 5)
TABLES = {
    "nation": ("n_nationkey int, n_regionkey int", [(0, 0), (1, 0)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 0), (2, 1)]),
    "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(7, 0, 1.0), (8, 1, -1.0)]),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        [(1, "ring", "b", "LARGE", 3), (2, "rod", "c", "SMALL", 30)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
        [(5, 1, "O", DAY), (6, 2, "F", DAY)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, "
        "l_linestatus string, l_shipdate timestamp_ntz",
        [
            (5, 1, 7, 2.0, 0.1, "F", DAY), (5, 1, 7, 3.0, 0.5, "O", DAY), (6, 1, 8, 4.0, 0.0, "F", DAY),
            (6, 2, 8, 9.0, 0.3, "F", DAY), (6, 2, None, 5.0, 0.0, "O", DAY),
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return DriverTables(spark, str(folder))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_the_plan_is_shuffled_once_for_its_sum_and_its_joins(tables):
    plan = tables.requirement.select("fsn", "warehouse", "system_qty")
    assert rows_of(plan) == [(1, "7", 5), (1, "8", 4), (2, "8", 9), (2, None, 5)]
    by_centre = plan.groupBy("fsn", "warehouse").count()
    executed = by_centre._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1


def test_plans_and_orders_share_written_lead_times(tables):
    run, plain = tables.weekly_leads, tables.run()
    assert not [f for f in run.lead_time.inputFiles() if "lineitem.parquet" in f or "part.parquet" in f]
    for name in ("lead_time", "override_issues", "adherence_issue"):
        assert rows_of(getattr(run, name)) == rows_of(getattr(plain, name))
    assert len(run.cube.inputFiles()) > 1  # the other frames are not written
