import datetime as dt

import pytest
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.operators import allocate, issues, legacy, matrix, prepare, waterfall, warehouse
from shortfall.plans.earlier_tables import EarlierTables

PERIOD = Period(dt.date(2017, 3, 5), dt.date(2017, 3, 11))
CASCADE = [(f"c{k}", f"i{k}") for k in range(6)]


def cascade_rows(spark, rows):
    names = ["pool"] + [f"i{k}" for k in range(6)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], names)
    out = allocate.cascade(df, "pool", CASCADE)
    return [[r[f"c{k}"] for k in range(6)] + [r.residual] for r in out.collect()]


def test_cascade_anchors(spark):
    got = cascade_rows(spark, [(10, 3, 0, 4, 9, 1, 1), (10, 1, 1, 1, 1, 1, 1)])
    assert got == [[3, 0, 4, 3, 0, 0, 0], [1, 1, 1, 1, 1, 1, 4]]


def test_cascade_closed_form_and_conservation(spark):
    import random

    r = random.Random(0)
    rows = [[r.choice([0, r.random() * 9]) for _ in range(7)] for _ in range(300)]
    for (pool, *issue), got in zip(rows, cascade_rows(spark, rows)):
        reach = [max(pool - sum(issue[:k]), 0) for k in range(7)]
        want = [a - b for a, b in zip(reach, reach[1:])] + [reach[6]]
        assert got == pytest.approx(want, abs=1e-9)
        assert sum(got) == pytest.approx(pool)


def test_cascade_takes_all_on_a_flag(spark):
    df = spark.createDataFrame([(9.0, 2.0, 1, 5.0), (9.0, 2.0, 0, 5.0)], "pool double, a double, f int, b double")
    out = allocate.cascade(df, "pool", [("x", "a"), ("y", "f", "all_if_flag"), ("z", "b")])
    assert [(r.x, r.y, r.z, r.residual) for r in out.collect()] == [
        (2.0, 7.0, 0.0, 0.0), (2.0, 0.0, 5.0, 2.0),
    ]


@pytest.mark.parametrize(
    "mode, offer, promo, left",
    [("excess", 2.0, 3.0, 2.0), ("capped", 2.0, 2.0, 3.0), ("excess", 0.0, 5.0, 0.0), ("capped", 0.0, 0.0, 5.0)],
)
def test_promotions(spark, mode, offer, promo, left):
    losses = spark.createDataFrame([("p", "d", 5.0)], "fsn string, dest_pincode string, residual double")
    offers = spark.createDataFrame([("p", "d", offer)], "fsn string, dest_pincode string, offer_sales double")
    row = waterfall.promotions_loss(losses, offers, mode).first()
    assert (row.promotions_loss, row.residual) == (promo, left)


def test_split_ratio_sums_to_one_unless_fan_out_is_kept(spark):
    supplied = spark.createDataFrame(
        [("p", "d", b, "v", f, 1) for b in ("b1", "b2") for f in ("f1", "f2", "f3")],
        "fsn string, dest_pincode string, brand string, vertical string, fc string, vendor_count bigint",
    )
    once = allocate.fc_split_ratio(supplied)
    assert once.count() == 3 and once.agg(F.sum("ratio")).first()[0] == pytest.approx(1)
    kept = allocate.fc_split_ratio(supplied, strict_fanout=True)
    assert kept.count() == 6 and kept.agg(F.sum("ratio")).first()[0] == pytest.approx(2)


def test_lead_time_rules(spark, rows):
    lead = spark.createDataFrame(
        [("p", f, days) for f, days in [("a", 0.0), ("b", 0.5), ("c", 7.0), ("d", 63.5)]] + [("unsold", "a", 3.0)],
        "fsn string, warehouse string, lead_time double",
    )
    products = spark.createDataFrame([("p", "c1"), ("new", "c2")], "fsn string, category string")
    cat = spark.createDataFrame([("c1", 10.0)], "category string, lead_time double")
    got = rows(prepare.policy_lead_time(lead, products, cat, PERIOD), "fsn", "fc")
    assert {k: (v["policy_lt"], v["reco_week"]) for k, v in got.items()} == {
        ("p", "a"): (10.0, 8), ("p", "b"): (10.0, 8), ("p", "c"): (7.0, 9), ("p", "d"): (63.5, 53),
        ("new", None): (None, None),
    }


def test_purchase_order_windows(spark, rows):
    # lead time 5: open orders count up to 27 February, closed ones from 23 February
    lines = [
        ("p", "a", 20170227, "approved", "9", "4"), ("p", "b", 20170228, "approved", "9", "4"),
        ("p", "c", 20170223, "completed", "9", "4"), ("p", "d", 20170222, "completed", "9", "4"),
        ("p", "e", 20170101, "cancelled", "9", "4"), ("p", "f", 20170101, "approved", "4", "9"),
        ("p", "g", 20170230, "approved", "9", "4"), ("p", "h", 20170101, "approved", "x", "4"),
    ]
    po = spark.createDataFrame(
        lines, "fsn string, fc string, poi_created_day int, po_status string, poi_ordered_qty string, poi_received_qty string"
    )
    products = spark.createDataFrame([("p", "c1")], "fsn string, category string")
    cat = spark.createDataFrame([("c1", 5.0)], "category string, lead_time double")
    none = spark.createDataFrame([], "fsn string, fc string, policy_lt double")
    got = rows(issues.vendor_adherence_issue(po, products, none, cat, PERIOD), "fc")
    assert {k: v["vendor_adherence_issue"] for k, v in got.items()} == {"a": 5.0, "c": 5.0, "f": 0.0, "h": None}
    loose = rows(issues.vendor_adherence_issue(po, products, none, cat, PERIOD, clamp=False), "fc")
    assert loose["f"]["vendor_adherence_issue"] == -5.0


def test_forecast_horizons(spark, rows):
    names = prepare.FORECASTS
    req = spark.createDataFrame([("p", f, *map(float, range(1, 9))) for f in "abc"], ["fsn", "fc", *names])
    lead = spark.createDataFrame(
        [("p", "a", "c", 7.0), ("p", "b", "c", 56.0), ("p", "c", "c", 57.0)],
        "fsn string, fc string, category string, policy_lt double",
    )
    keys = ("fsn", "fc")
    got = rows(issues.reco_at_lead_time(req, lead, keys), "fc")
    assert [got[f]["forecast_qty"] for f in "abc"] == [1.0, 8.0, 4.5]
    got = rows(issues.reco_at_lead_time(req, lead, keys, "table_sum"), "fc")
    assert [got[f]["forecast_qty"] for f in "abc"] == [1.0, 8.0, 13.5]


def test_wide_lanes(spark, rows):
    wide = spark.createDataFrame(
        [("1", "F1", None, "x"), ("1", "F1", None, "x"), ("2", "", "0", "F9"), ("3", "0", "F2", "")],
        "Destination_Pincode string, L1_a string, Z2_b string, N1 string",
    )
    flags = rows(matrix.fc_available_flag(wide), "Destination_Pincode")
    assert {k: v["fc_available_flag"] for k, v in flags.items()} == {"1": 1, "2": 0, "3": 1}
    assert {tuple(r) for r in matrix.lane_unpivot(wide).collect()} == {("1", "L1_a", "F1"), ("3", "Z2_b", "F2")}


def test_placement_flags_ratio_and_reason(spark, rows):
    pairs = spark.createDataFrame(
        [(p, "1", "Acme", "v") for p in ("open", "taxed")] + [("bare", "1", "Zed", "v")],
        "fsn string, dest_pincode string, brand string, vertical string",
    )
    lanes = spark.createDataFrame([("1", "L1", "F1"), ("1", "Z1", "F2")], "Destination_Pincode string, lzn string, FC string")
    tax = spark.createDataFrame([("taxed", "F1", 0), ("taxed", "F2", 0)], "FSN string, FC string, tax_flg int")
    u2s = spark.createDataFrame([("Zed", "v", "s", "c", "F1", 0)], "brand string, vertical string, super_category string, category string, FC string, u2s_flag int")
    vendor = spark.createDataFrame([("ZED", "v", "c", "F2", 0)], "brand string, Vertical string, Category string, FC string, vendor_flag int")
    m = matrix.placement_matrix(pairs, lanes, tax, u2s, vendor)
    assert m.count() == 6
    assert {(r.fsn, r.FC, r.ratio) for r in matrix.placement_ratio(m).collect()} == {("open", "F1", 0.5), ("open", "F2", 0.5)}
    assert {(r.fsn, r.loss) for r in matrix.placement_loss_class(m).collect()} == {("taxed", "tax"), ("bare", "vendor")}
    off = matrix.tax_unpivot(spark.createDataFrame([("p", 0, 1)], "FSN string, F1 int, F2 int"), pairs, False)
    assert off.count() == 0


def test_wide_lead_times(spark, rows):
    wide = spark.createDataFrame([("p", None, 0.0, 3.0)], "fsn string, lead_time_for_F1 double, lead_time_for_F2 double, lead_time_for_F3 double")
    products = spark.createDataFrame([("p", "c")], "fsn string, category string")
    floor = spark.createDataFrame([("c", 10.0)], "category string, Lead_time_floor double")
    got = rows(legacy.policy_lead_time_floor(wide, products, floor, PERIOD), "FC")
    assert {k: (v["policy_lead_time"], v["reco_date"]) for k, v in got.items()} == {
        "F1": (7.0, dt.date(2017, 2, 26)), "F2": (10.0, dt.date(2017, 2, 19)), "F3": (3.0, dt.date(2017, 2, 26)),
    }


def test_po_raised_leaves_out_cancelled_orders(spark):
    orders = spark.createDataFrame(
        [(1, "open", "2017-01-03", "F1"), (2, "cancelled", "2017-01-03", "F1"), (3, "open", "2016-01-03", "F1")],
        "id int, status string, created_at string, origin_warehouse_id string",
    )
    items = spark.createDataFrame([(k, "p", 10.0, 4.0) for k in (1, 2, 3)], "purchase_order_id int, fsn string, quantity double, cancel_quantity double")
    got = warehouse.po_raised(orders, items, dt.date(2016, 11, 1)).collect()
    assert [(r.fsn, r.FC, r.weeknum, r.total_po_raised_qty) for r in got] == [("p", "F1", 1, 6.0)]


def test_category_lead_times_meet_products_not_their_centres(spark):
    """The join by category, of few keys, comes before there is a row per centre."""
    lead = spark.createDataFrame([("p", "a", 0.0), ("p", "b", 3.0)], "fsn string, warehouse string, lead_time double")
    products = spark.createDataFrame([("p", "c1"), ("p", None)], "fsn string, category string")
    cat = spark.createDataFrame([("c1", 10.0)], "category string, lead_time double")
    wide = spark.createDataFrame([("p", 0, None)], "fsn string, lead_time_for_FC1 int, lead_time_for_FC2 int")
    floor = cat.withColumnRenamed("lead_time", "Lead_time_floor")
    weekly = prepare.policy_lead_time(lead, products, cat, PERIOD)
    earlier = legacy.policy_lead_time_floor(wide, products, floor, PERIOD)
    for df in (weekly, earlier):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
        assert "fsn" in joins[0] and "category" in joins[1]
    assert {(r.fc, r.category, r.policy_lt) for r in weekly.collect()} == {
        ("a", "c1", 10.0), ("b", "c1", 3.0), ("a", None, None), ("b", None, 3.0),
    }
    assert {(r.FC, r.category, r.policy_lead_time) for r in earlier.collect()} == {
        ("FC1", "c1", 10.0), ("FC2", "c1", 7.0), ("FC1", None, None), ("FC2", None, 7.0),
    }


def test_table_sum_reads_the_written_plan(spark, rows):
    """The total and the rows come from one written table, not from two runs of the join."""
    plan = spark.createDataFrame(
        [("p", f, *[float(k)] * 8) for k, f in enumerate("ab", 1)], ["fsn", "fc", *prepare.FORECASTS]
    )
    lead = spark.createDataFrame([("p", "a", "c", 7.0), ("p", "b", "c", 70.0)], "fsn string, fc string, category string, policy_lt double")
    written = []

    def stage(df, name):
        written.append(name)
        return spark.createDataFrame(df.collect(), df.schema)

    got = rows(issues.reco_at_lead_time(plan, lead, ("fsn", "fc"), "table_sum", stage), "fc")
    assert {k: v["forecast_qty"] for k, v in got.items()} == {"a": 1.0, "b": 3.0} and len(written) == 1


def test_line_items_meet_written_centres_without_a_shuffle(spark, tmp_path):
    """Written centres show their size, so no line item is shuffled by centre."""
    make = lambda name, rows, kinds: spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    day = dt.datetime(1998, 1, 5)
    make("nation", [(0, "n", 0), (1, "m", 0)], "n_nationkey int, n_name string, n_regionkey int")
    make("customer", [(1, 1)], "c_custkey long, c_nationkey int")
    make("supplier", [(k, k % 2, 1.0) for k in range(40)], "s_suppkey long, s_nationkey int, s_acctbal double")
    make("part", [(1, "v", "b", "t", 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    make("orders", [(1, 1, "O", day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    lines = spark.range(40_000).selectExpr(
        "xxhash64(id) AS l_orderkey", "id % 5 AS l_partkey", "id % 40 AS l_suppkey", "1 AS l_linenumber",
        "double(id % 7) AS l_quantity", "0.1D AS l_discount", "'R' AS l_returnflag", "'F' AS l_linestatus",
        "TIMESTAMP_NTZ'1998-01-05' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = EarlierTables(spark, str(tmp_path))
    plans = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        for t in (tables, tables.staged()):
            joined = t.reco_file
            plans.append(joined._jdf.queryExecution().executedPlan().toString())
            assert joined.count() == 40_000 and t.leadtime_wide.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_centre = [sum("hashpartitioning(l_suppkey" in line for line in plan.splitlines()) for plan in plans]
    assert by_centre == [2, 0]  # both sides of the join
