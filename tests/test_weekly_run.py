"""The whole weekly run on random rows in the input schemas, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.operators.waterfall import LOSSES
from shortfall.plans.weekly import WeeklyInputs, WeeklyOptions, WeeklyRun
from shortfall.sources.schemas import SCHEMAS
from shortfall.sources.stage import stage

from brute import detail, week

WS, WE = dt.date(2017, 3, 5), dt.date(2017, 3, 11)
PERIOD = Period(WS, WE)
TABLES = [
    "sales_raw", "lzn_mapping", "vendor_site", "vendor_brand", "lead_time", "cat_lead_time",
    "min_sale_threshold", "exclusion_list", "preferred_warehouse", "requirement", "explain",
    "vendor_adherence", "offer_sales",
]


def random_tables(seed):
    r = random.Random(seed)
    products = [f"P{k}" for k in range(12)]
    # product P0 and destination 1 hold a large share of the rows
    some_product = lambda: "P0" if r.random() < 0.35 else r.choice(products)
    dests = [str(k) for k in range(1, 7)]
    some_dest = lambda: "1" if r.random() < 0.35 else r.choice(dests)
    fcs = [f"F{k}" for k in range(6)]
    hierarchy = {
        p: {"brand": f"B{k % 3}", "bu": "X", "super_category": "S", "category": f"C{k % 4}",
            "vertical": f"V{k % 2}"}
        for k, p in enumerate(products)
    }
    day = lambda a, b: WS + dt.timedelta(r.randint(a, b))
    key = lambda d: int(d.strftime("%Y%m%d"))
    t = {name: [] for name in TABLES}
    for _ in range(260):
        p, d = some_product(), day(-35, 6)
        units = r.randint(1, 20)
        ru = r.randint(0, units)
        t["sales_raw"].append({
            "day": d, "week": week(d), "fsn": p, **hierarchy[p],
            "destination_pincode": some_dest(), "source_pincode": "9", "fc": r.choice(fcs),
            "sales": float(units), "ru_sales": float(ru),
            "nat_sales": float(r.randint(0, units - ru)), "product_id_key": int(p[1:]),
            "destination_pincode_key": 7,
        })
    t["sales_raw"].append({**t["sales_raw"][0], "fsn": "", "week": week(WE)})
    classes = ["L1", "L2", "Z1", "Z2", "N1", "N2", "", "0", "NULL"]
    for d in dests[:-1]:
        for f in fcs:
            lane = r.choice(["N1", "N2"] if d == "2" else classes)
            t["lzn_mapping"].append(
                {"lzn_value": lane, "src_fc_code": f, "dest_pincode": d, "src_pincode": "9"}
            )
    for _ in range(25):
        t["vendor_site"].append(
            {"fsn": r.choice(products), "fc": r.choice(fcs), "vsid": r.choice(["v1", "v2", None])}
        )
        t["vendor_adherence"].append({
            "fsn": some_product(), "fc": r.choice(fcs), "poi_created_day": key(day(-60, 6)),
            "po_status": r.choice(["approved", "completed", "cancelled"]),
            "poi_ordered_qty": str(r.randint(0, 20)), "poi_received_qty": str(r.randint(0, 20)),
        })
    t["vendor_brand"] = [{"vsid": "v9", "fc": "F1", "vertical": "V0", "brand": "B0"}]
    for p in products[:-1]:
        for f in fcs[:-1]:
            days = r.choice([0.0, 0.5, 3.0, 7.0, 8.0, 20.0, 55.5, 70.0])
            t["lead_time"].append({"fsn": p, "warehouse": f, "lead_time": days})
    t["cat_lead_time"] = [{"category": f"C{k}", "lead_time": 5.0 + k} for k in range(3)]
    t["min_sale_threshold"] = [{"category": f"C{k}", "min_sales_depth": 30.0} for k in range(3)]
    t["exclusion_list"] = [
        {"fsn": "P3", "skip_upto": str(WS)},
        {"fsn": "P4", "skip_upto": str(WS - dt.timedelta(1))},
    ]
    for d, fc in zip(dests, ["F0,F1", "F2", None, "F3,F0", "F1,F2,F3"]):
        t["preferred_warehouse"].append({"pincode": d, "preferred_fc_non_large": fc})
    for p in products:
        for f in fcs:
            for w in range(1, 11):
                if r.random() < 0.5:
                    qty = lambda: r.choice(["NULL", *map(str, range(0, 12))])
                    t["requirement"].append({
                        "fsn": p, "warehouse": f, "week": w,
                        **{c: qty() for c in ["forecast_n"] + [f"forecast_n{k}" for k in range(1, 8)]},
                        **{f"{c}_qty": qty() for c in (
                            "system", "max_doh", "ipc_reviewed", "cdo_reviewed", "po",
                            "po_received", "po_rejected", "po_cancel")},
                    })
    for _ in range(120):
        t["explain"].append({
            "fiu_id": f"u{r.randint(0, 25)}", "fsn": some_product(),
            "destination_pincode": some_dest(), "lzn_value": r.choice(classes),
            "is_accepted": r.choice(["true", "TRUE", "1", "false"]),
            "effective_inventory": float(r.randint(0, 3)), "day": key(day(-8, 6)),
        })
        t["offer_sales"].append({
            "week_num": r.choice([week(WE), week(WE) - 1]), "fsn": some_product(),
            "dest_pincode": some_dest(), "offer_sales": float(r.randint(0, 4)),
        })
    return t


def with_gaps_and_repeats(tables, seed):
    """Missing destinations, brands, verticals, categories and centres; products
    sold under two brands and two categories."""
    r = random.Random(seed)
    for s in tables["sales_raw"]:
        if r.random() < 0.2:
            s["destination_pincode"] = None
        if s["fsn"] in ("P1", "P0") and r.random() < 0.5:
            s.update(brand="B0", vertical="V0", category="C2")
        if s["fsn"] in ("P2", "P5", "P8"):
            s.update(brand=None, vertical=None)
        if s["fsn"] == "P7":
            s["category"] = None
    lane = {"lzn_value": "L1", "src_pincode": "9"}
    tables["lzn_mapping"] += [
        {**lane, "src_fc_code": "F1", "dest_pincode": None},
        {**lane, "src_fc_code": "F4", "dest_pincode": None},
        {**lane, "src_fc_code": None, "dest_pincode": "2"},
    ]
    tables["vendor_brand"] += [
        {"vsid": "v8", "fc": f, "vertical": None, "brand": None} for f in ("F0", "F1", "F4")
    ] + [{"vsid": "v7", "fc": f, "vertical": "V1", "brand": "B1"} for f in ("F2", "F3")]
    tables["cat_lead_time"].append({"category": None, "lead_time": 9.0})
    tables["min_sale_threshold"].append({"category": None, "min_sales_depth": 40.0})
    tables["preferred_warehouse"].append({"pincode": None, "preferred_fc_non_large": "F1,F2"})
    for e in tables["explain"]:
        if r.random() < 0.2:
            e["destination_pincode"] = None
    for o in tables["offer_sales"]:
        if r.random() < 0.2:
            o["dest_pincode"] = None
    return tables


def frames(spark, tables):
    out = {}
    for name, rows in tables.items():
        schema = spark.createDataFrame([], SCHEMAS[name]).schema
        out[name] = spark.createDataFrame(
            [tuple(row.get(c) for c in schema.names) for row in rows], schema
        )
    return WeeklyInputs(**out)


@pytest.mark.parametrize("seed, staged", [(1, None), (2, stage)])
def test_run_equals_brute_force(spark, seed, staged):
    tables = random_tables(seed)
    run = WeeklyRun(frames(spark, tables), PERIOD, stage=staged)
    got = {(r.fsn, r.dest_pincode): r for r in run.detail.collect()}
    want = detail(tables, WS, WE)
    assert got.keys() == want.keys()
    for key, losses in want.items():
        for name in LOSSES:
            expected = losses[name.removesuffix("_loss")]
            assert getattr(got[key], name) == pytest.approx(expected, abs=1e-9), (key, name)
    assert sum(r.nat_sales for r in got.values()) == pytest.approx(
        sum(getattr(r, c) for r in got.values() for c in LOSSES)
    )


@pytest.mark.parametrize("seed", [11, 12])
def test_missing_keys_and_products_of_several_brands(spark, seed):
    tables = with_gaps_and_repeats(random_tables(seed), seed)
    run = WeeklyRun(frames(spark, tables), PERIOD, stage=stage)
    rows = run.detail.collect()
    want = detail(tables, WS, WE)
    got = {(r.fsn, r.dest_pincode): r for r in rows}
    assert len(rows) > len(got) and any(d is None for _, d in got)
    assert got.keys() == want.keys()
    for key, losses in want.items():
        for name in LOSSES:
            expected = losses[name.removesuffix("_loss")]
            assert getattr(got[key], name) == pytest.approx(expected, abs=1e-9), (key, name)
    explained = run.with_promotions.agg({c: "sum" for c in LOSSES}).first()
    national = run.placement.agg({"nat_sales": "sum"}).first()[0]
    assert sum(explained) == pytest.approx(national)
    checks = run.checks.first().asDict()
    gaps = [n for n in checks if n.endswith("_gap") and n != "explained_gap"]
    assert all(abs(checks[n]) < 1e-6 for n in gaps)
    output = run.output.select("dest_pincode", "preferred_fc").distinct().collect()
    assert (None, "F1,F2") in [tuple(r) for r in output]


def test_numbers_of_centres_equal_their_rows(spark):
    from pyspark.sql import functions as F

    tables = with_gaps_and_repeats(random_tables(13), 13)
    run = WeeklyRun(frames(spark, tables), PERIOD)
    pair = ["fsn", "dest_pincode"]
    rows = run.supplied.groupBy(*pair).agg(
        F.sum("vendor_count").alias("vendor_count"), F.count_distinct("fc").alias("fc_count")
    )
    counts = run.supply.where("fc_count > 0").select(*rows.columns)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, counts.collect()))
    assert run.supply.count() == run.pairs.select(*pair).distinct().count()


def test_literal_fanout_counts_orders_of_two_categories_twice(spark):
    tables = with_gaps_and_repeats(random_tables(14), 14)
    once = WeeklyRun(frames(spark, tables), PERIOD)
    literal = WeeklyRun(frames(spark, tables), PERIOD, WeeklyOptions(strict_fanout=True))
    total = lambda df, c: df.agg({c: "sum"}).first()[0]
    assert total(literal.adherence_issue, "vendor_adherence_issue") > total(
        once.adherence_issue, "vendor_adherence_issue"
    )
    assert literal.lead_time.count() > once.lead_time.count()
    assert once.lead_time.count() == once.lead_time.select("fsn", "fc").distinct().count()


@pytest.mark.parametrize("seed", [14, 15])
def test_literal_fanout_without_a_row_per_pair_and_centre(spark, monkeypatch, seed):
    """The literal fan-outs as rows, added up by pair, equal the run, which makes none of the rows without an issue."""
    from shortfall.operators import allocate, placement

    tables = with_gaps_and_repeats(random_tables(seed), seed)
    run = WeeklyRun(frames(spark, tables), PERIOD, WeeklyOptions(strict_fanout=True), stage=stage)
    rows = allocate.cascade_losses(run.allocated, run.forecast_issue, run.override_issues, run.adherence_issue)
    columns = [*allocate.CASCADE_LOSSES, "residual", "fsn_dp_fc_loss"]
    want = rows.groupBy("fsn", "dest_pincode").agg(*[F.sum(c).alias(c) for c in columns])
    keys = ["fsn", "dest_pincode", "fc"]
    assert rows.count() > rows.select(*keys).distinct().count() > 0  # fan-outs there are
    monkeypatch.setattr(placement, "supplied_fcs", None)
    literal = WeeklyRun(frames(spark, tables), PERIOD, WeeklyOptions(strict_fanout=True), stage=stage)
    as_rows = lambda df: {
        (r.fsn, r.dest_pincode): tuple(round(r[c], 9) for c in columns) for r in df.collect()
    }
    got = as_rows(literal.cascaded)
    assert got == as_rows(want) and got
    assert literal.detail.count() > 0


def test_unions_and_joins_give_the_same_losses(spark):
    from shortfall.operators.allocate import (
        allocate_to_fc, cascade_by_destination, cascade_losses, combine_losses, fe_loss,
    )

    run = WeeklyRun(frames(spark, random_tables(3)), PERIOD, stage=stage)
    pool = fe_loss(run.unblocked, run.fe_issue)
    cascaded = cascade_losses(
        allocate_to_fc(run.ratio, pool), run.forecast_issue, run.override_issues,
        run.adherence_issue,
    )
    literal = combine_losses(run.blocked, pool, cascade_by_destination(cascaded))
    as_rows = lambda df: {
        (r.fsn, r.dest_pincode): tuple(round(r[c], 9) for c in sorted(literal.columns[2:]))
        for r in df.collect()
    }
    assert as_rows(literal) == as_rows(run.losses)
    checks = run.checks.first().asDict()
    assert all(abs(v) < 1e-6 for name, v in checks.items() if name.endswith("_gap"))


def test_supplied_centres_are_the_candidates_with_vendors(spark):
    run = WeeklyRun(frames(spark, random_tables(4)), PERIOD)
    columns = run.supplied.columns
    dense = run.candidates.where("vendor_count > 0").select(*columns)
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, run.supplied.collect()))


def test_empty_sales_give_an_empty_table(spark):
    tables = random_tables(5)
    tables["sales_raw"] = []
    run = WeeklyRun(frames(spark, tables), PERIOD, WeeklyOptions(promotions="capped"))
    assert run.detail.count() == 0


def test_no_cartesian_product_in_the_plan(spark):
    run = WeeklyRun(frames(spark, random_tables(6)), PERIOD)
    plan = run.output._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
