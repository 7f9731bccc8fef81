"""Causes of national shipments where a near placement was possible."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import Period, days_between, parse_date
from shortfall.functions.nulls import excess, null_safe_join, present_keys, strict_sum, zero
from shortfall.functions.text import is_true, to_number
from shortfall.operators.prepare import FORECASTS, NATIONAL_LANES, NEAR_LANES
from shortfall.operators.relational import salted_join

# Purchase-order states that count, and the planned quantities in
# the order each planning step reduces the one before.
PO_OPEN, PO_CLOSED = "approved", "completed"
PLAN_STEPS = [
    ("ndoh_issue", "system_qty", "max_doh_qty"),
    ("ipc_override_issue", "max_doh_qty", "ipc_reviewed_qty"),
    ("cdo_override_issue", "ipc_reviewed_qty", "cdo_reviewed_qty"),
    ("po_issue", "cdo_reviewed_qty", "po_qty"),
]


def explain_week(explain: DataFrame, period: Period) -> DataFrame:
    """Offers of the reporting week and year; ``day`` is an integer yyyymmdd.

    The days of the week are known, so the test is a range a scan can skip by.
    """
    first, last = (int(d.strftime("%Y%m%d")) for d in period.week_days)
    return _with_destination(explain.where(F.col("day").between(first, last)))


def _with_destination(offers: DataFrame) -> DataFrame:
    """Offers as extracted name the destination in full."""
    if "destination_pincode" in offers.columns:
        return offers.withColumnRenamed("destination_pincode", "dest_pincode")
    return offers


def units_offered_nearby(explain: DataFrame, near_filter=None) -> DataFrame:
    """Distinct units per product and destination accepted on a national lane
    although a near centre with stock was offered.

    Both sides are reduced to distinct rows before they meet, so a unit id that
    fills much of the table does not make a hot join key. Missing unit ids are
    one unit: they match each other and count once.
    """
    explain = present_keys(explain, ["fiu_id"])
    has_stock = F.col("lzn_value").isin(*NEAR_LANES) & (F.col("effective_inventory") > 0)
    if near_filter is not None:
        has_stock = has_stock & near_filter
    near = explain.where(has_stock).select("fsn", "dest_pincode", "fiu_id").distinct()
    national = (
        explain.where(F.col("lzn_value").isin(*NATIONAL_LANES) & is_true("is_accepted"))
        .select("fiu_id")
        .distinct()
    )
    return (
        near.join(national, "fiu_id", "left_semi")
        .groupBy("fsn", "dest_pincode")
        .agg(F.count("*").alias("fe_issue"))
    )


def fulfilment_engine_issue(explain: DataFrame, period: Period | None = None) -> DataFrame:
    """``units_offered_nearby`` of the reporting week, or of all rows without a period."""
    if period is None:
        return units_offered_nearby(_with_destination(explain))
    return units_offered_nearby(explain_week(explain, period))


def reco_at_lead_time(
    requirement: DataFrame,
    lead_time: DataFrame,
    on: Sequence[str] = ("fsn", "fc", "reco_week"),
    fallback: str = "row_mean",
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Plan made one lead time before the period, with the forecast for that horizon.

    Horizons beyond the eight forecast weeks use the mean of the row, or with
    ``fallback="table_sum"`` an eighth of the total of the whole joined table.
    That total needs the table twice: with ``stage`` it is written once.
    """
    joined = requirement.join(
        lead_time.select(*on, "category", "policy_lt"), list(on), "inner"
    ).withColumn("policy_lt_week", F.ceil(F.col("policy_lt") / 7).cast("int"))
    all_weeks = sum((F.col(c) for c in FORECASTS[1:]), F.col(FORECASTS[0]))
    if fallback == "table_sum":
        joined = stage(joined, "plan_at_lead_time") if stage else joined
        beyond = joined.agg((F.sum(all_weeks) / len(FORECASTS)).alias("total")).scalar()
    elif fallback == "row_mean":
        beyond = all_weeks / len(FORECASTS)
    else:
        raise ValueError("fallback must be row_mean or table_sum")
    k = F.col("policy_lt_week")
    at_horizon = F.get(F.array(*FORECASTS), k - 1)
    forecast = (
        F.when(k.isNull(), F.lit(None))
        .when(k.between(1, len(FORECASTS)), at_horizon)
        .otherwise(beyond)
    )
    return joined.withColumn("forecast_qty", forecast)


def forecast_issue(
    sales_fsn_dp: DataFrame,
    preferred: DataFrame,
    reco: DataFrame,
    strict_fanout: bool = False,
) -> DataFrame:
    """Units sold beyond the forecast of the destination's preferred centre.

    Several plans for one product and centre are added up first; with
    ``strict_fanout`` each makes a row of its own.
    """
    sold = (
        salted_join(sales_fsn_dp, preferred, ["dest_pincode"], ["fsn"], how="left")
        .groupBy("fsn", "pref_fc")
        .agg(strict_sum("sales").alias("sales"))
        .withColumnRenamed("pref_fc", "fc")
    )
    plan = reco.select("fsn", "fc", "forecast_qty")
    if not strict_fanout:
        plan = plan.groupBy("fsn", "fc").agg(F.sum("forecast_qty").alias("forecast_qty"))
    return (
        null_safe_join(sold, plan, [("fsn", "fsn"), ("fc", "fc")])
        .withColumn("forecast_qty", zero("forecast_qty"))
        .withColumn("forecast_issue", excess("sales", "forecast_qty"))
    )


def override_issues(
    reco: DataFrame, direction: str = "cut", strict_fanout: bool = False
) -> DataFrame:
    """Units taken out of the plan by each planning step.

    ``direction="raise"`` measures what the last three steps added instead.
    """
    if direction not in ("cut", "raise"):
        raise ValueError("direction must be cut or raise")
    steps = {
        name: excess(after, before)
        if direction == "raise" and name != "ndoh_issue"
        else excess(before, after)
        for name, before, after in PLAN_STEPS
    }
    rows = reco.select("fsn", "fc", *[c.alias(name) for name, c in steps.items()])
    if strict_fanout:
        return rows
    return rows.groupBy("fsn", "fc").agg(*[F.sum(name).alias(name) for name in steps])


def po_due(created, status, lead_days, period: Period):
    """Orders that should have arrived: open ones placed more than a lead time
    before the previous week's end, closed ones too late to plan again."""
    open_late = (status == PO_OPEN) & (
        days_between(period.shift("wk_end", -7), created) >= lead_days
    )
    closed_late = (status == PO_CLOSED) & (
        days_between(period.wk_start, created) <= 2 * lead_days
    )
    return open_late | closed_late


def vendor_adherence_issue(
    po_lines: DataFrame,
    products: DataFrame,
    lead_time: DataFrame,
    cat_lead_time: DataFrame,
    period: Period,
    clamp: bool = True,
    strict_fanout: bool = False,
) -> DataFrame:
    """Units vendors failed to deliver per product and centre.

    A product of several categories counts its orders once; without a lead
    time of its own, the longest of its categories applies. With
    ``strict_fanout`` its orders count once per category and lead time.

    Order lines are added up per day and state before the joins: the window
    test needs no more detail and a busy product shrinks to a few rows.
    ``clamp=False`` lets over-deliveries offset shortfalls.
    """
    ordered, received = to_number("poi_ordered_qty"), to_number("poi_received_qty")
    missing = excess(ordered, received) if clamp else ordered - received
    created = F.col("poi_created_day")
    if dict(po_lines.dtypes)["poi_created_day"] != "date":
        created = parse_date(created, "yyyyMMdd")
    daily = (
        po_lines.where(F.col("po_status").isin(PO_OPEN, PO_CLOSED))
        .withColumn("poi_created_day", created)
        .groupBy("fsn", "fc", "poi_created_day", "po_status")
        .agg(strict_sum(missing).alias("missing"))
    )
    lead = lead_time.select("fsn", "fc", "policy_lt").where("fc is not null").distinct()
    by_category = products.join(
        cat_lead_time.select("category", F.col("lead_time").alias("cat_lead_time")),
        "category",
        "left",
    )
    if not strict_fanout:
        lead = lead.groupBy("fsn", "fc").agg(F.max("policy_lt").alias("policy_lt"))
        by_category = by_category.groupBy("fsn").agg(F.max("cat_lead_time").alias("cat_lead_time"))
    with_lead = daily.join(by_category, "fsn").join(lead, ["fsn", "fc"], "left")
    lead_days = F.coalesce("policy_lt", "cat_lead_time")
    due = po_due(F.col("poi_created_day"), F.col("po_status"), lead_days, period)
    return (
        with_lead.where(due)
        .groupBy("fsn", "fc")
        .agg(strict_sum("missing").alias("vendor_adherence_issue"))
    )
