"""Cleaning of the inputs and the small tables derived from one input each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import Period, parse_date, week_of_year
from shortfall.functions.nulls import (
    count_distinct_na,
    fill_zero,
    if_else,
    strict_sum,
)
from shortfall.functions.text import first_of_list
from shortfall.operators.relational import cast_numeric, columns_like, distinct_by, drop_sentinels

# Fixed values of the input data: lane classes, stand-ins for a missing lane,
# and the sales measures and product hierarchy columns.
NEAR_LANES = ["L1", "L2", "Z1", "Z2"]
NATIONAL_LANES = ["N1", "N2"]
LANE_SENTINELS = ["", "0", "NULL"]
SALES_MEASURES = ["sales", "ru_sales", "nat_sales"]
HIERARCHY = ["bu", "super_category", "category", "vertical", "brand"]
FORECASTS = [
    "forecast_n", "forecast_n1", "forecast_n2", "forecast_n3",
    "forecast_n4", "forecast_n5", "forecast_n6", "forecast_n7",
]
PLAN_QTYS = [
    "system_qty", "max_doh_qty", "ipc_reviewed_qty", "cdo_reviewed_qty",
    "po_qty", "po_received_qty", "po_rejected_qty", "po_cancel_qty",
]


def drop_fcs(sales_raw: DataFrame, fcs: Sequence[str]) -> DataFrame:
    """Leave out the sales of fulfilment centres that are not analysed."""
    return sales_raw.where(~F.col("fc").isin(*fcs)) if fcs else sales_raw


def clean_sales(
    sales_raw: DataFrame,
    period: Period,
    drop: Sequence[str] = (),
    by: str = "week",
    national: str = "given",
) -> DataFrame:
    """Sales lines of the reporting period with the units no lane explains.

    ``by="week"`` selects on the week number, and on the year where the table
    has days; ``by="day"`` on the dates.
    ``national="derived"`` recomputes national units as all that is not regional.
    """
    if by == "week":
        in_period = F.col("week") == period.week
        if "day" in sales_raw.columns:
            new_year, last_day = dt.date(period.year, 1, 1), dt.date(period.year, 12, 31)
            in_period &= F.col("day").isNull() | F.col("day").between(new_year, last_day)
    else:
        in_period = F.col("day").between(period.wk_start, period.wk_end)
    has_product = F.col("fsn").cast("string") != ""
    sales = drop_fcs(sales_raw, drop).where(in_period & has_product)
    if "destination_pincode" in sales.columns:
        sales = sales.withColumnRenamed("destination_pincode", "dest_pincode")
    if national == "derived":
        return sales.withColumn("nat_sales", F.col("sales") - F.col("ru_sales"))
    return sales.withColumn(
        "unmapped_sales", F.col("sales") - F.col("ru_sales") - F.col("nat_sales")
    )


def clean_lanes(lzn_mapping: DataFrame) -> DataFrame:
    """Lanes with a real lane class."""
    return drop_sentinels(lzn_mapping, "lzn_value", LANE_SENTINELS).withColumnRenamed(
        "src_fc_code", "fc"
    )


def near_lanes(lanes: DataFrame) -> DataFrame:
    """Local and zonal lanes only."""
    return lanes.where(F.col("lzn_value").isin(*NEAR_LANES))


def sales_by(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units per key; a missing quantity makes the total of its key missing."""
    return sales.groupBy(*keys).agg(*[strict_sum(c).alias(c) for c in SALES_MEASURES])


def sales_by_fsn_dp(sales: DataFrame) -> DataFrame:
    return sales_by(sales, ["fsn", "dest_pincode"])


def sales_by_fsn_dp_fc(sales: DataFrame) -> DataFrame:
    return sales_by(sales, ["fsn", "dest_pincode", "fc"])


def sales_by_hierarchy(sales: DataFrame) -> DataFrame:
    return sales_by(sales, ["fsn", *HIERARCHY, "dest_pincode"])


def week_products(sales: DataFrame) -> DataFrame:
    """Products sold in the period with their category."""
    return distinct_by(sales, ["fsn", "category"])


def fsn_vendor_count(vendor_site: DataFrame) -> DataFrame:
    """Vendor sites per product and fulfilment centre."""
    return vendor_site.groupBy("fsn", "fc").agg(count_distinct_na("vsid").alias("fsn_vendor_count"))


def brand_vendor_count(vendor_brand: DataFrame) -> DataFrame:
    """Vendor sites per brand, vertical and fulfilment centre."""
    return vendor_brand.groupBy("brand", "vertical", "fc").agg(
        count_distinct_na("vsid").alias("brand_vendor_count")
    )


def active_exclusions(exclusion_list: DataFrame, period: Period) -> DataFrame:
    """Products still excluded at the start of the period."""
    skip_date = F.col("skip_upto")
    if dict(exclusion_list.dtypes)["skip_upto"] != "date":
        skip_date = parse_date(skip_date)
    return (
        exclusion_list.where(skip_date >= F.lit(period.wk_start))
        .select("fsn")
        .distinct()
        .withColumn("is_excluded", F.lit(1))
    )


def policy_lead_time(
    lead_time: DataFrame, products: DataFrame, cat_lead_time: DataFrame, period: Period
) -> DataFrame:
    """Lead time per sold product and fulfilment centre, and the week its plan was made.

    A lead time under a day means "use the category's". Sold products without
    any lead time stay, with missing centre and lead time.
    """
    # a category has far fewer products than rows: its lead time is joined to these, not by a handful of keys later
    joined = products.join(
        cat_lead_time.select("category", F.col("lead_time").alias("cat_lead_time")),
        "category",
        "left",
    ).join(lead_time.select("fsn", F.col("warehouse").alias("fc"), "lead_time"), "fsn", "left")
    policy = if_else(F.col("lead_time") < 1, F.col("cat_lead_time"), F.col("lead_time"))
    plan_day = F.date_sub(F.lit(period.wk_start), F.ceil("policy_lt").cast("int"))
    return joined.withColumn("policy_lt", policy.cast("double")).select(
        "fsn",
        "fc",
        "category",
        "lead_time",
        "cat_lead_time",
        "policy_lt",
        week_of_year(plan_day, period.week_rule).alias("reco_week"),
    )


def one_lead_time(lead_times: DataFrame) -> DataFrame:
    """``policy_lead_time`` with one row per product and centre.

    Where rows of several categories differ, the longest lead time is taken,
    then the last category by name.
    """
    rest = [c for c in lead_times.columns if c not in ("fsn", "fc", "policy_lt", "category")]
    longest = F.max(F.struct("policy_lt", "category", *rest)).alias("longest")
    return (
        lead_times.groupBy("fsn", "fc")
        .agg(longest)
        .select(*[c if c in ("fsn", "fc") else f"longest.{c}" for c in lead_times.columns])
    )


def requirement_clean(requirement: DataFrame) -> DataFrame:
    """Plan rows with numeric quantities; what is missing or not a number is zero."""
    df = requirement.withColumnsRenamed({"warehouse": "fc", "week": "reco_week"})
    df = cast_numeric(df, columns_like(df, prefixes=["forecast"], suffixes=["qty"]))
    return fill_zero(df, [c for c in FORECASTS + PLAN_QTYS if c in df.columns])


def preferred_fc(preferred_warehouse: DataFrame) -> DataFrame:
    """First preferred fulfilment centre per destination."""
    return preferred_warehouse.select(
        F.col("pincode").alias("dest_pincode"),
        first_of_list("preferred_fc_non_large").alias("pref_fc"),
    )


def offer_sales_week(offer_sales: DataFrame, period: Period) -> DataFrame:
    """Units sold on offer in the reporting week."""
    return (
        offer_sales.where(F.col("week_num") == period.week)
        .groupBy("fsn", "dest_pincode")
        .agg(strict_sum("offer_sales").alias("offer_sales"))
    )
