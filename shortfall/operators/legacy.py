"""The earlier form of the job: matrix placement, plan files, its own cascade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import (
    Period,
    days_between,
    parse_date,
    sunday_on_or_before,
    week_of_year,
)
from shortfall.functions.nulls import excess, fill_zero, strict_sum, sum_or_zero, zero
from shortfall.functions.text import is_true
from shortfall.operators.allocate import cascade
from shortfall.operators.issues import PO_CLOSED, PO_OPEN, units_offered_nearby
from shortfall.operators.relational import (
    join_chain,
    overwrite_where,
    salted_join,
    union_ragged,
    wide_to_long,
)
from shortfall.operators.skew import HeavyKeys, heavy_join, heavy_keys

PAIR = ["fsn", "dest_pincode"]

# Where the centre code starts in the lead-time headers, the lead
# time where none is given, and the weeks of open orders looked back on.
FC_CODE_START = 15
DEFAULT_LEAD_TIME = 7
PO_WINDOW_DAYS = 70
RECO_FORECASTS = ["Forecast_week_1", "Forecast_week_2", "Forecast_week_3", "Forecast_week_4"]

BLOCKED_LOSSES = ["servicibility_loss", "tax_loss", "vendor_loss", "u2s_loss"]
PLACED_LOSSES = [
    "ndoh_loss", "ff_loss", "exclusion_loss", "adherence_loss",
    "lead_time_loss", "forecast_error", "promotions_loss",
]
BU_MEASURES = [
    "ru_sales", "nat_sales", "servicibility_loss", "tax_loss", "u2s_loss",
    "low_sale_depth_loss", "vendor_loss", "ndoh_loss", "ff_loss", "exclusion_loss",
    "adherence_loss", "lead_time_loss", "forecast_error", "promotions_loss", "residual",
]


def blocked_losses(
    sales_fsn_dp: DataFrame,
    availability: DataFrame,
    loss_class: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """National units of the pairs without an available or an open centre.

    Rows of heavy destinations (``heavy``, or counted in the sales) are spread by product.
    """
    served = availability.select(
        F.col("Destination_Pincode").alias("dest_pincode"), "fc_available_flag"
    )
    placed = heavy_join(sales_fsn_dp, served, ["dest_pincode"], ["fsn"], "left", heavy)
    joined = placed.join(loss_class, PAIR, "left")
    unserved = F.col("fc_available_flag") == 0
    nat = F.col("nat_sales")

    def units(cond):
        return F.coalesce(F.when(cond, nat), F.lit(0.0))

    return joined.where(unserved | F.col("loss").isNotNull()).select(
        *sales_fsn_dp.columns,
        units(unserved).alias("servicibility_loss"),
        units(F.col("loss") == "tax").alias("tax_loss"),
        units(F.col("loss") == "vendor").alias("vendor_loss"),
        units(F.col("loss") == "u2s").alias("u2s_loss"),
    )


def fe_issue_tiered(
    explain: DataFrame, lane_static: DataFrame, lane_source: DataFrame, lane_tier: DataFrame
) -> DataFrame:
    """``fulfilment_engine_issue`` where the lane comes from source and destination
    and a near offer counts only on a tier the centre has for the destination."""
    lanes = (
        lane_static.join(lane_source, "source_pincode", "left")
        .select("dest_pincode", "source_id", F.col("lzn").alias("lzn_value"))
        .distinct()
    )
    tiers = lane_tier.select(
        "dest_pincode",
        F.col("warehouse").alias("source_id"),
        F.col("tier").alias("lpe_tier"),
        F.lit("ACTIVE").alias("tier_status"),
    ).distinct()
    offers = explain.withColumnRenamed("accepted", "is_accepted")
    # no other offer can count, so none is shuffled
    offers = offers.where(is_true("is_accepted") | (F.col("effective_inventory") > 0))
    offers = salted_join(offers, lanes, ["dest_pincode", "source_id"], ["fiu_id"], how="left")
    offers = salted_join(
        offers, tiers, ["dest_pincode", "source_id", "lpe_tier"], ["fiu_id"], how="left"
    ).fillna("INACTIVE", subset=["tier_status"])
    return units_offered_nearby(offers, F.col("tier_status") == "ACTIVE")


def ff_allocation(ratio: DataFrame, unblocked: DataFrame, ff_issue: DataFrame) -> DataFrame:
    """National units of each open pair, less fulfilment issues, split over its centres.

    The difference is not clamped: a pair with more issues than units goes negative.
    """
    per_pair = (
        unblocked.groupBy(*PAIR)
        .agg(sum_or_zero("nat_sales").alias("ru_loss"))
        .join(ff_issue.select(*PAIR, F.col("fe_issue").alias("ff_loss")), PAIR, "left")
        .withColumn("ff_loss", zero(F.col("ff_loss").cast("double")))
        .withColumn("loss_at_dp_fsn_lvl", F.col("ru_loss") - F.col("ff_loss"))
    )
    return (
        ratio.join(per_pair, PAIR, "left")
        .withColumn("loss_post_ratio", F.col("ratio") * F.col("loss_at_dp_fsn_lvl"))
        .withColumn("ff_loss_post_ratio", F.col("ratio") * F.col("ff_loss"))
    )


def unpivot_leadtime(leadtime_wide: DataFrame, ids: Sequence[str] = ("fsn",)) -> DataFrame:
    """Lead time per product and centre; the header carries the centre code.

    ``ids`` are the columns that are not lead times.
    """
    long = wide_to_long(leadtime_wide, list(ids), "variable", "policy_lead_time")
    return long.select(
        *ids,
        F.expr(f"substring(variable, {FC_CODE_START})").alias("FC"),
        F.col("policy_lead_time").cast("double").alias("policy_lead_time"),
    )


def policy_lead_time_floor(
    leadtime_wide: DataFrame, products: DataFrame, cat_floor: DataFrame, period: Period
) -> DataFrame:
    """Lead time with default and category floor, and the week of the plan behind it."""
    lead = F.col("policy_lead_time")
    days = (
        F.when(lead.isNull(), F.lit(float(DEFAULT_LEAD_TIME)))
        .when(lead == 0, F.col("Lead_time_floor").cast("double"))
        .otherwise(lead)
    )
    placed = F.date_sub(F.lit(period.wk_start), F.ceil("policy_lead_time").cast("int"))
    floors = products.join(cat_floor.select("category", "Lead_time_floor"), "category", "left")
    # joined by product while there is one row for all its centres
    wide = leadtime_wide.join(floors.select("fsn", "category", "Lead_time_floor"), "fsn", "left")
    return (
        unpivot_leadtime(wide, ["fsn", "category", "Lead_time_floor"])
        .withColumn("policy_lead_time", days)
        .withColumn("reco_date", sunday_on_or_before(placed))
        .withColumn("reco_week", week_of_year("reco_date", period.week_rule))
        .select("fsn", "FC", "category", "policy_lead_time", "reco_date", "reco_week")
    )


def reco_agg(lead: DataFrame, reco_file: DataFrame, week_rule: str = "block") -> DataFrame:
    """Planned, forecast and generated units one lead time before the period.

    Plan rows are added up per product, centre and week before the join; which
    forecast week applies depends on the lead time alone.
    """
    week = week_of_year(parse_date("reco_date", "dd/MM/yyyy"), week_rule)
    recommended, generated = F.col("`Qty.Recommended`"), F.col("`Qty.Generated`")
    plan = (
        reco_file.groupBy(F.col("FSN").alias("fsn"), "FC", week.alias("reco_week"))
        .agg(
            strict_sum(recommended).alias("recommended"),
            strict_sum(generated).alias("generated"),
            *[strict_sum(c).alias(c) for c in RECO_FORECASTS],
        )
    )
    k = F.ceil(F.col("policy_lead_time") / 7).cast("int")
    mean = sum((F.col(c) for c in RECO_FORECASTS[1:]), F.col(RECO_FORECASTS[0])) / 4
    forecast = (
        F.when(k.isNull(), F.lit(None))
        .when(k.between(1, 4), F.get(F.array(*RECO_FORECASTS), k - 1))
        .otherwise(mean)
    )
    return (
        lead.join(plan, ["fsn", "FC", "reco_week"])
        .withColumn("forecast_qty", forecast)
        .groupBy("fsn", "FC", "reco_week")
        .agg(
            strict_sum("recommended").alias("total_qty_recomended"),
            strict_sum("forecast_qty").alias("total_forecast_qty"),
            strict_sum("generated").alias("projected_qty"),
        )
    )


def forecast_diff(preferred_wh: DataFrame, sales_fsn_dp: DataFrame, reco: DataFrame) -> DataFrame:
    """Units sold beyond the forecast of the preferred centre.

    Only destinations that have a preferred centre count. One without sales
    has no product and so gives no row.
    """
    sold = (
        salted_join(sales_fsn_dp, preferred_wh, ["dest_pincode"], ["fsn"])
        .groupBy("fsn", F.col("preferred_wh").alias("FC"))
        .agg(strict_sum("sales").alias("sales"))
    )
    plan = reco.groupBy("fsn", "FC").agg(F.sum("total_forecast_qty").alias("total_forecast_qty"))
    return (
        sold.join(plan, ["fsn", "FC"], "left")
        .withColumn("total_forecast_qty", zero("total_forecast_qty"))
        .withColumn("forecast_diff", excess("sales", "total_forecast_qty"))
        .select("fsn", "FC", "forecast_diff")
    )


def national_doh(reco: DataFrame) -> DataFrame:
    """Units generated but not recommended."""
    return reco.groupBy("fsn", "FC").agg(
        F.sum(excess(zero("projected_qty"), zero("total_qty_recomended"))).alias("national_doh")
    )


def po_adherence(raised: DataFrame, reco: DataFrame) -> DataFrame:
    """Units ordered against units recommended per product and centre."""
    keyed = raised.withColumnRenamed("weeknum", "reco_week")
    return (
        keyed.join(reco, ["fsn", "FC", "reco_week"], "right")
        .groupBy("fsn", "FC")
        .agg(
            sum_or_zero("total_po_raised_qty").alias("total_po_raised_qty"),
            sum_or_zero("total_qty_recomended").alias("final_qty_recommended"),
        )
    )


def po_leadtime_window(receipts: DataFrame, lead: DataFrame, period: Period) -> DataFrame:
    """Ordered and received units that were due in the period, or in the weeks
    before it for orders still open.

    The longest lead time counts where a product has several at a centre.
    """
    longest = lead.groupBy("fsn", "FC").agg(F.max("policy_lead_time").alias("policy_lead_time"))
    lead_days = F.coalesce(F.col("policy_lead_time"), F.lit(float(DEFAULT_LEAD_TIME)))
    placed = parse_date("poi_initiated_date_key", "yyyyMMdd")
    status = F.col("poi_status")

    def due_since(start):
        return (lead_days >= days_between(start, placed)) & (
            lead_days <= days_between(period.wk_end, placed)
        )

    due = ((status == PO_OPEN) & due_since(period.shift("wk_start", -PO_WINDOW_DAYS))) | (
        (status == PO_CLOSED) & due_since(period.wk_start)
    )
    return (
        receipts.where(status.isin(PO_OPEN, PO_CLOSED))
        .join(longest, ["fsn", "FC"], "left")
        .where(due)
        .groupBy("fsn", "FC")
        .agg(
            zero(strict_sum("poi_received_quantity")).alias("po_received_quantity"),
            zero(strict_sum("poi_ordered_quantity")).alias("po_ordered_quantity"),
        )
    )


def cascade_g1(
    allocated: DataFrame,
    exclusions: DataFrame,
    offers: DataFrame,
    po_window: DataFrame,
    adherence: DataFrame,
    doh: DataFrame,
    forecast: DataFrame,
) -> DataFrame:
    """Earlier cause order: forecast, stock cover, exclusion, adherence, lead time, promotions."""
    by_product = join_chain(allocated, [exclusions, offers], ["fsn"])
    joined = join_chain(by_product, [po_window, adherence, doh, forecast], ["fsn", "FC"])
    filled = fill_zero(
        joined,
        [
            "po_received_quantity", "po_ordered_quantity", "final_qty_recommended",
            "total_po_raised_qty", "ff_loss_post_ratio", "national_doh", "loss_post_ratio",
            "exclusion_flag", "offer_sales", "forecast_diff",
        ],
    )
    issues = filled.withColumns(
        {
            "adherence_issue": excess("final_qty_recommended", "total_po_raised_qty"),
            "lead_time_issue": excess("po_ordered_quantity", "po_received_quantity"),
            "offer_issue": F.greatest(F.col("offer_sales"), F.lit(0.0)),
        }
    )
    return cascade(
        issues,
        "loss_post_ratio",
        [
            ("forecast_error", "forecast_diff"),
            ("ndoh_loss", "national_doh"),
            ("exclusion_loss", "exclusion_flag", "all_if_flag"),
            ("adherence_loss", "adherence_issue"),
            ("lead_time_loss", "lead_time_issue"),
            ("promotions_loss", "offer_issue"),
        ],
    )


def placed_losses(cascaded: DataFrame) -> DataFrame:
    """The causes of ``cascade_g1`` per pair."""
    return (
        cascaded.withColumn("ff_loss", F.col("ff_loss_post_ratio"))
        .groupBy(*PAIR)
        .agg(*[sum_or_zero(c).alias(c) for c in PLACED_LOSSES])
    )


def waterfall_g1(
    sales_fsn_dp: DataFrame,
    blocked: DataFrame,
    cascaded: DataFrame,
    products: DataFrame,
    low_sale: DataFrame,
) -> DataFrame:
    """Earlier final table. Low sales depth overrides the causes it is checked
    after, and the residual is what no cause explains."""
    causes = union_ragged(blocked.select(*PAIR, *BLOCKED_LOSSES), placed_losses(cascaded))
    measures = ["sales", "ru_sales", "nat_sales", *BLOCKED_LOSSES, *PLACED_LOSSES]
    base = fill_zero(sales_fsn_dp.join(causes, PAIR, "left"), measures)
    low = low_sale.select("fsn").distinct().withColumn("__low", F.lit(True))
    kept = ["servicibility_loss", "tax_loss", "u2s_loss"]
    before = sum((F.col(c) for c in kept[1:]), F.col(kept[0]))
    with_low = (
        base.join(products, "fsn")
        .join(low, "fsn", "left")
        .withColumn(
            "low_sale_depth_loss",
            F.when(F.col("__low"), F.col("nat_sales") - before).otherwise(F.lit(0.0)),
        )
        .drop("__low")
    )
    overridden = overwrite_where(
        with_low, F.col("low_sale_depth_loss") > 0, ["vendor_loss", *PLACED_LOSSES], 0.0
    )
    explained = [*BLOCKED_LOSSES, "low_sale_depth_loss", *PLACED_LOSSES]
    return overridden.withColumn(
        "residual", excess(F.col("nat_sales"), sum((F.col(c) for c in explained), F.lit(0.0)))
    )


def waterfall_by_bu(waterfall: DataFrame, keep_tax: bool = False) -> DataFrame:
    """Measures per business unit; rows with a missing measure are left out."""
    by_bu = (
        waterfall.dropna(subset=["bu", *BU_MEASURES])
        .groupBy("bu")
        .agg(*[F.sum(c).alias(c) for c in BU_MEASURES])
    )
    return by_bu if keep_tax else by_bu.drop("tax_loss")


def bu_share_pct(by_bu: DataFrame) -> DataFrame:
    """Each measure as a share of regional and national units."""
    units = F.col("ru_sales") + F.col("nat_sales")
    measures = [c for c in by_bu.columns if c != "bu"]
    return by_bu.select(
        "bu", *[F.round(F.col(c) * 100 / units, 2).alias(f"{c}_pct") for c in measures]
    )


def enrich_output(
    waterfall: DataFrame,
    titles: DataFrame,
    zones: DataFrame,
    lane_fcs: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Add product title, destination zone and near centres.

    Rows of heavy destinations (``heavy``, or counted in the waterfall) are spread by product.
    """
    place = ["dest_pincode"]
    heavy = heavy or heavy_keys(waterfall, place)
    titled = waterfall.join(titles.select("fsn", "title").distinct(), "fsn", "left")
    zoned = heavy_join(titled, zones.select(*place, "Zone").distinct(), place, ["fsn"], "left", heavy)
    return heavy_join(zoned, lane_fcs.select(*place, "LZ-FC").distinct(), place, ["fsn"], "left", heavy)


def pe_excess_inventory(sales_day: DataFrame, inventory: DataFrame) -> DataFrame:
    """National units that stock in the centre could have served on the day."""
    keys = ["fsn", "fc", "day"]
    sold = sales_day.groupBy(*keys).agg(
        sum_or_zero("ru_sales").alias("ru_sales"), sum_or_zero("nat_sales").alias("nat_sales")
    )
    stock = inventory.groupBy(*keys).agg(sum_or_zero("inventory").alias("inventory"))
    spare = excess(zero("inventory"), "ru_sales")
    return (
        sold.join(stock, keys, "left")
        .withColumn("pe_excess_inv", F.least(spare, F.col("nat_sales")))
        .groupBy("fsn", "fc")
        .agg(F.sum("pe_excess_inv").alias("pe_excess_inv"))
    )
