"""Queries of the weekly run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from shortfall.functions.dates import reporting_period
from shortfall.operators import allocate, centres, issues, placement, prepare, quality, waterfall
from shortfall.operators.allocate import CASCADE_LOSSES
from shortfall.operators.placement import PLACEMENT_LOSSES
from shortfall.plans.driver_tables import PERIOD
from shortfall.plans.job import DETAIL, export_weekly, run_weekly
from shortfall.plans.registry import Presented, presentable, query, rounded
from shortfall.plans.weekly import WeeklyInputs, WeeklyOptions, WeeklyRun
from shortfall.sources.stage import new_path, stage

CASCADE = rounded([*CASCADE_LOSSES, "residual"])
LOSSES = rounded(waterfall.LOSSES)
PAIR = "fsn, dest_pincode"

query(
    "reporting_period",
    """SELECT CAST(as_of AS VARCHAR) AS as_of, CAST(wk_end AS VARCHAR) AS wk_end, CAST(wk_end - 6 AS VARCHAR) AS wk_start,
       CAST((dayofyear(wk_end) - 1) // 7 + 1 AS INTEGER) AS ru_week, CAST(year(wk_end) AS INTEGER) AS ru_year,
       CAST(strftime(wk_end - 6, '%Y%m%d') AS INTEGER) AS week_start_date_key
       FROM (SELECT d AS as_of, d - 1 - CAST(dayofweek(d - 1) + 1 AS INTEGER) AS wk_end
             FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x) y""",
)(
    lambda t: reporting_period(
        t.table("orders").select(F.to_date("o_orderdate").alias("as_of")).distinct(), "as_of"
    )
)

query(
    "sales_clean",
    """SELECT CAST(day AS VARCHAR) AS day, fiu_id, fsn, dest_pincode, fc, sales, ru_sales, nat_sales, unmapped_sales
       FROM a_sales WHERE fc NOT IN ('1')""",
)(
    lambda t: prepare.clean_sales(t.sales_raw, PERIOD, drop=["1"], by="day").select(
        "day", "fiu_id", "fsn", "dest_pincode", "fc",
        "sales", "ru_sales", "nat_sales", "unmapped_sales",
    )
)

query(
    "sales_week",
    """SELECT fsn, dest_pincode, CAST(day AS VARCHAR) AS day, sales, ru_sales, nat_sales,
       sales - ru_sales - nat_sales AS unmapped_sales FROM a_sales_raw WHERE (dayofyear(day) - 1) // 7 + 1 = 26
       AND year(day) = 1998""",
)(
    lambda t: prepare.clean_sales(
        t.sales_raw.withColumn("week", F.floor((F.dayofyear("day") - 1) / 7) + 1), PERIOD
    ).select(
        "fsn", "dest_pincode", "day", "sales", "ru_sales", "nat_sales", "unmapped_sales"
    )
)

query("lanes_clean", "SELECT fc, src_pincode, dest_pincode, lzn_value FROM d_lanes")(
    lambda t: t.weekly.lanes.select("fc", "src_pincode", "dest_pincode", "lzn_value")
)
query("lanes_lz", "SELECT fc, src_pincode, dest_pincode, lzn_value FROM d_lz")(
    lambda t: prepare.near_lanes(t.weekly.lanes).select(
        "fc", "src_pincode", "dest_pincode", "lzn_value"
    )
)
query("serviceability", "SELECT * FROM d_serviceability")(lambda t: t.weekly.serviceability)
query("vendor_count_fsn_fc", "SELECT * FROM d_vendor_fsn")(lambda t: t.weekly.fsn_vendors)
query("vendor_count_brand", "SELECT * FROM d_vendor_brand")(lambda t: t.weekly.brand_vendors)
query("candidate_fcs", "SELECT * FROM d_candidates")(lambda t: t.weekly_staged.candidates)
query(
    "supplied_fcs",
    "SELECT fsn, dest_pincode, brand, vertical, fc, vendor_count FROM d_candidates WHERE vendor_count > 0",
)(
    lambda t: placement.supplied_fcs(
        t.weekly_staged.pairs, t.weekly_staged.lanes, t.weekly_staged.fsn_vendors, t.weekly_staged.brand_vendors
    )
)
query(
    "centre_sets",
    """SELECT fsn, dest_pincode, CAST(SUM(vendor_count) AS BIGINT) AS vendor_count, COUNT(DISTINCT fc) AS fc_count,
       string_agg(DISTINCT fc, ',' ORDER BY fc) AS fcs FROM d_candidates WHERE vendor_count > 0 GROUP BY fsn, dest_pincode""",
)(
    lambda t: centres.names_of_sets(
        t.weekly_staged.centre_sets,
        t.weekly_staged.near_centres,
        centres.counts_of_sets(t.weekly_staged.centre_sets),
    ).withColumn("fcs", F.array_join("fcs", ","))
)
query("vendor_availability", "SELECT * FROM d_vendor_avl")(lambda t: t.weekly_staged.vendor_availability)
query("low_sales_depth", "SELECT * FROM d_low_sales")(lambda t: t.weekly.low_sales)
query(
    "low_sales_depth_strict",
    "SELECT * FROM d_low_sales WHERE sales < min_sales_depth",
)(
    lambda t: placement.low_sales_depth(
        t.history, t.min_sale_threshold, PERIOD, inclusive=False
    )
)
query("low_sale_products", "SELECT * FROM d_low_products")(lambda t: t.weekly.low_products)
query("active_exclusions", "SELECT * FROM d_exclusions")(lambda t: t.weekly.exclusions)
query("placement_losses", "SELECT * FROM d_placement")(lambda t: t.weekly_staged.placement)
query("placement_blocked", "SELECT * FROM d_blocked")(lambda t: t.weekly_staged.blocked)
query("fe_issue", "SELECT * FROM d_fe_issue")(lambda t: t.weekly_staged.fe_issue)
query(
    "fe_issue_week",
    """SELECT e.fsn, e.dest_pincode, COUNT(DISTINCT e.fiu_id) AS fe_issue FROM a_explain e
       JOIN a_explain n ON n.fiu_id = e.fiu_id
       WHERE e.lzn_value IN ('L1', 'L2', 'Z1', 'Z2') AND e.effective_inventory > 0
         AND n.lzn_value IN ('N1', 'N2') AND n.is_accepted = 'true'
         AND (dayofyear(e.day) - 1) // 7 + 1 = 26 AND (dayofyear(n.day) - 1) // 7 + 1 = 26
         AND year(e.day) = 1998 AND year(n.day) = 1998
       GROUP BY e.fsn, e.dest_pincode""",
)(
    lambda t: issues.fulfilment_engine_issue(
        t.explain.withColumn("day", F.date_format("day", "yyyyMMdd").cast("int")), PERIOD
    )
)
query(
    "policy_lead_time",
    """SELECT fsn, fc, category, lead_time, cat_lead_time, policy_lt,
       CAST((dayofyear(DATE '1997-06-29' - CAST(policy_lt AS INTEGER)) - 1) // 7 + 1 AS INTEGER) AS reco_week FROM d_lead""",
)(lambda t: t.weekly.lead_time)


def _dirty_requirement(t):
    """The plan as text in which some quantities are not numbers."""
    q = F.col("q")
    dirty = F.when(q % 4 == 0, "NULL").otherwise(q.cast("string"))
    return t.planned_units.select(
        F.col("l_partkey").alias("fsn"),
        F.col("l_suppkey").cast("string").alias("warehouse"),
        (q % 53).alias("week"),
        dirty.alias("system_qty"),
        q.cast("string").alias("po_qty"),
        F.when(q % 3 > 0, (q % 20).cast("string")).alias("forecast_n"),
    )


query(
    "requirement_clean",
    """SELECT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc, q % 53 AS reco_week,
       CAST(CASE WHEN q % 4 = 0 THEN 0 ELSE q END AS DOUBLE) AS system_qty, CAST(q AS DOUBLE) AS po_qty,
       CAST(CASE WHEN q % 3 > 0 THEN q % 20 ELSE 0 END AS DOUBLE) AS forecast_n FROM a_planned""",
)(lambda t: prepare.requirement_clean(_dirty_requirement(t)))

query(
    "reco_at_lead_time",
    f"SELECT fsn, fc, category, policy_lt, policy_lt_week, {rounded(['forecast_qty'])} FROM d_reco",
)(
    lambda t: t.weekly.reco.select(
        "fsn", "fc", "category", "policy_lt", "policy_lt_week", "forecast_qty"
    )
)
query(
    "reco_table_sum",
    f"""SELECT fsn, fc, {rounded(['forecast_qty'])} FROM (
        SELECT fsn, fc, CASE WHEN policy_lt_week BETWEEN 1 AND 8 THEN forecast_qty ELSE
          (SELECT SUM(forecast_n + forecast_n1 + forecast_n2 + forecast_n3 + forecast_n4 + forecast_n5 + forecast_n6
                      + forecast_n7) / 8.0 FROM d_reco) END AS forecast_qty FROM d_reco) x""",
)(
    lambda t: issues.reco_at_lead_time(
        prepare.requirement_clean(t.requirement), t.weekly.lead_time, ("fsn", "fc"), "table_sum", stage
    ).select("fsn", "fc", "forecast_qty")
)
query("preferred_fc", "SELECT * FROM d_pref_fc")(lambda t: t.weekly.preferred)
query(
    "forecast_issue",
    f"SELECT fsn, fc, sales, {rounded(['forecast_qty', 'forecast_issue'])} FROM d_forecast",
)(lambda t: t.weekly.forecast_issue)
query("override_issues", "SELECT * FROM d_override")(lambda t: t.weekly.override_issues)
query(
    "override_issues_raise",
    """SELECT fsn, fc, CAST(GREATEST(system_qty - max_doh_qty, 0) AS DOUBLE) AS ndoh_issue,
       CAST(GREATEST(ipc_reviewed_qty - max_doh_qty, 0) AS DOUBLE) AS ipc_override_issue,
       CAST(GREATEST(cdo_reviewed_qty - ipc_reviewed_qty, 0) AS DOUBLE) AS cdo_override_issue,
       CAST(GREATEST(po_qty - cdo_reviewed_qty, 0) AS DOUBLE) AS po_issue FROM d_reco""",
)(lambda t: issues.override_issues(t.weekly.reco, direction="raise"))
query("vendor_adherence", "SELECT * FROM d_adherence")(lambda t: t.weekly_staged.adherence_issue)
query("unblocked_sales", "SELECT * FROM d_unblocked")(lambda t: t.weekly_staged.unblocked)
query(
    "fe_loss",
    "SELECT fsn, dest_pincode, nat_sales, CAST(fe_loss AS DOUBLE) AS fe_loss, fsn_dp_loss FROM d_pool",
)(lambda t: allocate.fe_loss(t.weekly_staged.unblocked, t.weekly_staged.fe_issue))


def _allocated(t):
    """The split ratio with the pool of its pair, allocated before a pair's centres become rows."""
    w = t.weekly_staged
    return centres.split_ratio_of_sets(
        w.centre_sets,
        w.near_centres,
        w.pool.select("fsn", "dest_pincode", "fsn_dp_loss"),
        lambda share: presentable(allocate.allocate_to_fc(share)),
    )


query("fc_split_ratio", f"SELECT {PAIR}, fc, {rounded(['ratio'])} FROM d_ratio")(
    lambda t: Presented(
        centres.split_ratio_of_sets(t.weekly_staged.centre_sets, t.weekly_staged.near_centres, finish=presentable)
    )
)
query(
    "allocate_to_fc",
    f"SELECT {PAIR}, fc, {rounded(['ratio', 'fsn_dp_loss', 'fsn_dp_fc_loss'])} FROM d_allocated",
)(lambda t: Presented(_allocated(t)))


def _all_cascaded(t):
    """The cascade with the rows that have nothing to allocate."""
    w = t.weekly_staged
    return allocate.cascade_of_sets(
        w.centre_sets, w.near_centres, w.pool, w.forecast_issue, w.override_issues, w.adherence_issue, presentable
    )


query(
    "cascade_losses",
    f"SELECT {PAIR}, fc, {rounded(['fsn_dp_fc_loss'])}, {CASCADE} FROM d_cascade",
)(
    lambda t: Presented(
        _all_cascaded(t).select("fsn", "dest_pincode", "fc", "fsn_dp_fc_loss", *CASCADE_LOSSES, "residual")
    )
)
query("cascade_by_fsn_dp", f"SELECT {PAIR}, {CASCADE} FROM d_by_dest")(
    lambda t: allocate.cascade_of_supply(t.weekly_staged.supply, t.weekly_staged.cascaded)
)
query(
    "loss_union_sum",
    f"SELECT {PAIR}, {rounded([*PLACEMENT_LOSSES, 'fe_loss'])}, {CASCADE} FROM d_losses",
)(
    lambda t: allocate.combine_losses(
        t.weekly_staged.blocked, t.weekly_staged.pool, t.weekly_staged.by_destination
    )
)
query("offer_sales_week", "SELECT * FROM a_offer")(lambda t: t.weekly.offers)
query(
    "promotions_excess",
    f"SELECT {PAIR}, offer_sales, {rounded(['promotions_loss', 'residual'])} FROM d_promo",
)(
    lambda t: t.weekly_staged.with_promotions.select(
        "fsn", "dest_pincode", "offer_sales", "promotions_loss", "residual"
    )
)
query(
    "promotions_capped",
    f"""SELECT {PAIR}, {rounded(['offer_sales', 'promotions_loss', 'residual'])} FROM (
        SELECT l.fsn, l.dest_pincode, COALESCE(o.offer_sales, 0) AS offer_sales,
               LEAST(l.residual, COALESCE(o.offer_sales, 0)) AS promotions_loss,
               l.residual - LEAST(l.residual, COALESCE(o.offer_sales, 0)) AS residual
        FROM d_losses l LEFT JOIN a_offer o ON o.fsn = l.fsn AND o.dest_pincode = l.dest_pincode) x""",
)(
    lambda t: waterfall.promotions_loss(
        t.weekly_staged.losses, t.weekly_staged.offers, "capped"
    ).select(
        "fsn", "dest_pincode", "offer_sales", "promotions_loss", "residual"
    )
)

DETAIL_KEYS = (
    "fsn, dest_pincode, bu, super_category, category, vertical, brand, "
    "ru_computed_week, ru_year, week_start_date_key"
)
DETAIL_MEASURES = f"sales, ru_sales, nat_sales, unmapped_sales, {LOSSES}"

query("waterfall_detail", f"SELECT {DETAIL_KEYS}, {DETAIL_MEASURES} FROM d_detail")(
    lambda t: t.weekly_staged.detail
)
query(
    "waterfall_totals",
    "SELECT 26 AS ru_computed_week, "
    + ", ".join(f"ROUND(SUM({c}), 6) AS {c}" for c in waterfall.MEASURES)
    + " FROM d_detail",
)(lambda t: t.weekly_staged.totals)
query(
    "waterfall_output",
    f"""SELECT d.{DETAIL_KEYS.replace(', ', ', d.')}, sales, ru_sales, nat_sales, unmapped_sales, {LOSSES},
        k.product_id_key, c.destination_pincode_key, p.preferred_fc
        FROM d_detail d LEFT JOIN (SELECT DISTINCT fsn, product_id_key FROM a_sales) k ON k.fsn = d.fsn
        LEFT JOIN (SELECT DISTINCT dest_pincode, destination_pincode_key FROM a_sales) c ON c.dest_pincode = d.dest_pincode
        LEFT JOIN a_preferred p ON p.dest_pincode = d.dest_pincode""",
)(lambda t: t.weekly_staged.output)



def _key(day):
    return F.date_format(day, "yyyyMMdd").cast("int")


def job_inputs(t) -> WeeklyInputs:
    """The adapter's tables as the files of the job have them: whole sales, dates as numbers."""
    place = {"dest_pincode": "destination_pincode"}
    return replace(
        t.inputs,
        sales_raw=t.sales_raw.withColumnsRenamed(place),
        explain=t.explain.withColumnsRenamed(place).withColumn("day", _key("day")),
        vendor_adherence=t.purchase_orders.withColumn("poi_created_day", _key("poi_created_day")),
        history=None,
    )


@query("weekly_job", f"SELECT {DETAIL_KEYS}, {DETAIL_MEASURES} FROM d_detail")
def _weekly_job(t):
    """The tables written as files, the job over them, its detail read back."""
    folder = new_path(t.spark, "weekly_job")
    export_weekly(job_inputs(t), f"{folder}/in")
    options = WeeklyOptions(sales_by="day", explain_by_week=False, reco_keys=("fsn", "fc"))
    run_weekly(t.spark, f"{folder}/in", f"{folder}/out", PERIOD, options, f"{folder}/work")
    written = t.spark.read.parquet(f"{folder}/out/{DETAIL}").drop("ru_week")
    kinds = {"fsn": "bigint", "dest_pincode": dict(t.sales_raw.dtypes)["dest_pincode"]}
    return written.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in written.columns])


SHARE_COLUMNS = [*PLACEMENT_LOSSES, "placement_loss"]
query(
    "loss_share_pct",
    "SELECT SUM(sales) AS sales, "
    + ", ".join(
        f"SUM({c}) AS {c}, ROUND(SUM({c}) / SUM(sales) * 100, {5 if c == 'exclusion_loss' else 2}) AS {c}_pct"
        for c in SHARE_COLUMNS
    )
    + " FROM d_placement",
)(lambda t: placement.loss_share_pct(t.weekly_staged.placement))

query(
    "reconcile",
    """SELECT national, blocked, unblocked, blocked AS placement_loss, fe_loss, pool,
         ROUND(allocated, 6) AS allocated, ROUND(cascaded, 6) AS cascaded, ROUND(explained, 6) AS explained,
         ROUND(blocked + unblocked - national, 6) + 0.0 AS blocked_gap, ROUND(fe_loss + pool - unblocked, 6) + 0.0 AS fe_gap,
         ROUND(allocated - pool, 6) + 0.0 AS allocation_gap, ROUND(cascaded - allocated, 6) + 0.0 AS cascade_gap,
         ROUND(explained - national, 6) + 0.0 AS explained_gap
       FROM (SELECT SUM(nat_sales) AS national FROM d_placement) a,
            (SELECT SUM(nat_sales) AS blocked FROM d_blocked) b,
            (SELECT SUM(nat_sales) AS unblocked FROM d_unblocked) u,
            (SELECT CAST(SUM(fe_loss) AS DOUBLE) AS fe_loss, SUM(fsn_dp_loss) AS pool FROM d_pool) p,
            (SELECT SUM(fsn_dp_fc_loss) AS allocated, SUM(forecast_loss + ndoh_loss + ipc_override_loss
                    + cdo_override_loss + po_loss + vendor_adherence_loss + residual) AS cascaded FROM d_cascade) c,
            (SELECT SUM(serviceability_loss + vendor_loss + low_sale_depth_loss + exclusion_loss + fe_loss
                    + forecast_loss + ndoh_loss + ipc_override_loss + cdo_override_loss + po_loss
                    + vendor_adherence_loss + promotions_loss + residual) AS explained FROM d_detail) d""",
)(lambda t: t.weekly_staged.checks)

query(
    "allocation_gap",
    f"""SELECT {PAIR}, {rounded(['ratio_sum'])}, unmatched_nat_sales, unmatched_rows, {rounded(['fsn_dp_loss', 'allocated', 'gap'])}
        FROM (SELECT m.*, COALESCE(p.fsn_dp_loss, 0) AS fsn_dp_loss,
                     COALESCE(ratio_sum, 0) * COALESCE(p.fsn_dp_loss, 0) AS allocated,
                     COALESCE(p.fsn_dp_loss, 0) - COALESCE(ratio_sum, 0) * COALESCE(p.fsn_dp_loss, 0) AS gap
              FROM (SELECT COALESCE(r.fsn, u.fsn) AS fsn, COALESCE(r.dest_pincode, u.dest_pincode) AS dest_pincode,
                           SUM(ratio) AS ratio_sum,
                           CAST(SUM(CASE WHEN ratio IS NULL THEN nat_sales ELSE 0 END) AS DOUBLE) AS unmatched_nat_sales,
                           CAST(SUM(CASE WHEN ratio IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_rows
                    FROM d_ratio r FULL JOIN d_unblocked u
                      ON u.fsn = r.fsn AND u.dest_pincode = r.dest_pincode AND u.fc = r.fc
                    GROUP BY 1, 2) m
              LEFT JOIN d_pool p ON p.fsn = m.fsn AND p.dest_pincode = m.dest_pincode) x
        WHERE ROUND(gap, 6) > 0 OR unmatched_rows > 0""",
)(
    lambda t: quality.allocation_gap_of_sets(
        t.weekly_staged.centre_sets,
        t.weekly_staged.near_centres,
        t.weekly_staged.pool,
        t.weekly_staged.unblocked,
    )
)

query(
    "exclusion_after_fe",
    """SELECT fsn, dest_pincode, nat_sales, CAST(fe AS DOUBLE) AS fe_loss,
         CASE WHEN is_excluded = 1 THEN nat_sales - fe ELSE 0 END AS exclusion_loss,
         CASE WHEN is_excluded = 1 THEN 0 ELSE nat_sales - fe END AS fsn_dp_loss
       FROM (SELECT p.fsn, p.dest_pincode, p.nat_sales, p.is_excluded, COALESCE(i.fe_issue, 0) AS fe
             FROM d_placement p LEFT JOIN d_fe_issue i ON i.fsn = p.fsn AND i.dest_pincode = p.dest_pincode
             WHERE p.serviceability_loss + p.vendor_loss + p.low_sale_depth_loss = 0) x""",
)(
    lambda t: allocate.exclusion_after_fe(
        t.weekly_staged.placement.where("serviceability_loss + vendor_loss + low_sale_depth_loss = 0"),
        t.weekly_staged.fe_issue,
        t.weekly_staged.exclusions,
    )
)

query(
    "preferred_coverage",
    """SELECT SUM(sales) AS sales, COALESCE(SUM(CASE WHEN known THEN sales END), 0) AS covered_sales,
         COALESCE(SUM(CASE WHEN NOT known THEN sales END), 0.0) AS uncovered_sales,
         COUNT(sales) AS sold_destinations, CAST(SUM(CASE WHEN known THEN 1 ELSE 0 END) AS BIGINT) AS preferred_destinations
       FROM (SELECT s.sales, p.dest_pincode IS NOT NULL AS known
             FROM (SELECT dest_pincode, SUM(sales) AS sales FROM d_fsn_dp GROUP BY dest_pincode) s
             FULL JOIN g_pref p ON p.dest_pincode = s.dest_pincode) x""",
)(lambda t: quality.preferred_coverage(t.weekly.sales_fsn_dp, t.preferred_wh))


@query(
    "waterfall_options",
    f"""SELECT {PAIR}, {rounded(['promotions_loss', 'residual'])} FROM (
        SELECT h.fsn, h.dest_pincode, LEAST(l.residual, COALESCE(o.offer_sales, 0)) AS promotions_loss,
               l.residual - LEAST(l.residual, COALESCE(o.offer_sales, 0)) AS residual
        FROM d_hierarchy h LEFT JOIN d_losses l ON l.fsn = h.fsn AND l.dest_pincode = h.dest_pincode
        LEFT JOIN a_offer o ON o.fsn = h.fsn AND o.dest_pincode = h.dest_pincode) x""",
)
def _options(t):
    """The run with the alternative promotion rule and literal fan-outs."""
    options = WeeklyOptions(
        sales_by="day", explain_by_week=False, reco_keys=("fsn", "fc"),
        promotions="capped", strict_fanout=True,
    )
    run = WeeklyRun(t.staged().inputs, PERIOD, options, stage)
    return run.detail.select("fsn", "dest_pincode", "promotions_loss", "residual")
