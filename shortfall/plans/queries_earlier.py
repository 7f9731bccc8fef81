"""Queries of the earlier run."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortfall.operators import legacy, matrix
from shortfall.plans.registry import query, rounded

PAIR = "fsn, dest_pincode"
PLACED = rounded(legacy.PLACED_LOSSES)

query("star_explain", "SELECT * FROM g_explain")(lambda t: t.explain_extract)
query("low_sale_sql", "SELECT * FROM g_low_sale")(lambda t: t.low_sale)
query("po_raised", "SELECT * FROM g_raised")(lambda t: t.po_raised)
query(
    "po_receipts",
    """SELECT "FC", CAST(strftime(updated, '%Y%m%d') AS INTEGER) AS poi_updated_date_key,
       CAST(strftime(placed, '%Y%m%d') AS INTEGER) AS poi_initiated_date_key, fsn, poi_status,
       SUM(ordered) AS poi_ordered_quantity, SUM(received) AS poi_received_quantity FROM g_po_line GROUP BY ALL""",
)(lambda t: t.po_receipts)
query("offer_units", "SELECT * FROM g_offer")(lambda t: t.offer_units)
query("fc_available_flag", "SELECT * FROM g_available")(lambda t: t.earlier.availability)
query("unpivot_lanes", "SELECT * FROM g_lanes")(lambda t: matrix.lane_unpivot(t.lane_wide))
query(
    "unpivot_flags",
    """SELECT 'tax' AS kind, CAST("FSN" AS VARCHAR) AS brand, '' AS vertical, '' AS category, "FC", tax_flg AS flag FROM g_tax
       UNION ALL SELECT 'vendor', brand, "Vertical", "Category", "FC", vendor_flag FROM g_vendor
       UNION ALL SELECT 'u2s', brand, vertical, category, "FC", u2s_flag FROM g_u2s""",
)(
    lambda t: matrix.tax_unpivot(t.tax_wide, t.sales_g1)
    .selectExpr(
        "'tax' AS kind", "CAST(FSN AS STRING) AS brand", "'' AS vertical", "'' AS category",
        "FC", "tax_flg AS flag",
    )
    .unionByName(
        matrix.vendor_unpivot(t.vendor_wide).selectExpr(
            "'vendor' AS kind", "brand", "Vertical AS vertical", "Category AS category",
            "FC", "vendor_flag AS flag",
        )
    )
    .unionByName(
        matrix.u2s_unpivot(t.u2s_wide).selectExpr(
            "'u2s' AS kind", "brand", "vertical", "category", "FC", "u2s_flag AS flag"
        )
    )
)
query("unpivot_leadtime", "SELECT * FROM g_lead_long")(
    lambda t: legacy.unpivot_leadtime(t.leadtime_wide)
)
query("placement_matrix", "SELECT * FROM g_matrix")(lambda t: t.earlier.matrix)
query("placement_ratio", f'SELECT {PAIR}, "FC", {rounded(["ratio"])} FROM g_ratio')(
    lambda t: t.earlier.ratio
)
query("placement_loss_class", "SELECT * FROM g_class")(lambda t: t.earlier.loss_class)
query("blocked_losses_g1", "SELECT * FROM g_blocked")(lambda t: t.earlier.blocked)
query("fe_issue_tiered", "SELECT * FROM g_ff_issue")(lambda t: t.earlier.ff_issue)
query(
    "ff_allocation",
    f"""SELECT {PAIR}, "FC", ru_loss, ff_loss, loss_at_dp_fsn_lvl,
        {rounded(['ratio', 'loss_post_ratio', 'ff_loss_post_ratio'])} FROM g_allocated""",
)(lambda t: t.earlier.allocated)
query(
    "policy_lead_time_floor",
    'SELECT fsn, "FC", category, policy_lead_time, CAST(reco_date AS VARCHAR) AS reco_date, reco_week FROM g_lead',
)(lambda t: t.earlier.lead_time)
query(
    "reco_agg_g1",
    f"""SELECT fsn, "FC", reco_week, total_qty_recomended, {rounded(['total_forecast_qty'])}, projected_qty FROM g_reco""",
)(lambda t: t.earlier.reco)
query("forecast_diff_g1", f'SELECT fsn, "FC", {rounded(["forecast_diff"])} FROM g_forecast')(
    lambda t: t.earlier.forecast_diff
)
query("national_doh", "SELECT * FROM g_doh")(lambda t: t.earlier.national_doh)
query("po_adherence", "SELECT * FROM g_adherence")(lambda t: t.earlier.po_adherence)
query("po_leadtime_window", "SELECT * FROM g_window")(lambda t: t.earlier.po_window)
query(
    "cascade_g1",
    f"""SELECT {PAIR}, "FC", {rounded(['loss_post_ratio', 'forecast_error', 'ndoh_loss', 'exclusion_loss',
        'adherence_loss', 'lead_time_loss', 'promotions_loss', 'residual'])}
        FROM (SELECT *, pool AS loss_post_ratio FROM g_cascade) x""",
)(
    lambda t: t.earlier_staged.cascaded.select(
        "fsn", "dest_pincode", "FC", "loss_post_ratio", "forecast_error", "ndoh_loss",
        "exclusion_loss", "adherence_loss", "lead_time_loss", "promotions_loss", "residual",
    )
)

WATERFALL = f"""{PAIR}, sales, ru_sales, nat_sales, bu, super_category, category, sub_category, vertical, brand,
    {rounded([*legacy.BLOCKED_LOSSES, 'low_sale_depth_loss', *legacy.PLACED_LOSSES, 'residual'])}"""
query("waterfall_g1", f"SELECT {WATERFALL} FROM g_waterfall")(lambda t: t.earlier_staged.waterfall)
query(
    "low_sale_override",
    f"""SELECT {PAIR}, {rounded(['low_sale_depth_loss', 'vendor_loss', 'ndoh_loss', 'residual'])}
        FROM g_waterfall WHERE low_sale_depth_loss > 0""",
)(
    lambda t: t.earlier_staged.waterfall.where("low_sale_depth_loss > 0").select(
        "fsn", "dest_pincode", "low_sale_depth_loss", "vendor_loss", "ndoh_loss", "residual"
    )
)
BU = [c for c in legacy.BU_MEASURES if c != "tax_loss"]
query(
    "waterfall_by_bu",
    "SELECT bu, "
    + ", ".join(f"ROUND(CAST(SUM({c}) AS DOUBLE), 6) AS {c}" for c in BU)
    + " FROM g_waterfall GROUP BY bu",
)(lambda t: legacy.waterfall_by_bu(t.earlier_staged.waterfall))
query(
    "bu_share_pct",
    "SELECT bu, "
    + ", ".join(
        f"ROUND(CAST(SUM({c}) AS DOUBLE) * 100 / (SUM(ru_sales) + SUM(nat_sales)), 2) AS {c}_pct" for c in BU
    )
    + " FROM g_waterfall GROUP BY bu",
)(lambda t: legacy.bu_share_pct(legacy.waterfall_by_bu(t.earlier_staged.waterfall)))
query(
    "enrich_output",
    f"""SELECT w.fsn, w.dest_pincode, nat_sales, {rounded(['residual'])}, p.p_name AS title, r.r_name AS "Zone",
        f.preferred_wh AS "LZ-FC"
        FROM g_waterfall w LEFT JOIN part p ON p.p_partkey = w.fsn
        LEFT JOIN nation n ON n.n_nationkey = w.dest_pincode LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
        LEFT JOIN g_pref f ON f.dest_pincode = w.dest_pincode""",
)(
    lambda t: legacy.enrich_output(t.earlier_staged.waterfall, t.titles, t.zones, t.lane_fcs).select(
        "fsn", "dest_pincode", "nat_sales", "residual", "title", "Zone", "LZ-FC"
    )
)
query(
    "pe_excess_inventory",
    """SELECT s.fsn, s.fc, SUM(LEAST(GREATEST(COALESCE(i.inventory, 0) - s.ru_sales, 0), s.nat_sales)) AS pe_excess_inv
       FROM (SELECT fsn, fc, day, SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales FROM a_sales GROUP BY ALL) s
       LEFT JOIN (SELECT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc, CAST(l_shipdate AS DATE) AS day,
                         SUM(l_quantity * 2 - 40) AS inventory
                  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL) i
         ON i.fsn = s.fsn AND i.fc = s.fc AND i.day = s.day
       GROUP BY s.fsn, s.fc""",
)(lambda t: legacy.pe_excess_inventory(t.sales, t.inventory))
query(
    "po_lead_days",
    """SELECT fsn, "FC", SUM(CAST(strftime(updated, '%Y%m%d') AS BIGINT) - CAST(strftime(placed, '%Y%m%d') AS BIGINT))::BIGINT
       AS key_difference FROM g_po_line GROUP BY ALL""",
)(
    lambda t: t.po_lines.where(F.col("po_created_date_key") >= 19970101)
    .groupBy("fsn", F.col("po_oroginal_warehouse_id").alias("FC"))
    .agg(F.sum(F.col("poi_updated_date_key") - F.col("poi_initiated_date_key")).alias("key_difference"))
)
