"""The earlier run in plain SQL, added to the views of the weekly run."""

from __future__ import annotations

from shortfall.plans.views import VIEWS

NATIONS = range(25)


def _columns(template: str) -> str:
    return ", ".join(template.format(k=k) for k in NATIONS)


EARLIER_VIEWS: dict[str, str] = {
    **VIEWS,
    "g_sales": """
        SELECT fsn, dest_pincode, day, 'FC' || source_pincode AS source_id, brand, bu, category, super_category,
               category AS sub_category, vertical, sales, ru_sales, sales - ru_sales AS nat_sales FROM a_sales""",
    "g_fsn_dp": """
        SELECT fsn, dest_pincode, SUM(sales) AS sales, SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales
        FROM g_sales GROUP BY fsn, dest_pincode""",
    "g_lane_wide": "SELECT dest_pincode AS \"Destination_Pincode\", "
    "COALESCE(MAX(CASE WHEN lzn_value = 'L1' THEN 'FC' || src_pincode END), '') AS \"L1_0\", "
    + ", ".join(
        f"COALESCE(MAX(CASE WHEN lzn_value = 'Z1' AND src_pincode // 5 = {k} THEN 'FC' || src_pincode END), '0') AS \"Z1_{k}\""
        for k in range(5)
    )
    + ", COALESCE(MAX(CASE WHEN lzn_value = 'N1' THEN 'FC' || src_pincode END), '') AS \"N1_0\" "
    "FROM a_lane GROUP BY dest_pincode",
    "g_slots": " UNION ALL ".join(
        f"SELECT \"Destination_Pincode\", '{s}' AS lzn, \"{s}\" AS \"FC\" FROM g_lane_wide"
        for s in ["L1_0", "Z1_0", "Z1_1", "Z1_2", "Z1_3", "Z1_4"]
    ),
    "g_lanes": "SELECT * FROM g_slots WHERE \"FC\" NOT IN ('', '0')",
    "g_available": """
        SELECT "Destination_Pincode", SUM(CASE WHEN "FC" IN ('', '0') THEN 1 ELSE 0 END)::INTEGER AS blank_slots,
               CASE WHEN SUM(CASE WHEN "FC" IN ('', '0') THEN 1 ELSE 0 END) = 6 THEN 0 ELSE 1 END AS fc_available_flag
        FROM g_slots GROUP BY "Destination_Pincode" """,
    "g_tax_wide": "SELECT p_partkey AS \"FSN\", "
    + _columns('CASE WHEN p_size > 10 AND (p_partkey + {k}) % 4 = 0 THEN 0 ELSE 1 END AS "FC{k}"')
    + " FROM part",
    "g_tax": """
        SELECT p_partkey AS "FSN", 'FC' || k AS "FC", 0 AS tax_flg FROM part, range(25) t(k)
        WHERE p_size > 10 AND (p_partkey + k) % 4 = 0 AND p_partkey IN (SELECT fsn FROM g_sales)""",
    "g_lines": """
        SELECT l.*, p.*, s.s_nationkey AS src_nation, s.s_acctbal FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
    "g_u2s": """
        SELECT w.brand, w.vertical, w.category AS super_category, w.category, 'FC' || k AS "FC",
               CASE WHEN EXISTS (SELECT 1 FROM (SELECT DISTINCT p_brand, p_name, p_type, src_nation FROM g_lines) g
                    WHERE g.p_brand = w.brand AND g.p_name = w.vertical AND g.p_type = w.category AND g.src_nation = k)
                    THEN 1 ELSE 0 END AS u2s_flag
        FROM (SELECT DISTINCT p_brand AS brand, p_name AS vertical, p_type AS category FROM g_lines) w, range(25) t(k)""",
    "g_vendor": """
        SELECT upper(w.brand) AS brand, w.vertical AS "Vertical", w.category AS "Category", 'FC' || k AS "FC",
               CASE WHEN EXISTS (SELECT 1 FROM (SELECT DISTINCT p_brand, p_name, p_type, src_nation FROM g_lines
                                                WHERE l_returnflag = 'R') g
                    WHERE g.p_brand = w.brand AND g.p_name = w.vertical AND g.p_type = w.category AND g.src_nation = k)
                    THEN 1 ELSE 0 END AS vendor_flag
        FROM (SELECT DISTINCT p_brand AS brand, p_name AS vertical, p_type AS category FROM g_lines) w, range(25) t(k)""",
    "g_pairs": "SELECT DISTINCT fsn, dest_pincode, brand, bu, category, vertical FROM g_sales",
    "g_matrix_flags": """
        SELECT p.*, z."FC", z.lzn, CAST(COALESCE(t.tax_flg, 1) AS DOUBLE) AS tax_flg,
               CAST(COALESCE(u.u2s_flag, 1) AS DOUBLE) AS u2s_flag,
               CAST(COALESCE(v.vendor_flag, 1) AS DOUBLE) AS vendor_flag
        FROM g_pairs p JOIN g_lanes z ON z."Destination_Pincode" = p.dest_pincode
        LEFT JOIN g_tax t ON t."FSN" = p.fsn AND t."FC" = z."FC"
        LEFT JOIN (SELECT brand, vertical, "FC", MAX(u2s_flag) AS u2s_flag FROM g_u2s GROUP BY ALL) u
          ON u.brand = p.brand AND u.vertical = p.vertical AND u."FC" = z."FC"
        LEFT JOIN (SELECT brand, "Vertical", "FC", MAX(vendor_flag) AS vendor_flag FROM g_vendor GROUP BY ALL) v
          ON v.brand = upper(p.brand) AND v."Vertical" = p.vertical AND v."FC" = z."FC" """,
    "g_matrix": """
        SELECT *, CASE WHEN tax_flg <> 0 AND u2s_flag <> 0 AND vendor_flag <> 0 THEN 1 ELSE 0 END AS placement_flag
        FROM g_matrix_flags""",
    "g_open": 'SELECT DISTINCT fsn, dest_pincode, "FC" FROM g_matrix WHERE placement_flag = 1',
    "g_ratio": """
        SELECT fsn, dest_pincode, "FC", 1.0 / COUNT(*) OVER (PARTITION BY fsn, dest_pincode) AS ratio FROM g_open""",
    "g_class": """
        SELECT fsn, dest_pincode, CASE
                 WHEN MAX(CASE WHEN tax_flg = 1 AND u2s_flag = 1 AND vendor_flag = 0 THEN 1 ELSE 0 END) = 1 THEN 'vendor'
                 WHEN MAX(CASE WHEN tax_flg = 1 AND u2s_flag = 0 THEN 1 ELSE 0 END) = 1 THEN 'u2s' ELSE 'tax' END AS loss
        FROM g_matrix GROUP BY fsn, dest_pincode HAVING MAX(placement_flag) = 0""",
    "g_blocked": """
        SELECT s.*, CASE WHEN a.fc_available_flag = 0 THEN s.nat_sales ELSE 0 END AS servicibility_loss,
               CASE WHEN c.loss = 'tax' THEN s.nat_sales ELSE 0 END AS tax_loss,
               CASE WHEN c.loss = 'vendor' THEN s.nat_sales ELSE 0 END AS vendor_loss,
               CASE WHEN c.loss = 'u2s' THEN s.nat_sales ELSE 0 END AS u2s_loss
        FROM g_fsn_dp s LEFT JOIN g_available a ON a."Destination_Pincode" = s.dest_pincode
        LEFT JOIN g_class c ON c.fsn = s.fsn AND c.dest_pincode = s.dest_pincode
        WHERE a.fc_available_flag = 0 OR c.loss IS NOT NULL""",
    "g_star": """
        SELECT l.l_orderkey AS fiu_id, s.s_nationkey AS src_nation, 'T' || (l.l_linenumber % 3) AS lpe_tier,
               l.l_quantity, l.l_linestatus, c.c_nationkey AS dest_pincode, l.l_partkey AS fsn
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
        WHERE o.o_orderstatus <> 'P' AND s.s_acctbal >= 0 AND p.p_size <= 25
          AND CAST(l.l_shipdate AS DATE) BETWEEN DATE '1997-06-29' AND DATE '1998-06-27'""",
    "g_explain": """
        SELECT fiu_id, 'FC' || src_nation AS source_id, lpe_tier, l_quantity - 10 AS effective_inventory,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS accepted, dest_pincode, fsn FROM g_star
        UNION ALL
        SELECT fiu_id, 'FC' || ((src_nation + 5) % 25), lpe_tier, l_quantity - 25, 0, dest_pincode, fsn FROM g_star""",
    "g_lane_static": """
        SELECT src_pincode, dest_pincode, MIN(lzn_value) AS lzn FROM a_lane WHERE lzn_value <> '' GROUP BY ALL""",
    "g_ff_issue": """
        SELECT e.fsn, e.dest_pincode, COUNT(DISTINCT e.fiu_id) AS fe_issue
        FROM g_explain e JOIN g_lane_static z ON 'FC' || z.src_pincode = e.source_id AND z.dest_pincode = e.dest_pincode
        WHERE z.lzn IN ('L1', 'L2', 'Z1', 'Z2') AND e.effective_inventory > 0
          AND e.lpe_tier = 'T' || ((z.src_pincode + z.dest_pincode) % 3)
          AND e.fiu_id IN (SELECT n.fiu_id FROM g_explain n JOIN g_lane_static y
                ON 'FC' || y.src_pincode = n.source_id AND y.dest_pincode = n.dest_pincode
                WHERE y.lzn IN ('N1', 'N2') AND n.accepted = 1)
        GROUP BY e.fsn, e.dest_pincode""",
    "g_pool": """
        SELECT s.fsn, s.dest_pincode, s.nat_sales AS ru_loss, CAST(COALESCE(i.fe_issue, 0) AS DOUBLE) AS ff_loss
        FROM g_fsn_dp s LEFT JOIN g_ff_issue i ON i.fsn = s.fsn AND i.dest_pincode = s.dest_pincode
        WHERE NOT EXISTS (SELECT 1 FROM g_blocked b WHERE b.fsn = s.fsn AND b.dest_pincode = s.dest_pincode)""",
    "g_allocated": """
        SELECT r.*, p.ru_loss, p.ff_loss, p.ru_loss - p.ff_loss AS loss_at_dp_fsn_lvl,
               r.ratio * (p.ru_loss - p.ff_loss) AS loss_post_ratio, r.ratio * p.ff_loss AS ff_loss_post_ratio
        FROM g_ratio r LEFT JOIN g_pool p ON p.fsn = r.fsn AND p.dest_pincode = r.dest_pincode""",
    "g_lead_known": """
        SELECT l_partkey AS fsn, s_nationkey AS k, MAX((l_partkey * 7 + l_suppkey * 3) % 63) AS days
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""",
    "g_lead_long": """
        SELECT f.fsn, 'FC' || t.k AS "FC", CAST(g.days AS DOUBLE) AS policy_lead_time
        FROM (SELECT DISTINCT fsn FROM g_lead_known) f CROSS JOIN range(25) t(k)
        LEFT JOIN g_lead_known g ON g.fsn = f.fsn AND g.k = t.k""",
    "g_lead_days": """
        SELECT l.fsn, l."FC", p.category, CAST(CASE WHEN l.policy_lead_time IS NULL THEN 7
               WHEN l.policy_lead_time = 0 THEN c.cat_lead_time ELSE l.policy_lead_time END AS DOUBLE) AS policy_lead_time
        FROM g_lead_long l LEFT JOIN d_products p ON p.fsn = l.fsn LEFT JOIN a_cat_lead c ON c.category = p.category""",
    "g_lead_date": """
        SELECT *, DATE '1997-06-29' - CAST(policy_lead_time AS INTEGER)
               - CAST(dayofweek(DATE '1997-06-29' - CAST(policy_lead_time AS INTEGER)) AS INTEGER) AS reco_date
        FROM g_lead_days""",
    "g_lead": """
        SELECT fsn, "FC", category, policy_lead_time, CAST(reco_date AS DATE) AS reco_date,
               CAST((dayofyear(reco_date) - 1) // 7 + 1 AS INTEGER) AS reco_week FROM g_lead_date""",
    "g_plan": """
        SELECT l_partkey AS fsn, 'FC' || s_nationkey AS "FC", CAST((dayofyear(l_shipdate) - 1) // 7 + 1 AS INTEGER) AS reco_week,
               l_quantity % 9 AS w1, l_quantity % 8 AS w2, l_quantity % 7 AS w3, l_quantity % 6 AS w4,
               l_quantity - l_quantity % 5 AS recommended, l_quantity AS generated
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "g_reco": """
        SELECT l.fsn, l."FC", l.reco_week, SUM(recommended) AS total_qty_recomended,
               SUM(CASE CAST(CEIL(policy_lead_time / 7) AS INTEGER) WHEN 1 THEN w1 WHEN 2 THEN w2 WHEN 3 THEN w3
                   WHEN 4 THEN w4 WHEN NULL THEN NULL ELSE (w1 + w2 + w3 + w4) / 4 END) AS total_forecast_qty,
               SUM(generated) AS projected_qty
        FROM g_lead l JOIN g_plan p ON p.fsn = l.fsn AND p."FC" = l."FC" AND p.reco_week = l.reco_week
        GROUP BY l.fsn, l."FC", l.reco_week""",
    "g_pref": """
        SELECT dest_pincode, MIN('FC' || src_pincode) AS preferred_wh FROM a_lane
        WHERE lzn_value IN ('L1', 'Z1') GROUP BY dest_pincode""",
    "g_forecast": """
        SELECT s.fsn, s.preferred_wh AS "FC", GREATEST(s.sales - COALESCE(r.f, 0), 0) AS forecast_diff
        FROM (SELECT d.fsn, p.preferred_wh, SUM(d.sales) AS sales FROM g_pref p
              JOIN g_fsn_dp d ON d.dest_pincode = p.dest_pincode GROUP BY ALL) s
        LEFT JOIN (SELECT fsn, "FC", SUM(total_forecast_qty) AS f FROM g_reco GROUP BY ALL) r
          ON r.fsn = s.fsn AND r."FC" = s.preferred_wh""",
    "g_doh": """
        SELECT fsn, "FC", SUM(GREATEST(projected_qty - total_qty_recomended, 0)) AS national_doh FROM g_reco GROUP BY ALL""",
    "g_raised": """
        SELECT l_partkey AS fsn, 'FC' || (o_custkey % 25) AS "FC",
               CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS INTEGER) AS weeknum,
               SUM(l_quantity - FLOOR(l_quantity * l_discount)) AS total_po_raised_qty
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderdate >= DATE '1997-01-01' AND o_orderstatus <> 'P' GROUP BY ALL""",
    "g_adherence": """
        SELECT r.fsn, r."FC", COALESCE(SUM(p.total_po_raised_qty), 0) AS total_po_raised_qty,
               SUM(r.total_qty_recomended) AS final_qty_recommended
        FROM g_reco r LEFT JOIN g_raised p ON p.fsn = r.fsn AND p."FC" = r."FC" AND p.weeknum = r.reco_week
        GROUP BY r.fsn, r."FC" """,
    "g_po_line": """
        SELECT 'FC' || s_nationkey AS "FC", CAST(l_shipdate AS DATE) AS updated, CAST(o_orderdate AS DATE) AS placed,
               l_partkey AS fsn,
               CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'completed' ELSE 'cancelled' END AS poi_status,
               l_quantity AS ordered, l_quantity - FLOOR(l_quantity * l_discount) AS received
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
        WHERE o_orderdate >= DATE '1997-01-01'""",
    "g_window": """
        SELECT p.fsn, p."FC", SUM(p.received) AS po_received_quantity, SUM(p.ordered) AS po_ordered_quantity
        FROM g_po_line p LEFT JOIN g_lead l ON l.fsn = p.fsn AND l."FC" = p."FC"
        WHERE COALESCE(l.policy_lead_time, 7) <= date_diff('day', p.placed, DATE '1998-06-27')
          AND ((p.poi_status = 'approved'
                AND COALESCE(l.policy_lead_time, 7) >= date_diff('day', p.placed, DATE '1997-04-20'))
            OR (p.poi_status = 'completed'
                AND COALESCE(l.policy_lead_time, 7) >= date_diff('day', p.placed, DATE '1997-06-29')))
        GROUP BY p.fsn, p."FC" """,
    "g_offer": """
        SELECT l_partkey AS fsn, SUM(l_quantity) AS offer_sales FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        WHERE l_discount >= 0.08 AND s_acctbal >= 0
          AND CAST(l_shipdate AS DATE) BETWEEN DATE '1997-06-29' AND DATE '1998-06-27' GROUP BY l_partkey""",
    "g_low_sale": """
        SELECT s.*, m.min_sales_depth FROM (
          SELECT p_partkey AS fsn, p_name AS vertical, p_type AS sub_category, p_type AS category, p_type AS super_category,
                 CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS bu, p_name AS product_title, p_brand AS brand,
                 COUNT(DISTINCT l_orderkey * 10 + l_linenumber) AS sales
          FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
          WHERE l_returnflag <> 'R' AND s_acctbal >= 0 AND CAST(l_shipdate AS DATE) > DATE '1998-05-30'
            AND CAST(l_shipdate AS DATE) <= DATE '1998-06-27'
          GROUP BY ALL HAVING COUNT(DISTINCT l_orderkey * 10 + l_linenumber) < 30) s
        JOIN a_min_sales m ON m.category = s.category WHERE s.sales < m.min_sales_depth""",
    "g_issues": """
        SELECT a.fsn, a.dest_pincode, a."FC", COALESCE(a.loss_post_ratio, 0) AS pool,
               COALESCE(a.ff_loss_post_ratio, 0) AS ff, COALESCE(f.forecast_diff, 0) AS i1,
               COALESCE(d.national_doh, 0) AS i2, CASE WHEN e.fsn IS NULL THEN 0 ELSE 1 END AS excluded,
               GREATEST(COALESCE(h.final_qty_recommended, 0) - COALESCE(h.total_po_raised_qty, 0), 0) AS i4,
               GREATEST(COALESCE(w.po_ordered_quantity, 0) - COALESCE(w.po_received_quantity, 0), 0) AS i5,
               COALESCE(o.offer_sales, 0) AS i6
        FROM g_allocated a LEFT JOIN a_exclusion e ON e.fsn = a.fsn LEFT JOIN g_offer o ON o.fsn = a.fsn
        LEFT JOIN g_window w ON w.fsn = a.fsn AND w."FC" = a."FC"
        LEFT JOIN g_adherence h ON h.fsn = a.fsn AND h."FC" = a."FC"
        LEFT JOIN g_doh d ON d.fsn = a.fsn AND d."FC" = a."FC"
        LEFT JOIN g_forecast f ON f.fsn = a.fsn AND f."FC" = a."FC" """,
    "g_step1": "SELECT *, LEAST(pool, i1) AS forecast_error FROM g_issues",
    "g_step2": """
        SELECT *, LEAST(GREATEST(pool - forecast_error, 0), i2) AS ndoh_loss FROM g_step1""",
    "g_step3": """
        SELECT *, GREATEST(GREATEST(pool - forecast_error, 0) - ndoh_loss, 0) AS r2 FROM g_step2""",
    "g_step4": """
        SELECT *, CASE WHEN excluded = 1 THEN r2 ELSE 0 END AS exclusion_loss,
               CASE WHEN excluded = 1 THEN 0 ELSE r2 END AS r3 FROM g_step3""",
    "g_step5": "SELECT *, LEAST(r3, i4) AS adherence_loss, GREATEST(r3 - i4, 0) AS r4 FROM g_step4",
    "g_step6": "SELECT *, LEAST(r4, i5) AS lead_time_loss, GREATEST(r4 - i5, 0) AS r5 FROM g_step5",
    "g_cascade": "SELECT *, LEAST(r5, i6) AS promotions_loss, GREATEST(r5 - i6, 0) AS residual FROM g_step6",
    "g_placed": """
        SELECT fsn, dest_pincode, SUM(ndoh_loss) AS ndoh_loss, SUM(ff) AS ff_loss, SUM(exclusion_loss) AS exclusion_loss,
               SUM(adherence_loss) AS adherence_loss, SUM(lead_time_loss) AS lead_time_loss,
               SUM(forecast_error) AS forecast_error, SUM(promotions_loss) AS promotions_loss
        FROM g_cascade GROUP BY fsn, dest_pincode""",
    "g_joined": """
        SELECT s.*, p.bu, p.super_category, p.category, p.sub_category, p.vertical, p.brand,
               COALESCE(b.servicibility_loss, 0) AS servicibility_loss, COALESCE(b.tax_loss, 0) AS tax_loss,
               COALESCE(b.u2s_loss, 0) AS u2s_loss, COALESCE(b.vendor_loss, 0) AS v0, COALESCE(y.ndoh_loss, 0) AS n0,
               COALESCE(y.ff_loss, 0) AS f0, COALESCE(y.exclusion_loss, 0) AS e0, COALESCE(y.adherence_loss, 0) AS a0,
               COALESCE(y.lead_time_loss, 0) AS l0, COALESCE(y.forecast_error, 0) AS c0, COALESCE(y.promotions_loss, 0) AS p0,
               CASE WHEN s.fsn IN (SELECT fsn FROM g_low_sale)
                    THEN s.nat_sales - COALESCE(b.servicibility_loss, 0) - COALESCE(b.tax_loss, 0) - COALESCE(b.u2s_loss, 0)
                    ELSE 0 END AS low_sale_depth_loss
        FROM g_fsn_dp s
        JOIN (SELECT DISTINCT fsn, bu, super_category, category, sub_category, vertical, brand FROM g_sales) p ON p.fsn = s.fsn
        LEFT JOIN g_blocked b ON b.fsn = s.fsn AND b.dest_pincode = s.dest_pincode
        LEFT JOIN g_placed y ON y.fsn = s.fsn AND y.dest_pincode = s.dest_pincode""",
    "g_overridden": "SELECT * EXCLUDE (v0, n0, f0, e0, a0, l0, c0, p0), "
    + ", ".join(
        f"CASE WHEN low_sale_depth_loss > 0 THEN 0 ELSE {c} END AS {name}"
        for c, name in [
            ("v0", "vendor_loss"), ("n0", "ndoh_loss"), ("f0", "ff_loss"), ("e0", "exclusion_loss"),
            ("a0", "adherence_loss"), ("l0", "lead_time_loss"), ("c0", "forecast_error"), ("p0", "promotions_loss"),
        ]
    )
    + " FROM g_joined",
    "g_waterfall": """
        SELECT *, GREATEST(nat_sales - servicibility_loss - tax_loss - u2s_loss - vendor_loss - low_sale_depth_loss
               - ndoh_loss - ff_loss - adherence_loss - lead_time_loss - forecast_error - promotions_loss
               - exclusion_loss, 0) AS residual
        FROM g_overridden""",
}
