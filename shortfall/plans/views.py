"""The run in plain SQL, as named views the oracle queries are assembled from.

Written independently of the DataFrame code: each entry is one SELECT over the
base tables or earlier entries. ``with_views`` turns a final SELECT into one
statement with just the views it needs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    # --- star-schema tables as inputs of the run ---
    "a_lane": """
        SELECT CAST(s.s_suppkey AS VARCHAR) AS fc, s.s_suppkey AS fc_no, s.s_nationkey AS src_pincode,
               d.n_nationkey AS dest_pincode,
               CASE WHEN d.n_nationkey % 7 = 3 THEN 'N2' WHEN s.s_suppkey % 9 = 4 THEN ''
                    WHEN s.s_nationkey = d.n_nationkey THEN 'L1'
                    WHEN o.n_regionkey = d.n_regionkey THEN 'Z1' ELSE 'N1' END AS lzn_value
        FROM supplier s JOIN nation o ON s.s_nationkey = o.n_nationkey CROSS JOIN nation d""",
    "a_sales_raw": """
        SELECT CAST(l.l_shipdate AS DATE) AS day, l.l_orderkey AS fiu_id, l.l_partkey AS fsn,
               c.c_nationkey AS dest_pincode, a.src_pincode AS source_pincode, a.fc,
               p.p_brand AS brand, p.p_type AS category, p.p_type AS super_category, p.p_name AS vertical,
               CASE WHEN p.p_size <= 25 THEN 'Small' ELSE 'Large' END AS bu, l.l_quantity AS sales,
               CASE WHEN a.lzn_value IN ('L1', 'Z1') THEN l.l_quantity ELSE 0 END AS ru_sales,
               CASE WHEN a.lzn_value IN ('N1', 'N2') THEN l.l_quantity ELSE 0 END AS nat_sales,
               a.lzn_value, l.l_discount, l.l_linestatus,
               l.l_partkey + 1000000 AS product_id_key,
               CAST(c.c_nationkey + 1000 AS INTEGER) AS destination_pincode_key
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
        JOIN a_lane a ON a.fc_no = l.l_suppkey AND a.dest_pincode = c.c_nationkey""",
    "a_sales": """
        SELECT *, sales - ru_sales - nat_sales AS unmapped_sales FROM a_sales_raw
        WHERE day >= DATE '1997-06-29' AND day <= DATE '1998-06-27'""",
    "a_vendor_site": """
        SELECT DISTINCT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc, l_orderkey % 50 AS vsid
        FROM lineitem WHERE l_partkey % 5 <> 0""",
    "a_vendor_brand": """
        SELECT DISTINCT p_brand AS brand, p_name AS vertical, CAST(l_suppkey AS VARCHAR) AS fc, l_orderkey % 20 AS vsid
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 3 = 0""",
    "a_min_sales": "SELECT DISTINCT p_type AS category, 10 + length(p_type) AS min_sales_depth FROM part",
    "a_cat_lead": "SELECT DISTINCT p_type AS category, 2 * length(p_type) AS cat_lead_time FROM part",
    "a_lead_time": """
        SELECT DISTINCT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc,
               (l_partkey * 7 + l_suppkey * 3) % 63 AS lead_time FROM lineitem""",
    "a_exclusion": """
        SELECT p_partkey AS fsn, CASE WHEN p_partkey % 2 = 0 THEN DATE '1998-12-31' ELSE DATE '1996-01-01' END AS skip_upto
        FROM part WHERE p_size >= 46""",
    "a_planned": """
        SELECT l_partkey, l_suppkey, CAST(SUM(l_quantity) AS INTEGER) AS q FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "a_requirement": """
        SELECT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc, q AS system_qty, q - q % 3 AS max_doh_qty,
               q - q % 5 AS ipc_reviewed_qty, q - q % 7 AS cdo_reviewed_qty, q - q % 11 AS po_qty,
               q % 20 AS forecast_n, q % 19 AS forecast_n1, q % 18 AS forecast_n2, q % 17 AS forecast_n3,
               q % 16 AS forecast_n4, q % 15 AS forecast_n5, q % 14 AS forecast_n6, q % 13 AS forecast_n7
        FROM a_planned""",
    "a_preferred": """
        SELECT dest_pincode, CASE WHEN dest_pincode % 6 = 5 THEN CAST(MIN(fc_no) AS VARCHAR)
               ELSE CONCAT(CAST(MIN(fc_no) AS VARCHAR), ',', CAST(MAX(fc_no) AS VARCHAR)) END AS preferred_fc
        FROM a_lane GROUP BY dest_pincode""",
    "a_near_lane": """
        SELECT dest_pincode, MIN(lzn_value) AS lzn_value FROM a_lane WHERE lzn_value IN ('L1', 'Z1') GROUP BY dest_pincode""",
    "a_explain": """
        SELECT fiu_id, fsn, dest_pincode, day, lzn_value,
               CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END AS is_accepted, sales - 10 AS effective_inventory
        FROM a_sales
        UNION ALL
        SELECT s.fiu_id, s.fsn, s.dest_pincode, s.day, a.lzn_value, 'false', s.sales - 25
        FROM a_sales s JOIN a_near_lane a ON a.dest_pincode = s.dest_pincode
        WHERE s.lzn_value = 'N1' AND s.fiu_id % 4 = 0""",
    "a_vendor_adherence": """
        SELECT l_partkey AS fsn, CAST(l_suppkey AS VARCHAR) AS fc, CAST(o_orderdate AS DATE) AS poi_created_day,
               CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'completed' ELSE 'cancelled' END AS po_status,
               l_quantity AS poi_ordered_qty, l_quantity - FLOOR(l_quantity * l_discount) AS poi_received_qty
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "a_offer": """
        SELECT fsn, dest_pincode, SUM(sales) AS offer_sales FROM a_sales WHERE l_discount >= 0.08
        GROUP BY fsn, dest_pincode""",
    # --- cleaned inputs ---
    "d_lanes": """
        SELECT fc, src_pincode, dest_pincode, lzn_value FROM a_lane WHERE lzn_value NOT IN ('', '0', 'NULL')""",
    "d_lz": "SELECT * FROM d_lanes WHERE lzn_value IN ('L1', 'L2', 'Z1', 'Z2')",
    "d_fsn_dp": """
        SELECT fsn, dest_pincode, SUM(sales) AS sales, SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales
        FROM a_sales GROUP BY fsn, dest_pincode""",
    "d_fsn_dp_fc": """
        SELECT fsn, dest_pincode, fc, SUM(sales) AS sales, SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales
        FROM a_sales GROUP BY fsn, dest_pincode, fc""",
    "d_hierarchy": """
        SELECT fsn, bu, super_category, category, vertical, brand, dest_pincode, SUM(sales) AS sales,
               SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales
        FROM a_sales GROUP BY fsn, bu, super_category, category, vertical, brand, dest_pincode""",
    "d_pairs": "SELECT DISTINCT fsn, dest_pincode, brand, vertical FROM a_sales",
    "d_products": "SELECT DISTINCT fsn, category FROM a_sales",
    "d_vendor_fsn": """
        SELECT fsn, fc, COUNT(DISTINCT vsid) AS fsn_vendor_count FROM a_vendor_site GROUP BY fsn, fc""",
    "d_vendor_brand": """
        SELECT brand, vertical, fc, COUNT(DISTINCT vsid) AS brand_vendor_count FROM a_vendor_brand
        GROUP BY brand, vertical, fc""",
    # --- placement ---
    "d_serviceability": """
        SELECT dest_pincode, COUNT(DISTINCT CASE WHEN lzn_value IN ('L1', 'L2', 'Z1', 'Z2') THEN fc END) AS lz_fc_count,
               MAX(CASE WHEN lzn_value IN ('L1', 'L2', 'Z1', 'Z2') THEN 1 ELSE 0 END) AS is_serviceable
        FROM d_lanes GROUP BY dest_pincode""",
    "d_candidates": """
        SELECT p.fsn, p.dest_pincode, p.brand, p.vertical, z.fc, COALESCE(f.fsn_vendor_count, 0) AS fsn_vendor_count,
               COALESCE(b.brand_vendor_count, 0) AS brand_vendor_count,
               COALESCE(f.fsn_vendor_count, 0) + COALESCE(b.brand_vendor_count, 0) AS vendor_count
        FROM d_pairs p JOIN (SELECT DISTINCT dest_pincode, fc FROM d_lz) z ON p.dest_pincode = z.dest_pincode
        LEFT JOIN d_vendor_fsn f ON f.fsn = p.fsn AND f.fc = z.fc
        LEFT JOIN d_vendor_brand b ON b.brand = p.brand AND b.vertical = p.vertical AND b.fc = z.fc""",
    "d_vendor_avl": """
        SELECT fsn, dest_pincode, CAST(SUM(vendor_count) AS BIGINT) AS vendor_count,
               CASE WHEN SUM(vendor_count) = 0 THEN 0 ELSE 1 END AS is_vendor_avl
        FROM d_candidates GROUP BY fsn, dest_pincode""",
    "d_low_sales": """
        SELECT s.fsn, s.category, s.sales, COALESCE(m.min_sales_depth, 0) AS min_sales_depth
        FROM (SELECT l_partkey AS fsn, p_type AS category, SUM(l_quantity) AS sales
              FROM lineitem JOIN part ON l_partkey = p_partkey
              WHERE CAST(l_shipdate AS DATE) < DATE '1997-06-29' AND CAST(l_shipdate AS DATE) >= DATE '1997-06-01'
              GROUP BY l_partkey, p_type) s
        LEFT JOIN a_min_sales m ON m.category = s.category
        WHERE s.sales <= COALESCE(m.min_sales_depth, 0)""",
    "d_low_products": """
        SELECT DISTINCT l.fsn, 1 AS low_sale_flag FROM d_low_sales l WHERE l.fsn IN (SELECT fsn FROM d_fsn_dp)""",
    "d_exclusions": "SELECT DISTINCT fsn, 1 AS is_excluded FROM a_exclusion WHERE skip_upto >= DATE '1997-06-29'",
    "d_flags": """
        SELECT s.*, COALESCE(v.is_serviceable, 0) AS is_serviceable, COALESCE(a.is_vendor_avl, 0) AS is_vendor_avl,
               COALESCE(l.low_sale_flag, 0) AS low_sale_flag, COALESCE(e.is_excluded, 0) AS is_excluded
        FROM d_fsn_dp s LEFT JOIN d_serviceability v ON v.dest_pincode = s.dest_pincode
        LEFT JOIN d_vendor_avl a ON a.fsn = s.fsn AND a.dest_pincode = s.dest_pincode
        LEFT JOIN d_low_products l ON l.fsn = s.fsn LEFT JOIN d_exclusions e ON e.fsn = s.fsn""",
    "d_loss_steps": """
        SELECT *, CASE WHEN is_serviceable = 0 THEN nat_sales ELSE 0 END AS serviceability_loss,
               CASE WHEN is_serviceable = 1 AND is_vendor_avl = 0 THEN nat_sales ELSE 0 END AS vendor_loss
        FROM d_flags""",
    "d_loss_low": """
        SELECT *, CASE WHEN low_sale_flag = 1 THEN nat_sales - serviceability_loss - vendor_loss ELSE 0 END
               AS low_sale_depth_loss
        FROM d_loss_steps""",
    "d_loss_excl": """
        SELECT *, CASE WHEN is_excluded = 1
                       THEN nat_sales - serviceability_loss - vendor_loss - low_sale_depth_loss ELSE 0 END AS exclusion_loss
        FROM d_loss_low""",
    "d_placement": """
        SELECT *, serviceability_loss + vendor_loss + low_sale_depth_loss + exclusion_loss AS placement_loss
        FROM d_loss_excl""",
    "d_blocked": "SELECT * FROM d_placement WHERE placement_loss > 0",
    # --- issues ---
    "d_fe_issue": """
        SELECT fsn, dest_pincode, COUNT(DISTINCT fiu_id) AS fe_issue FROM a_explain
        WHERE lzn_value IN ('L1', 'L2', 'Z1', 'Z2') AND effective_inventory > 0
          AND fiu_id IN (SELECT fiu_id FROM a_explain WHERE lzn_value IN ('N1', 'N2') AND is_accepted = 'true')
        GROUP BY fsn, dest_pincode""",
    "d_lead": """
        SELECT p.fsn, l.fc, p.category, l.lead_time, c.cat_lead_time,
               CAST(CASE WHEN l.lead_time < 1 THEN c.cat_lead_time ELSE l.lead_time END AS DOUBLE) AS policy_lt
        FROM d_products p LEFT JOIN a_lead_time l ON l.fsn = p.fsn LEFT JOIN a_cat_lead c ON c.category = p.category""",
    "d_reco": """
        SELECT r.*, l.category, l.policy_lt, CAST(CEIL(l.policy_lt / 7) AS INTEGER) AS policy_lt_week,
               CAST(CASE CAST(CEIL(l.policy_lt / 7) AS INTEGER)
                 WHEN 1 THEN forecast_n WHEN 2 THEN forecast_n1 WHEN 3 THEN forecast_n2 WHEN 4 THEN forecast_n3
                 WHEN 5 THEN forecast_n4 WHEN 6 THEN forecast_n5 WHEN 7 THEN forecast_n6 WHEN 8 THEN forecast_n7
                 ELSE (forecast_n + forecast_n1 + forecast_n2 + forecast_n3 + forecast_n4 + forecast_n5
                       + forecast_n6 + forecast_n7) / 8.0 END AS DOUBLE) AS forecast_qty
        FROM a_requirement r JOIN d_lead l ON l.fsn = r.fsn AND l.fc = r.fc""",
    "d_pref_fc": """
        SELECT dest_pincode, CASE WHEN strpos(preferred_fc, ',') > 0
               THEN substr(preferred_fc, 1, strpos(preferred_fc, ',') - 1) ELSE '' END AS pref_fc
        FROM a_preferred""",
    "d_forecast": """
        SELECT s.fsn, s.pref_fc AS fc, s.sales, COALESCE(r.forecast_qty, 0) AS forecast_qty,
               GREATEST(s.sales - COALESCE(r.forecast_qty, 0), 0) AS forecast_issue
        FROM (SELECT d.fsn, p.pref_fc, SUM(d.sales) AS sales
              FROM d_fsn_dp d LEFT JOIN d_pref_fc p ON p.dest_pincode = d.dest_pincode GROUP BY d.fsn, p.pref_fc) s
        LEFT JOIN d_reco r ON r.fsn = s.fsn AND r.fc = s.pref_fc""",
    "d_override": """
        SELECT fsn, fc, CAST(GREATEST(system_qty - max_doh_qty, 0) AS DOUBLE) AS ndoh_issue,
               CAST(GREATEST(max_doh_qty - ipc_reviewed_qty, 0) AS DOUBLE) AS ipc_override_issue,
               CAST(GREATEST(ipc_reviewed_qty - cdo_reviewed_qty, 0) AS DOUBLE) AS cdo_override_issue,
               CAST(GREATEST(cdo_reviewed_qty - po_qty, 0) AS DOUBLE) AS po_issue
        FROM d_reco""",
    "d_adherence": """
        SELECT v.fsn, v.fc, SUM(GREATEST(v.poi_ordered_qty - v.poi_received_qty, 0)) AS vendor_adherence_issue
        FROM a_vendor_adherence v JOIN d_products p ON p.fsn = v.fsn
        LEFT JOIN d_lead l ON l.fsn = v.fsn AND l.fc = v.fc LEFT JOIN a_cat_lead c ON c.category = p.category
        WHERE (v.po_status = 'approved'
               AND date_diff('day', v.poi_created_day, DATE '1998-06-20') >= COALESCE(l.policy_lt, c.cat_lead_time))
           OR (v.po_status = 'completed'
               AND date_diff('day', v.poi_created_day, DATE '1997-06-29') <= 2 * COALESCE(l.policy_lt, c.cat_lead_time))
        GROUP BY v.fsn, v.fc""",
    # --- allocation ---
    "d_unblocked": """
        SELECT * FROM d_fsn_dp_fc f WHERE NOT EXISTS
          (SELECT 1 FROM d_blocked b WHERE b.fsn = f.fsn AND b.dest_pincode = f.dest_pincode)""",
    "d_fe_units": """
        SELECT u.fsn, u.dest_pincode, u.nat_sales, LEAST(COALESCE(i.fe_issue, 0), u.nat_sales) AS fe_loss
        FROM (SELECT fsn, dest_pincode, SUM(nat_sales) AS nat_sales FROM d_unblocked GROUP BY fsn, dest_pincode) u
        LEFT JOIN d_fe_issue i ON i.fsn = u.fsn AND i.dest_pincode = u.dest_pincode""",
    "d_pool": "SELECT *, GREATEST(nat_sales - fe_loss, 0) AS fsn_dp_loss FROM d_fe_units",
    "d_supplied": "SELECT DISTINCT fsn, dest_pincode, fc FROM d_candidates WHERE vendor_count > 0",
    "d_ratio": """
        SELECT s.fsn, s.dest_pincode, s.fc, 1.0 / CAST(n.fc_count AS DOUBLE) AS ratio FROM d_supplied s
        JOIN (SELECT fsn, dest_pincode, COUNT(*) AS fc_count FROM d_supplied GROUP BY fsn, dest_pincode) n
          ON n.fsn = s.fsn AND n.dest_pincode = s.dest_pincode""",
    "d_allocated": """
        SELECT r.*, p.fsn_dp_loss, r.ratio * p.fsn_dp_loss AS fsn_dp_fc_loss
        FROM d_ratio r LEFT JOIN d_pool p ON p.fsn = r.fsn AND p.dest_pincode = r.dest_pincode""",
    "d_collated": """
        SELECT a.fsn, a.dest_pincode, a.fc, a.ratio, COALESCE(a.fsn_dp_loss, 0) AS fsn_dp_loss,
               COALESCE(a.fsn_dp_fc_loss, 0) AS fsn_dp_fc_loss, COALESCE(f.forecast_issue, 0) AS i1,
               COALESCE(o.ndoh_issue, 0) AS i2, COALESCE(o.ipc_override_issue, 0) AS i3,
               COALESCE(o.cdo_override_issue, 0) AS i4, COALESCE(o.po_issue, 0) AS i5,
               COALESCE(v.vendor_adherence_issue, 0) AS i6
        FROM d_allocated a LEFT JOIN d_forecast f ON f.fsn = a.fsn AND f.fc = a.fc
        LEFT JOIN d_override o ON o.fsn = a.fsn AND o.fc = a.fc
        LEFT JOIN d_adherence v ON v.fsn = a.fsn AND v.fc = a.fc""",
    # closed form: a cause gets what the running total of issues cuts off the pool
    "d_cascade": """
        SELECT fsn, dest_pincode, fc, ratio, fsn_dp_loss, fsn_dp_fc_loss,
               m0 - m1 AS forecast_loss, m1 - m2 AS ndoh_loss, m2 - m3 AS ipc_override_loss,
               m3 - m4 AS cdo_override_loss, m4 - m5 AS po_loss, m5 - m6 AS vendor_adherence_loss, m6 AS residual
        FROM (SELECT *, fsn_dp_fc_loss AS m0, GREATEST(fsn_dp_fc_loss - i1, 0) AS m1,
                     GREATEST(fsn_dp_fc_loss - i1 - i2, 0) AS m2, GREATEST(fsn_dp_fc_loss - i1 - i2 - i3, 0) AS m3,
                     GREATEST(fsn_dp_fc_loss - i1 - i2 - i3 - i4, 0) AS m4,
                     GREATEST(fsn_dp_fc_loss - i1 - i2 - i3 - i4 - i5, 0) AS m5,
                     GREATEST(fsn_dp_fc_loss - i1 - i2 - i3 - i4 - i5 - i6, 0) AS m6 FROM d_collated) t""",
    "d_by_dest": """
        SELECT fsn, dest_pincode, SUM(forecast_loss) AS forecast_loss, SUM(ndoh_loss) AS ndoh_loss,
               SUM(ipc_override_loss) AS ipc_override_loss, SUM(cdo_override_loss) AS cdo_override_loss,
               SUM(po_loss) AS po_loss, SUM(vendor_adherence_loss) AS vendor_adherence_loss, SUM(residual) AS residual
        FROM d_cascade GROUP BY fsn, dest_pincode""",
    "d_losses": """
        SELECT k.fsn, k.dest_pincode, COALESCE(b.serviceability_loss, 0) AS serviceability_loss,
               COALESCE(b.vendor_loss, 0) AS vendor_loss, COALESCE(b.low_sale_depth_loss, 0) AS low_sale_depth_loss,
               COALESCE(b.exclusion_loss, 0) AS exclusion_loss, COALESCE(f.fe_loss, 0) AS fe_loss,
               COALESCE(c.forecast_loss, 0) AS forecast_loss, COALESCE(c.ndoh_loss, 0) AS ndoh_loss,
               COALESCE(c.ipc_override_loss, 0) AS ipc_override_loss,
               COALESCE(c.cdo_override_loss, 0) AS cdo_override_loss, COALESCE(c.po_loss, 0) AS po_loss,
               COALESCE(c.vendor_adherence_loss, 0) AS vendor_adherence_loss, COALESCE(c.residual, 0) AS residual
        FROM (SELECT fsn, dest_pincode FROM d_blocked UNION SELECT fsn, dest_pincode FROM d_pool
              UNION SELECT fsn, dest_pincode FROM d_by_dest) k
        LEFT JOIN d_blocked b ON b.fsn = k.fsn AND b.dest_pincode = k.dest_pincode
        LEFT JOIN d_pool f ON f.fsn = k.fsn AND f.dest_pincode = k.dest_pincode
        LEFT JOIN d_by_dest c ON c.fsn = k.fsn AND c.dest_pincode = k.dest_pincode""",
    # --- final table ---
    "d_promo": """
        SELECT l.* EXCLUDE (residual), COALESCE(o.offer_sales, 0) AS offer_sales,
               GREATEST(l.residual - COALESCE(o.offer_sales, 0), 0) AS promotions_loss,
               GREATEST(l.residual - GREATEST(l.residual - COALESCE(o.offer_sales, 0), 0), 0) AS residual
        FROM d_losses l LEFT JOIN a_offer o ON o.fsn = l.fsn AND o.dest_pincode = l.dest_pincode""",
    "d_detail": """
        SELECT h.fsn, h.dest_pincode, h.bu, h.super_category, h.category, h.vertical, h.brand,
               26 AS ru_computed_week, 1998 AS ru_year, 19970629 AS week_start_date_key,
               h.sales, h.ru_sales, h.nat_sales, h.sales - h.ru_sales - h.nat_sales AS unmapped_sales,
               p.serviceability_loss, p.vendor_loss, p.low_sale_depth_loss, p.exclusion_loss, p.fe_loss,
               p.forecast_loss, p.ndoh_loss, p.ipc_override_loss, p.cdo_override_loss, p.po_loss,
               p.vendor_adherence_loss, p.promotions_loss, p.residual
        FROM d_hierarchy h LEFT JOIN d_promo p ON p.fsn = h.fsn AND p.dest_pincode = h.dest_pincode""",
}

_WORD = re.compile(r"\b[adgw]_[a-z0-9_]+\b")


def needed(sql: str, views: dict[str, str]) -> list[str]:
    """Views a statement uses, directly or through others, in definition order."""
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in _WORD.findall(text):
            if name in views and name not in seen:
                seen.add(name)
                visit(views[name])

    visit(sql)
    return [name for name in views if name in seen]


def with_views(sql: str, views: dict[str, str] = VIEWS) -> str:
    names = needed(sql, views)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in names) + "\n" + sql


def rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"ROUND(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in cols)
