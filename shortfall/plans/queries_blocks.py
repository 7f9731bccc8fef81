"""Queries of the general operators: files, projections, joins, aggregates, functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from shortfall.functions import dates, nulls, text
from shortfall.operators import centres, matrix, quality
from shortfall.operators import relational as rel
from shortfall.operators.prepare import sales_by
from shortfall.plans.driver_tables import PERIOD
from shortfall.plans.earlier import plan_file_anchor, plan_of_files
from shortfall.plans.registry import Presented, presentable, query, rounded
from shortfall.sources import files
from shortfall.sources.schemas import SCHEMAS
from shortfall.sources.stage import new_path, stage

# --- files -----------------------------------------------------------------

ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _orders(t):
    return t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("scan_csv_roundtrip", ORDERS_SQL)
def _csv(t):
    path = new_path(t.spark, "csv")
    files.write_csv(_orders(t), path)
    return files.read_csv(t.spark, path, ORDERS_SCHEMA)


@query("scan_tsv_roundtrip", ORDERS_SQL)
def _tsv(t):
    path = new_path(t.spark, "tsv")
    files.write_tsv(_orders(t), path)
    return files.read_tsv(t.spark, path, ORDERS_SCHEMA)


@query("scan_limited", "SELECT LEAST(COUNT(*), 1000) AS rows_read FROM orders")
def _limited(t):
    path = new_path(t.spark, "csv")
    files.write_csv(_orders(t), path)
    return files.read_limited(t.spark, path, ORDERS_SCHEMA, 1000).agg(
        F.count("*").alias("rows_read")
    )


@query("scan_week_partition", "SELECT fsn, sales FROM a_sales WHERE (dayofyear(day) - 1) // 7 + 1 = 26")
def _week_partition(t):
    path = new_path(t.spark, "weeks")
    t.sales.select("fsn", "sales", dates.week_of_year("day").alias("week")).write.partitionBy(
        "week"
    ).parquet(path)
    return files.read_week(t.spark, path, PERIOD.week).select("fsn", "sales")


@query(
    "reco_weekly_scan",
    """SELECT strftime(CAST(file_day AS DATE), '%d/%m/%Y') AS reco_date, COUNT(*) AS row_count, SUM(l_quantity) AS generated
       FROM (SELECT l_quantity, DATE '1997-06-24' - 7 * CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '1997-06-24') // 7 AS INTEGER)
                    AS file_day FROM lineitem
             WHERE CAST(l_shipdate AS DATE) <= DATE '1997-06-24' AND CAST(l_shipdate AS DATE) > DATE '1997-04-15') x
       GROUP BY ALL""",
)
def _weekly_files(t):
    """The plan rows of ten weeks, written as weekly files and read by their dates."""
    anchor = plan_file_anchor(PERIOD)
    root = new_path(t.spark, "plan-files")
    day = F.to_date("reco_date", "dd/MM/yyyy")
    behind = dates.days_between(anchor, day)
    file_day = F.date_sub(F.lit(anchor), (F.floor(behind / 7) * 7).cast("int"))
    t.reco_file.where(behind.between(0, 69)).withColumns(
        {"file_day": file_day, "reco_date": F.date_format(file_day, "dd/MM/yyyy")}
    ).write.partitionBy("file_day").csv(root, header=True, nullValue="NA")
    scan = files.read_dated(t.spark, root + "/file_day={date}", anchor, SCHEMAS["auto_reco"])
    return scan.groupBy("reco_date").agg(
        F.count("*").alias("row_count"), F.sum("`Qty.Generated`").alias("generated")
    )


@query(
    "reco_restated",
    """SELECT "FSN", "FC", SUM(generated) AS generated, SUM(row_count) AS row_count FROM (
         SELECT l_partkey AS "FSN", 'FC' || s_nationkey AS "FC",
                SUM(l_quantity + CASE WHEN weeks > 0 AND l_partkey % 2 = 0 THEN 1 ELSE 0 END) AS generated, COUNT(*) AS row_count
         FROM (SELECT *, date_diff('day', CAST(l_shipdate AS DATE), DATE '1997-06-24') // 7 AS weeks FROM lineitem
               WHERE CAST(l_shipdate AS DATE) <= DATE '1997-06-24' AND CAST(l_shipdate AS DATE) > DATE '1997-04-15') x
         JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL) y GROUP BY ALL""",
)
def _restated_plan(t):
    """Weekly plan files that restate the even products of the week before; the newest file counts."""
    anchor = plan_file_anchor(PERIOD)
    root = new_path(t.spark, "restated-files")
    weeks = F.floor(dates.days_between(anchor, F.to_date("reco_date", "dd/MM/yyyy")) / 7).cast("int")
    generated = F.col("`Qty.Generated`")
    plan = t.reco_file.withColumn("weeks", weeks).where(F.col("weeks").between(0, 9))
    again = plan.where((F.col("weeks") > 0) & (F.col("FSN") % 2 == 0))
    again = again.withColumns({"weeks": F.col("weeks") - 1, "Qty.Generated": generated + 1})
    file_day = F.date_sub(F.lit(anchor), F.col("weeks") * 7)
    plan.unionByName(again).withColumn("file_day", file_day).drop("weeks").write.partitionBy("file_day").csv(
        root, header=True, nullValue="NA"
    )
    rows = plan_of_files(t.spark, root + "/file_day={date}", PERIOD)
    return rows.groupBy(F.col("FSN").cast("bigint").alias("FSN"), "FC").agg(
        F.sum(generated).alias("generated"), F.count("*").alias("row_count")
    )


query("checkpoint_stage", "SELECT fsn, fc, fsn_vendor_count FROM d_vendor_fsn")(
    lambda t: stage(t.weekly.fsn_vendors, "vendors")
)
query("strip_qualifiers", ORDERS_SQL)(
    lambda t: text.strip_qualifiers(_orders(t).toDF(*[f"po.{c}" for c in _orders(t).columns]))
)

# --- projections and filters -------------------------------------------------

query(
    "sales_derive",
    "SELECT fiu_id, fsn, sales, unmapped_sales, sales - unmapped_sales AS mapped_sales FROM a_sales",
)(
    lambda t: t.sales.withColumn(
        "unmapped_sales", F.col("sales") - F.col("ru_sales") - F.col("nat_sales")
    )
    .withColumn("mapped_sales", F.col("sales") - F.col("unmapped_sales"))
    .select("fiu_id", "fsn", "sales", "unmapped_sales", "mapped_sales")
)
query(
    "cols_by_prefix",
    """SELECT system_qty, max_doh_qty, ipc_reviewed_qty, cdo_reviewed_qty, po_qty, forecast_n, forecast_n1, forecast_n2,
       forecast_n3, forecast_n4, forecast_n5, forecast_n6, forecast_n7 FROM a_requirement""",
)(
    lambda t: t.requirement.select(
        *rel.columns_like(t.requirement, prefixes=["forecast"], suffixes=["qty"])
    )
)
query(
    "bulk_try_cast",
    """SELECT l_orderkey, l_linenumber, TRY_CAST(CASE WHEN l_linenumber > 4 THEN 'NULL' ELSE CAST(l_quantity AS VARCHAR) END
       AS DOUBLE) AS qty, TRY_CAST(l_returnflag AS DOUBLE) AS flag FROM lineitem""",
)(
    lambda t: rel.cast_numeric(
        t.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.when(F.col("l_linenumber") > 4, "NULL")
            .otherwise(F.col("l_quantity").cast("string"))
            .alias("qty"),
            F.col("l_returnflag").alias("flag"),
        ),
        ["qty", "flag"],
    )
)
query(
    "fill_zero",
    """SELECT l_orderkey, l_linenumber, COALESCE(NULLIF(l_quantity, 50), 0) AS qty, COALESCE(NULLIF(l_tax, 0.0), 0) AS tax
       FROM lineitem""",
)(
    lambda t: nulls.fill_zero(
        t.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.nullif("l_quantity", F.lit(50.0)).alias("qty"),
            F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        ),
        ["qty", "tax"],
    )
)


def flags() -> Column:
    return F.array(F.lit("true"), F.lit("TRUE"), F.lit("1"), F.lit("false"), F.lit("0"))


query(
    "bool_normalise",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 3) THEN 1 ELSE 0 END AS accepted FROM lineitem""",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.is_true(
            F.get(flags(), F.least(F.col("l_linenumber"), F.lit(5)) - 1)
        ).cast("int").alias("accepted"),
    )
)
query(
    "null_split",
    """SELECT CASE WHEN m IS NULL THEN 'missing' ELSE 'present' END AS part, COUNT(*) AS n FROM (
       SELECT NULLIF(l_quantity, 50) AS m FROM lineitem) x GROUP BY 1""",
)(
    lambda t: rel.union_ragged(
        *[
            t.table("lineitem")
            .withColumn("m", F.nullif("l_quantity", F.lit(50.0)))
            .where(cond)
            .agg(F.count("*").alias("n"))
            .withColumn("part", F.lit(part))
            for part, cond in [
                ("missing", F.col("m").isNull()),
                ("present", F.col("m").isNotNull()),
            ]
        ]
    ).select("part", "n")
)

# --- joins --------------------------------------------------------------------

query(
    "join_left",
    """SELECT s.fsn, s.dest_pincode, s.sales, o.offer_sales FROM d_fsn_dp s
       LEFT JOIN a_offer o ON o.fsn = s.fsn AND o.dest_pincode = s.dest_pincode""",
)(
    lambda t: t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales").join(
        t.weekly.offers, ["fsn", "dest_pincode"], "left"
    )
)
query(
    "join_right",
    """SELECT s.dest_pincode, s.fsn, s.sales, p.pref_fc FROM d_pref_fc p
       RIGHT JOIN d_fsn_dp s ON s.dest_pincode = p.dest_pincode""",
)(
    lambda t: t.weekly.preferred.join(
        t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales"), "dest_pincode", "right"
    )
)
query(
    "join_inner",
    """SELECT r.fsn, r.fc, r.system_qty, l.lead_time FROM a_requirement r
       JOIN a_lead_time l ON l.fsn = r.fsn AND l.fc = r.fc""",
)(
    lambda t: t.requirement.withColumnRenamed("warehouse", "fc")
    .select("fsn", "fc", "system_qty")
    .join(t.lead_time.withColumnRenamed("warehouse", "fc"), ["fsn", "fc"])
)
query(
    "join_full_recon",
    f"""SELECT COALESCE(r.fsn, u.fsn) AS fsn, COALESCE(r.dest_pincode, u.dest_pincode) AS dest_pincode,
        COALESCE(r.fc, u.fc) AS fc, {rounded(['ratio'])}, u.nat_sales
        FROM d_ratio r FULL JOIN d_fsn_dp_fc u ON u.fsn = r.fsn AND u.dest_pincode = r.dest_pincode AND u.fc = r.fc""",
)(
    lambda t: Presented(
        centres.ratio_full_join(
            t.weekly_staged.centre_sets,
            t.weekly_staged.near_centres,
            t.weekly_staged.sales_fsn_dp_fc.select("fsn", "dest_pincode", "fc", "nat_sales"),
            presentable,
        )
    )
)
query(
    "join_anti",
    "SELECT fsn, dest_pincode, sales FROM d_fsn_dp WHERE fsn NOT IN (SELECT fsn FROM a_exclusion)",
)(
    lambda t: t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales").join(
        t.exclusion_list.select("fsn"), "fsn", "left_anti"
    )
)
query(
    "join_semi",
    "SELECT fsn, dest_pincode, sales FROM d_fsn_dp WHERE fsn IN (SELECT fsn FROM a_exclusion)",
)(
    lambda t: t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales").join(
        t.exclusion_list.select("fsn"), "fsn", "left_semi"
    )
)
query(
    "join_cross_pruned",
    """SELECT d.dest_pincode, d.category, d.sales, f.fc, z.lzn_value
       FROM (SELECT dest_pincode, category, SUM(sales) AS sales FROM a_sales GROUP BY ALL) d
       CROSS JOIN (SELECT DISTINCT fc FROM d_lanes) f JOIN d_lz z ON z.fc = f.fc AND z.dest_pincode = d.dest_pincode""",
)(
    # demand meets only the near lanes of its destination; no cross product is formed
    lambda t: rel.salted_join(
        t.sales.groupBy("dest_pincode", "category").agg(F.sum("sales").alias("sales")),
        t.weekly.lanes.where(F.col("lzn_value").isin("L1", "L2", "Z1", "Z2")).select(
            "dest_pincode", "fc", "lzn_value"
        ),
        on=["dest_pincode"],
        spread_by=["category"],
    )
)
query(
    "join_chain",
    """SELECT r.fsn, r.fc, r.system_qty, v.fsn_vendor_count, o.ndoh_issue, a.vendor_adherence_issue FROM a_requirement r
       LEFT JOIN d_vendor_fsn v ON v.fsn = r.fsn AND v.fc = r.fc LEFT JOIN d_override o ON o.fsn = r.fsn AND o.fc = r.fc
       LEFT JOIN d_adherence a ON a.fsn = r.fsn AND a.fc = r.fc""",
)(
    lambda t: rel.join_chain(
        t.requirement.select("fsn", F.col("warehouse").alias("fc"), "system_qty"),
        [
            t.weekly_leads.fsn_vendors,
            t.weekly_leads.override_issues.select("fsn", "fc", "ndoh_issue"),
            t.weekly_leads.adherence_issue,
        ],
        ["fsn", "fc"],
    )
)
query(
    "join_upper_key",
    """SELECT p.p_partkey, p.p_brand AS brand, v.vendors FROM part p LEFT JOIN (
         SELECT upper(brand) AS b, SUM(brand_vendor_count)::BIGINT AS vendors FROM d_vendor_brand GROUP BY ALL) v
       ON v.b = upper(p.p_brand)""",
)(
    lambda t: rel.join_on_upper(
        t.table("part").select("p_partkey", F.col("p_brand").alias("brand")),
        t.weekly.brand_vendors.groupBy(F.lower("brand").alias("brand")).agg(
            F.sum("brand_vendor_count").alias("vendors")
        ),
        "brand",
    )
)
query(
    "join_natural",
    "SELECT s.fsn, s.dest_pincode, s.sales, f.fe_issue FROM d_fsn_dp s LEFT JOIN d_fe_issue f USING (fsn, dest_pincode)",
)(
    lambda t: rel.natural_join(
        t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales"), t.weekly.fe_issue
    )
)


def _nullsafe(t):
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_quantity", F.lit(50.0)).alias("q")
    )
    weights = lines.groupBy("q").agg(F.count("*").alias("weight"))
    return nulls.null_safe_join(lines, weights, [("q", "q")]).drop("q")


NULLSAFE_SQL = """SELECT a.l_orderkey, a.l_linenumber, b.weight FROM
       (SELECT l_orderkey, l_linenumber, NULLIF(l_quantity, 50) AS q FROM lineitem) a
       LEFT JOIN (SELECT NULLIF(l_quantity, 50) AS q, COUNT(*) AS weight FROM lineitem GROUP BY ALL) b
       ON a.q IS NOT DISTINCT FROM b.q"""
query("join_nullsafe", NULLSAFE_SQL)(_nullsafe)

# --- aggregates -----------------------------------------------------------------

query("sales_by_fsn_dp", "SELECT * FROM d_fsn_dp")(lambda t: t.weekly.sales_fsn_dp)
query("sales_by_fsn_dp_fc", "SELECT * FROM d_fsn_dp_fc")(lambda t: t.weekly.sales_fsn_dp_fc)
query("sales_by_hierarchy", "SELECT * FROM d_hierarchy")(lambda t: t.weekly.sales_hierarchy)
query(
    "sales_by_vertical_dp",
    """SELECT vertical, dest_pincode, SUM(sales) AS sales, SUM(ru_sales) AS ru_sales, SUM(nat_sales) AS nat_sales
       FROM a_sales GROUP BY vertical, dest_pincode""",
)(lambda t: sales_by(t.sales, ["vertical", "dest_pincode"]))
query(
    "sum_strict",
    """SELECT l_partkey, CASE WHEN COUNT(*) = COUNT(q) THEN SUM(q) END AS strict_total, COALESCE(SUM(q), 0) AS loose_total
       FROM (SELECT l_partkey, NULLIF(l_quantity, 50) AS q FROM lineitem) x GROUP BY l_partkey""",
)(
    lambda t: t.table("lineitem")
    .select("l_partkey", F.nullif("l_quantity", F.lit(50.0)).alias("q"))
    .groupBy("l_partkey")
    .agg(nulls.strict_sum("q").alias("strict_total"), nulls.sum_or_zero("q").alias("loose_total"))
)
query(
    "count_distinct_na",
    """SELECT l_partkey, COUNT(DISTINCT q) + MAX(CASE WHEN q IS NULL THEN 1 ELSE 0 END) AS values_seen
       FROM (SELECT l_partkey, NULLIF(l_quantity, 50) AS q FROM lineitem) x GROUP BY l_partkey""",
)(
    lambda t: t.table("lineitem")
    .select("l_partkey", F.nullif("l_quantity", F.lit(50.0)).alias("q"))
    .groupBy("l_partkey")
    .agg(nulls.count_distinct_na("q").alias("values_seen"))
)
query("distinct_rows", "SELECT * FROM d_pairs")(lambda t: t.weekly.pairs)
query("fsn_category", "SELECT * FROM d_products")(lambda t: t.weekly.products)
query(
    "row_blank_count",
    'SELECT "Destination_Pincode", SUM(CASE WHEN "FC" IN (\'\', \'0\') THEN 1 ELSE 0 END)::INTEGER AS blanks '
    'FROM g_slots GROUP BY "Destination_Pincode"',
)(
    lambda t: matrix.lane_slots(t.lane_wide).select(
        "Destination_Pincode",
        rel.count_where_in(
            rel.columns_like(t.lane_wide, prefixes=["L1", "L2", "Z1", "Z2"]), ["", "0"]
        ).alias("blanks"),
    )
)
query(
    "row_flag_sum",
    'SELECT "FSN", ' + " + ".join(f'"FC{k}"' for k in range(25)) + " AS open_fcs FROM g_tax_wide",
)(
    lambda t: t.tax_wide.select(
        "FSN", rel.row_sum(rel.columns_like(t.tax_wide, prefixes=["FC"])).alias("open_fcs")
    )
)
query("freq_table", "SELECT is_serviceable, COUNT(*) AS n FROM d_serviceability GROUP BY 1")(
    lambda t: rel.frequency(t.weekly.serviceability, "is_serviceable")
)
query(
    "qa_scalars",
    """SELECT COUNT(*) AS row_count, SUM(sales) AS sales, SUM(unmapped_sales) AS unmapped_sales, MIN(sales) AS min_sales,
       MAX(sales) AS max_sales, COUNT(DISTINCT fc) AS fc_count FROM a_sales""",
)(lambda t: quality.scalar_summary(t.weekly.sales))
query(
    "key_fanout_audit",
    "SELECT vertical, COUNT(DISTINCT brand) AS value_count FROM a_sales GROUP BY vertical",
)(lambda t: rel.fanout_audit(t.sales, "vertical", "brand"))
query(
    "sample_tail",
    "SELECT fsn, dest_pincode, sales FROM d_fsn_dp ORDER BY fsn DESC, dest_pincode DESC LIMIT 6",
)(
    lambda t: rel.last_rows(
        t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales"), ["fsn", "dest_pincode"]
    )
)
query(
    "union_ragged",
    """SELECT fsn, dest_pincode, sales, NULL AS fe_issue, NULL AS offer_sales FROM d_fsn_dp
       UNION ALL SELECT fsn, dest_pincode, NULL, fe_issue, NULL FROM d_fe_issue
       UNION ALL SELECT fsn, dest_pincode, NULL, NULL, offer_sales FROM a_offer""",
)(
    lambda t: rel.union_ragged(
        t.weekly.sales_fsn_dp.select("fsn", "dest_pincode", "sales"),
        t.weekly.fe_issue,
        t.weekly.offers,
    )
)

# --- scalar functions ---------------------------------------------------------------

query(
    "fn_pmin_pmax",
    """SELECT l_orderkey, l_linenumber, CASE WHEN a IS NOT NULL THEN LEAST(a, b) END AS low,
       CASE WHEN a IS NOT NULL THEN GREATEST(a, b) END AS high,
       CASE WHEN a IS NOT NULL THEN GREATEST(a - b, 0) END AS beyond
       FROM (SELECT *, NULLIF(l_quantity, 50) AS a, CAST(l_linenumber * 10 AS DOUBLE) AS b FROM lineitem) x""",
)(
    lambda t: t.table("lineitem")
    .select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_quantity", F.lit(50.0)).alias("a"),
        (F.col("l_linenumber") * 10).cast("double").alias("b"),
    )
    .select(
        "l_orderkey",
        "l_linenumber",
        nulls.strict_least("a", "b").alias("low"),
        nulls.strict_greatest("a", "b").alias("high"),
        nulls.excess("a", "b").alias("beyond"),
    )
)
query(
    "fn_ifelse_null",
    """SELECT l_orderkey, l_linenumber, CASE WHEN q IS NULL THEN NULL WHEN q > 25 THEN 'big' ELSE 'small' END AS size
       FROM (SELECT *, NULLIF(l_quantity, 50) AS q FROM lineitem) x""",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        nulls.if_else(
            F.nullif("l_quantity", F.lit(50.0)) > 25, F.lit("big"), F.lit("small")
        ).alias("size"),
    )
)
query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, CAST(CEIL(l_quantity / 7) AS INTEGER) AS weeks,
       CASE WHEN l_tax <> 0 AND l_discount <> 0 THEN 1 ELSE 0 END AS both_set, ROUND(l_quantity / 7, 2) AS rounded_share
       FROM lineitem""",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.ceil(F.col("l_quantity") / 7).cast("int").alias("weeks"),
        ((F.col("l_tax") != 0) & (F.col("l_discount") != 0)).cast("int").alias("both_set"),
        F.bround(F.col("l_quantity") / 7, 2).alias("rounded_share"),
    )
)
query(
    "fn_week",
    """SELECT l_orderkey, l_linenumber, CAST((dayofyear(l_shipdate) - 1) // 7 + 1 AS INTEGER) AS week_block,
       CAST(dayofyear(l_shipdate) // 7 + 1 AS INTEGER) AS week_legacy, CAST(year(l_shipdate) AS INTEGER) AS ship_year
       FROM lineitem""",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        dates.week_of_year("l_shipdate").alias("week_block"),
        dates.week_of_year("l_shipdate", "legacy").alias("week_legacy"),
        F.year("l_shipdate").alias("ship_year"),
    )
)
query(
    "fn_period_dates",
    """SELECT o_orderkey, CAST(dayofweek(d) + 1 AS INTEGER) AS weekday, CAST(d - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS sunday,
       CAST(d - CAST(dayofweek(d) + 1 AS INTEGER) AS VARCHAR) AS saturday_before, CAST(d - 28 AS VARCHAR) AS four_weeks_ago
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) x""",
)(
    lambda t: t.table("orders")
    .select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    .select(
        "o_orderkey",
        F.dayofweek("d").alias("weekday"),
        dates.sunday_on_or_before("d").alias("sunday"),
        dates.last_saturday_before("d").alias("saturday_before"),
        F.date_sub("d", 28).alias("four_weeks_ago"),
    )
)
query(
    "fn_parse_dates",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS key,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS from_slashes,
       CAST(NULL AS VARCHAR) AS from_nonsense, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) - 19950101 AS key_difference
       FROM orders""",
)(
    lambda t: t.table("orders")
    .select("o_orderkey", "o_orderdate", dates.date_key("o_orderdate").alias("key"))
    .select(
        "o_orderkey",
        "key",
        dates.parse_date("key", "yyyyMMdd").alias("from_key"),
        dates.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias(
            "from_slashes"
        ),
        dates.parse_date(F.concat(F.lit("x"), F.col("key").cast("string")), "yyyyMMdd").alias(
            "from_nonsense"
        ),
        (F.col("key") - 19950101).alias("key_difference"),
    )
)
query(
    "fn_strings",
    """SELECT p_partkey, CASE WHEN strpos(l, ',') > 0 THEN substr(l, 1, strpos(l, ',') - 1) ELSE '' END AS first_item,
       upper(p_brand) AS brand_upper, CAST(length(p_name) AS INTEGER) AS name_length, substr(p_brand, 1, 2) AS two_letters
       FROM (SELECT *, CASE WHEN p_size > 25 THEN p_brand || ',' || p_type ELSE p_brand END AS l FROM part) x""",
)(
    lambda t: t.table("part")
    .withColumn(
        "l",
        F.when(F.col("p_size") > 25, F.concat_ws(",", "p_brand", "p_type")).otherwise(
            F.col("p_brand")
        ),
    )
    .select(
        "p_partkey",
        text.first_of_list("l").alias("first_item"),
        F.upper("p_brand").alias("brand_upper"),
        F.length("p_name").alias("name_length"),
        F.substring("p_brand", 1, 2).alias("two_letters"),
    )
)
