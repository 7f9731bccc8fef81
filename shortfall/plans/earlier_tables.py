"""The star-schema tables seen as the inputs of the earlier run.

Here a fulfilment centre is the nation a supplier ships from, so the wide
matrices have one column per nation whatever the scale.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.operators import warehouse
from shortfall.plans.driver_tables import PERIOD, DriverTables, in_days, text
from shortfall.plans.earlier import EarlierInputs, EarlierRun
from shortfall.sources.stage import stage

PO_SINCE = dt.date(1997, 1, 1)


def centre(nation: str) -> Column:
    return F.concat(F.lit("FC"), F.col(nation).cast("string"))


def day_key(c: str) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


class EarlierTables(DriverTables):
    @cached_property
    def sales_g1(self) -> DataFrame:
        return self.sales.select(
            "fsn",
            "dest_pincode",
            "day",
            centre("source_pincode").alias("source_id"),
            "brand",
            "bu",
            "category",
            "super_category",
            F.col("category").alias("sub_category"),
            "vertical",
            "sales",
            "ru_sales",
            (F.col("sales") - F.col("ru_sales")).alias("nat_sales"),
        )

    @cached_property
    def lane_wide(self) -> DataFrame:
        """Near and national centres of each destination, one column per slot."""
        fc, lane, rank = centre("src_pincode"), F.col("lzn_value"), F.floor(F.col("src_pincode") / 5)
        slots = {"L1_0": F.max(F.when(lane == "L1", fc))}
        for k in range(5):
            slots[f"Z1_{k}"] = F.max(F.when((lane == "Z1") & (rank == k), fc))
        slots["N1_0"] = F.max(F.when(lane == "N1", fc))
        return self.lzn_mapping.groupBy(F.col("dest_pincode").alias("Destination_Pincode")).agg(
            *[F.coalesce(c, F.lit("0" if name[0] == "Z" else "")).alias(name) for name, c in slots.items()]
        )

    @cached_property
    def tax_wide(self) -> DataFrame:
        closed = lambda k: (F.col("p_size") > 10) & ((F.col("p_partkey") + k) % 4 == 0)
        return self.table("part").select(
            F.col("p_partkey").alias("FSN"),
            *[F.when(closed(k), 0).otherwise(1).alias(f"FC{k}") for k in range(self.nations)],
        )

    @cached_property
    def lines_by_source(self) -> DataFrame:
        """Line items with product and source nation."""
        part = self.table("part").withColumnRenamed("p_partkey", "l_partkey")
        source = self.suppliers.withColumnRenamed("fc_no", "l_suppkey")
        return self.table("lineitem").join(part, "l_partkey").join(source, "l_suppkey")

    def _wide_flags(self, keys: dict[str, str], seen: Column) -> DataFrame:
        at = lambda k: seen & (F.col("src_nation") == k)
        return self.lines_by_source.groupBy(
            *[F.col(c).alias(name) for name, c in keys.items()]
        ).agg(*[F.max(F.when(at(k), 1).otherwise(0)).alias(f"FC{k}") for k in range(self.nations)])

    @cached_property
    def u2s_wide(self) -> DataFrame:
        keys = {
            "brand": "p_brand", "vertical": "p_name",
            "super_category": "p_type", "category": "p_type",
        }
        return self._wide_flags(keys, F.lit(True))

    @cached_property
    def vendor_wide(self) -> DataFrame:
        keys = {"brand": "p_brand", "Vertical": "p_name", "Category": "p_type"}
        return self._wide_flags(keys, F.col("l_returnflag") == "R")

    @cached_property
    def leadtime_wide(self) -> DataFrame:
        days = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3) % 63
        at = lambda k: F.when(F.col("src_nation") == k, days)
        source = self.suppliers.withColumnRenamed("fc_no", "l_suppkey")
        return (
            self.table("lineitem")
            .join(source, "l_suppkey")
            .groupBy(F.col("l_partkey").alias("fsn"))
            .agg(*[F.max(at(k)).alias(f"lead_time_for_FC{k}") for k in range(self.nations)])
        )

    @cached_property
    def cat_floor(self) -> DataFrame:
        return self.cat_lead_time.withColumnRenamed("lead_time", "Lead_time_floor")

    @cached_property
    def preferred_wh(self) -> DataFrame:
        near = self.lzn_mapping.where(F.col("lzn_value").isin("L1", "Z1"))
        return near.groupBy("dest_pincode").agg(F.min(centre("src_pincode")).alias("preferred_wh"))

    @cached_property
    def exclusions_g1(self) -> DataFrame:
        return self.exclusion_list.select("fsn", F.lit(1).alias("exclusion_flag"))

    # --- warehouse facts -------------------------------------------------

    @cached_property
    def unit_dim(self) -> DataFrame:
        """Units are orders; the destination is the customer's nation."""
        status = F.when(F.col("o_orderstatus") == "P", "customer_cancelled").otherwise("open")
        customer = self.table("customer").withColumnRenamed("c_custkey", "o_custkey")
        return self.table("orders").join(customer, "o_custkey").select(
            F.col("o_orderkey").alias("fulfill_item_unit_id"),
            status.alias("fulfill_item_unit_status_modified"),
            F.col("c_nationkey").alias("fulfill_item_unit_destination_pincode"),
        )

    @cached_property
    def product_dim(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_dim_key"),
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") <= 25, "Small").otherwise("Large").alias("analytic_business_unit"),
            F.col("p_name").alias("analytic_vertical"),
            F.col("p_type").alias("analytic_sub_category"),
            F.col("p_type").alias("analytic_category"),
            F.col("p_type").alias("analytic_super_category"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("brand"),
        )

    @cached_property
    def seller_dim(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("seller_dim_key"),
            (F.col("s_acctbal") >= 0).cast("int").alias("is_first_party_seller"),
        )

    @cached_property
    def explain_fact(self) -> DataFrame:
        """Two offers per line item: its own source, and the fifth nation after it."""
        own = F.struct(
            centre("src_nation").alias("warehouse"),
            (F.col("l_linestatus") == "F").cast("int").alias("accepted"),
            (F.col("l_quantity") - 10).alias("effective_inventory"),
        )
        other = F.struct(
            F.concat(F.lit("FC"), ((F.col("src_nation") + 5) % self.nations).cast("string")).alias("warehouse"),
            F.lit(0).alias("accepted"),
            (F.col("l_quantity") - 25).alias("effective_inventory"),
        )
        source = self.suppliers.select(F.col("fc_no").alias("l_suppkey"), "src_nation")
        return (
            self.lines(PERIOD.wk_start, PERIOD.wk_end)
            .join(source, "l_suppkey")
            .select(
                F.col("l_orderkey").alias("fiu_id"),
                F.col("l_partkey").alias("product_id_key"),
                F.col("l_suppkey").alias("seller_id_key"),
                F.concat(F.lit("T"), (F.col("l_linenumber") % 3).cast("string")).alias("lpe_tier"),
                day_key("l_shipdate").alias("unit_reserve_actual_date_key"),
                F.explode(F.array(own, other)).alias("offer"),
            )
            .select("*", "offer.*")
            .drop("offer")
        )

    @cached_property
    def explain_extract(self) -> DataFrame:
        return warehouse.explain_extract(
            self.explain_fact, self.unit_dim, self.product_dim, self.seller_dim, PERIOD
        )

    @cached_property
    def sold_units(self) -> DataFrame:
        """Line items as fulfilled units; the extract picks its four weeks."""
        status = F.when(F.col("l_returnflag") == "R", "customer_cancelled").otherwise("open")
        return self.lines().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fulfill_item_unit_id"),
            F.col("l_partkey").alias("product_id_key"),
            F.col("l_suppkey").alias("seller_id_key"),
            status.alias("fulfill_item_unit_status_modified"),
            day_key("l_shipdate").alias("fulfill_item_unit_reserve_actual_date_key"),
        )

    @cached_property
    def low_sale(self) -> DataFrame:
        return warehouse.low_sale_products_4wk(
            self.sold_units, self.product_dim, self.seller_dim, self.min_sale_threshold, PERIOD
        )

    @cached_property
    def po_header(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("open")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            status.alias("status"),
            F.col("o_orderdate").alias("created_at"),
            F.concat(F.lit("FC"), (F.col("o_custkey") % self.nations).cast("string")).alias(
                "origin_warehouse_id"
            ),
        )

    @cached_property
    def po_item(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("purchase_order_id"),
            F.col("l_partkey").alias("fsn"),
            F.col("l_quantity").alias("quantity"),
            F.floor(F.col("l_quantity") * F.col("l_discount")).cast("double").alias("cancel_quantity"),
        )

    @cached_property
    def po_raised(self) -> DataFrame:
        return warehouse.po_raised(self.po_header, self.po_item, PO_SINCE)

    @cached_property
    def po_lines(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "O", "approved")
            .when(F.col("o_orderstatus") == "F", "completed")
            .otherwise("cancelled")
        )
        short = F.floor(F.col("l_quantity") * F.col("l_discount")).cast("double")
        source = self.suppliers.select(F.col("fc_no").alias("l_suppkey"), "src_nation")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(source, "l_suppkey")
            .select(
                centre("src_nation").alias("po_oroginal_warehouse_id"),
                day_key("l_shipdate").alias("poi_updated_date_key"),
                day_key("o_orderdate").alias("poi_initiated_date_key"),
                day_key("o_orderdate").alias("po_created_date_key"),
                F.col("l_partkey").alias("fsn"),
                status.alias("poi_status"),
                F.col("l_quantity").alias("poi_ordered_quantity"),
                (F.col("l_quantity") - short).alias("poi_received_quantity"),
            )
        )

    @cached_property
    def po_receipts(self) -> DataFrame:
        return warehouse.po_receipts(self.po_lines, PO_SINCE)

    @cached_property
    def offer_fact(self) -> DataFrame:
        seller = self.suppliers.withColumnRenamed("fc_no", "l_suppkey")
        return self.lines(PERIOD.wk_start, PERIOD.wk_end).join(seller, "l_suppkey").select(
            F.col("l_partkey").alias("order_item_product_id"),
            F.col("l_quantity").alias("gross_units_per_offer"),
            (F.col("l_discount") >= 0.08).cast("int").alias("offer_flag"),
            "is_first_party_seller",
            day_key("l_shipdate").alias("date_dim_key"),
        )

    @cached_property
    def offer_units(self) -> DataFrame:
        return warehouse.offer_units(self.offer_fact, PERIOD)

    # --- lanes of the tiered fulfilment check -----------------------------

    @cached_property
    def lane_static(self) -> DataFrame:
        return (
            self.lzn_mapping.where(F.col("lzn_value") != "")
            .groupBy(F.col("src_pincode").alias("source_pincode"), "dest_pincode")
            .agg(F.min("lzn_value").alias("lzn"))
        )

    @cached_property
    def lane_source(self) -> DataFrame:
        return self.suppliers.select(
            F.col("src_nation").alias("source_pincode"), centre("src_nation").alias("source_id")
        ).distinct()

    @cached_property
    def lane_tier(self) -> DataFrame:
        tier = (F.col("source_pincode") + F.col("dest_pincode")) % 3
        return self.lane_static.select(
            centre("source_pincode").alias("warehouse"),
            "dest_pincode",
            F.concat(F.lit("T"), tier.cast("string")).alias("tier"),
            F.when(tier == 0, "INACTIVE").otherwise("ACTIVE").alias("tier_status"),
        )

    @cached_property
    def reco_file(self) -> DataFrame:
        q = F.col("l_quantity")
        source = self.suppliers.select(F.col("fc_no").alias("l_suppkey"), "src_nation")
        return self.table("lineitem").join(source, "l_suppkey").select(
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("reco_date"),
            F.col("l_partkey").alias("FSN"),
            centre("src_nation").alias("FC"),
            *[(q % (10 - k)).alias(f"Forecast_week_{k}") for k in range(1, 5)],
            (q - q % 5).alias("Qty.Recommended"),
            q.alias("Qty.Generated"),
        )

    # --- lookups --------------------------------------------------------------

    @cached_property
    def titles(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("fsn"), F.col("p_name").alias("title")
        )

    @cached_property
    def zones(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(F.col("n_nationkey").alias("dest_pincode"), F.col("r_name").alias("Zone"))

    @cached_property
    def lane_fcs(self) -> DataFrame:
        return self.preferred_wh.select(
            "dest_pincode", F.col("preferred_wh").alias("LZ-FC")
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock of a product and centre on the days it was seen in line items."""
        return self.table("lineitem").where(
            in_days("l_shipdate", PERIOD.wk_start, PERIOD.wk_end) & (F.col("l_returnflag") != "N")
        ).select(
            F.col("l_partkey").alias("fsn"),
            text("l_suppkey").alias("fc"),
            F.to_date("l_shipdate").alias("day"),
            (F.col("l_quantity") * 2 - 40).alias("inventory"),
        )

    @cached_property
    def earlier_inputs(self) -> EarlierInputs:
        return EarlierInputs(
            sales=self.sales_g1,
            lane_wide=self.lane_wide,
            tax_wide=self.tax_wide,
            vendor_wide=self.vendor_wide,
            u2s_wide=self.u2s_wide,
            leadtime_wide=self.leadtime_wide,
            cat_floor=self.cat_floor,
            preferred_wh=self.preferred_wh,
            exclusions=self.exclusions_g1,
            explain=self.explain_extract,
            lane_static=self.lane_static,
            lane_source=self.lane_source,
            lane_tier=self.lane_tier,
            reco_file=self.reco_file,
            po_raised=self.po_raised,
            po_receipts=self.po_receipts,
            offers=self.offer_units,
            low_sale=self.low_sale,
        )

    @cached_property
    def earlier(self) -> EarlierRun:
        return EarlierRun(self.earlier_inputs, PERIOD)

    @cached_property
    def earlier_staged(self) -> EarlierRun:
        return EarlierRun(self.staged().earlier_inputs, PERIOD, stage=stage)
