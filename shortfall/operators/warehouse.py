"""Extracts over warehouse facts and dimensions.

Each takes the tables as DataFrames (``spark.table`` or a file source), so
filters and column pruning reach the scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import Period, week_of_year
from shortfall.operators.relational import few_distinct

# Fixed values of the source systems: unit states that count as cancelled, the
# business unit with its own supply chain, the cancelled purchase-order state.
CANCELLED_UNITS = [
    "warehouse_cancellation_requested",
    "customer_cancelled",
    "procurement_cancellation_requested",
    "seller_cancelled",
]
LARGE_UNIT = "Large"
PO_CANCELLED = "cancelled"


def _key(d: dt.date) -> int:
    return int(d.strftime("%Y%m%d"))


def explain_extract(
    explain: DataFrame,
    units: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    period: Period,
    cancelled: Sequence[str] = tuple(CANCELLED_UNITS),
) -> DataFrame:
    """Fulfilment offers of first-party sellers in the period, small products only.

    Star join of the offer fact with unit, product and seller. Filters on the
    dimensions let Spark turn the outer joins into inner ones.
    """
    key = F.col("unit_reserve_actual_date_key")
    return (
        explain.where(key.between(_key(period.wk_start), _key(period.wk_end)))
        .join(units, F.col("fiu_id") == F.col("fulfill_item_unit_id"), "left")
        .join(products, F.col("product_id_key") == F.col("product_dim_key"), "left")
        .join(sellers, F.col("seller_id_key") == F.col("seller_dim_key"), "left")
        .where(
            ~F.col("fulfill_item_unit_status_modified").isin(*cancelled)
            & (F.col("is_first_party_seller") == 1)
            & (F.col("analytic_business_unit") != LARGE_UNIT)
        )
        .select(
            "fiu_id",
            F.col("warehouse").alias("source_id"),
            "lpe_tier",
            "effective_inventory",
            "accepted",
            F.col("fulfill_item_unit_destination_pincode").alias("dest_pincode"),
            F.col("product_id").alias("fsn"),
        )
    )


def low_sale_products_4wk(
    units: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    min_sale_depth: DataFrame,
    period: Period,
    cancelled: Sequence[str] = tuple(CANCELLED_UNITS),
    max_units: int = 30,
) -> DataFrame:
    """Products with few distinct first-party units in the four weeks to the period's end."""
    key = F.col("fulfill_item_unit_reserve_actual_date_key")
    hierarchy = {
        "product_id": "fsn",
        "analytic_vertical": "vertical",
        "analytic_sub_category": "sub_category",
        "analytic_category": "category",
        "analytic_super_category": "super_category",
        "analytic_business_unit": "bu",
        "title": "product_title",
        "brand": "brand",
    }
    sold = (
        units.where(
            (key > _key(period.shift("wk_end", -28)))
            & (key <= _key(period.wk_end))
            & ~F.col("fulfill_item_unit_status_modified").isin(*cancelled)
        )
        .join(sellers, F.col("seller_id_key") == F.col("seller_dim_key"), "left")
        .where(F.col("is_first_party_seller") == 1)
        .join(products, F.col("product_id_key") == F.col("product_dim_key"), "left")
    )
    groups = [F.col(c).alias(name) for c, name in hierarchy.items()]
    sold = few_distinct(sold, groups, "fulfill_item_unit_id", max_units, "sales")
    return sold.join(min_sale_depth, "category", "left").where(
        F.col("sales") < F.col("min_sales_depth")
    )


def po_raised(
    orders: DataFrame, items: DataFrame, since: dt.date, week_rule: str = "block"
) -> DataFrame:
    """Units on purchase orders that were not cancelled, per product, centre and week."""
    return (
        orders.where((F.to_date("created_at") >= F.lit(since)) & (F.col("status") != PO_CANCELLED))
        .join(items, F.col("id") == F.col("purchase_order_id"))
        .groupBy(
            "fsn",
            F.col("origin_warehouse_id").alias("FC"),
            week_of_year(F.to_date("created_at"), week_rule).alias("weeknum"),
        )
        .agg(F.sum(F.col("quantity") - F.col("cancel_quantity")).alias("total_po_raised_qty"))
    )


def po_receipts(po_lines: DataFrame, since: dt.date) -> DataFrame:
    """Ordered and received units per centre, dates, product and state."""
    return (
        po_lines.where(F.col("po_created_date_key") >= _key(since))
        .groupBy(
            F.col("po_oroginal_warehouse_id").alias("FC"),
            "poi_updated_date_key",
            "poi_initiated_date_key",
            "fsn",
            "poi_status",
        )
        .agg(
            F.sum("poi_ordered_quantity").alias("poi_ordered_quantity"),
            F.sum("poi_received_quantity").alias("poi_received_quantity"),
        )
    )


def offer_units(offers: DataFrame, period: Period) -> DataFrame:
    """Units sold on offer by first-party sellers per product in the period."""
    return (
        offers.where(
            (F.col("offer_flag") == 1)
            & (F.col("is_first_party_seller") == 1)
            & F.col("date_dim_key").between(_key(period.wk_start), _key(period.wk_end))
        )
        .groupBy(F.col("order_item_product_id").alias("fsn"))
        .agg(F.sum("gross_units_per_offer").alias("offer_sales"))
    )
