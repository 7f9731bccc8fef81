"""The final table: sales, regional and national units, and every cause."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.functions.nulls import excess, fill_zero, strict_least, zero
from shortfall.operators.allocate import CASCADE_LOSSES, PAIR
from shortfall.operators.placement import PLACEMENT_LOSSES
from shortfall.operators.prepare import HIERARCHY
from shortfall.operators.relational import totals
from shortfall.operators.skew import HeavyKeys, heavy_join, heavy_keys

LOSSES = [*PLACEMENT_LOSSES, "fe_loss", *CASCADE_LOSSES, "promotions_loss", "residual"]
MEASURES = ["sales", "ru_sales", "nat_sales", "unmapped_sales", *LOSSES]


def promotions_loss(losses: DataFrame, offers: DataFrame, mode: str = "excess") -> DataFrame:
    """Take units on offer out of the residual.

    ``excess``: promotions get what of the residual goes beyond the offer units.
    ``capped``: promotions get the residual up to the offer units.
    """
    joined = losses.join(offers, PAIR, "left").withColumn("offer_sales", zero("offer_sales"))
    if mode == "excess":
        promo = excess("residual", "offer_sales")
    elif mode == "capped":
        on_offer = strict_least("residual", "offer_sales")
        promo = F.when(F.col("offer_sales") > 0, on_offer).otherwise(F.lit(0.0))
    else:
        raise ValueError("mode must be excess or capped")
    return joined.withColumn("promotions_loss", promo).withColumn(
        "residual", excess("residual", "promotions_loss")
    )


def waterfall_detail(by_hierarchy: DataFrame, losses: DataFrame, period: Period) -> DataFrame:
    """Sales of each product, hierarchy and destination with all causes.

    Losses are known per product and destination. A product listed under
    several hierarchies repeats them; ``reconcile`` shows the difference.
    """
    joined = by_hierarchy.join(losses.select(*PAIR, *LOSSES), PAIR, "left").withColumn(
        "unmapped_sales", F.col("sales") - F.col("ru_sales") - F.col("nat_sales")
    )
    return fill_zero(joined, MEASURES).select(
        *PAIR,
        *HIERARCHY,
        F.lit(period.week).alias("ru_computed_week"),
        F.lit(period.year).alias("ru_year"),
        F.lit(period.start_key).alias("week_start_date_key"),
        *MEASURES,
    )


def waterfall_totals(detail: DataFrame, period: Period) -> DataFrame:
    return totals(detail, MEASURES).withColumn("ru_computed_week", F.lit(period.week))


def attach_keys(
    detail: DataFrame,
    sales: DataFrame,
    preferred_warehouse: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Add the warehouse keys of product and destination and the preferred centres.

    A destination may hold most of the rows: heavy ones are spread by product.
    They are counted in ``detail`` unless ``heavy`` names those of ``sales``.
    """
    products = sales.select("fsn", "product_id_key").distinct()
    destinations = sales.select("dest_pincode", "destination_pincode_key").distinct()
    preferred = preferred_warehouse.select(
        F.col("pincode").alias("dest_pincode"),
        F.col("preferred_fc_non_large").alias("preferred_fc"),
    )
    place, spread = ["dest_pincode"], [c for c in ["fsn", *HIERARCHY] if c in detail.columns]
    heavy = heavy or heavy_keys(detail, place)
    keyed = detail.join(products, "fsn", "left")
    keyed = heavy_join(keyed, destinations, place, spread, "left", heavy)
    return heavy_join(keyed, preferred, place, spread, "left", heavy)
