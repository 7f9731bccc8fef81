"""Causes that make a local or zonal placement impossible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.functions.nulls import fill_zero, null_safe_join, strict_sum
from shortfall.operators.centres import at_near, centre_sets, counts_of_sets, issues_at_sets, near_centres
from shortfall.operators.prepare import NEAR_LANES
from shortfall.operators.relational import salted_join

SOLD_PAIR = ["fsn", "dest_pincode", "brand", "vertical"]
PLACEMENT_LOSSES = ["serviceability_loss", "vendor_loss", "low_sale_depth_loss", "exclusion_loss"]


def serviceability(lanes: DataFrame) -> DataFrame:
    """Near fulfilment centres per destination, and whether there is any.

    A near lane without a centre counts as one more centre.
    """
    is_near = F.col("lzn_value").isin(*NEAR_LANES)
    unnamed = F.max((is_near & F.col("fc").isNull()).cast("int"))
    return (
        lanes.groupBy("dest_pincode")
        .agg((F.count_distinct(F.when(is_near, F.col("fc"))) + unnamed).alias("lz_fc_count"))
        .withColumn("is_serviceable", (F.col("lz_fc_count") > 0).cast("int"))
    )


def sold_pairs(sales: DataFrame) -> DataFrame:
    return sales.select(*SOLD_PAIR).distinct()


def _near_fcs(lanes: DataFrame) -> DataFrame:
    return (
        lanes.where(F.col("lzn_value").isin(*NEAR_LANES)).select("dest_pincode", "fc").distinct()
    )


def candidate_fcs(
    pairs: DataFrame, lanes: DataFrame, fsn_vendors: DataFrame, brand_vendors: DataFrame
) -> DataFrame:
    """Every near fulfilment centre of every sold pair with its vendor counts.

    This is the full grain, candidates without vendors included. The run itself
    uses ``supplied_fcs``, which builds only the candidates that have one.
    """
    brand = ["brand", "vertical", "dest_pincode"]
    near = _near_fcs(lanes)
    of_brand = (
        salted_join(pairs.select(*brand).distinct(), near, ["dest_pincode"], ["brand", "vertical"])
        .join(brand_vendors, ["brand", "vertical", "fc"], "left")
    )
    own = at_near(pairs, fsn_vendors, ["fsn"], near)
    own = own.join(brand_vendors, ["brand", "vertical", "fc"], "left")
    counted = own.unionByName(_brand_rows_but(pairs, of_brand, own), allowMissingColumns=True)
    return fill_zero(counted, ["fsn_vendor_count", "brand_vendor_count"]).select(
        *SOLD_PAIR,
        "fc",
        "fsn_vendor_count",
        "brand_vendor_count",
        (F.col("fsn_vendor_count") + F.col("brand_vendor_count")).alias("vendor_count"),
    )


def _brand_rows_but(pairs: DataFrame, of_brand: DataFrame, own: DataFrame) -> DataFrame:
    """The centres of its brand at each pair but for those of ``own``, by pair and centre.

    Made last: the centres of ``own`` come to the pair as a list, so that no
    exchange follows in which there is one row per pair and centre.
    """
    taken = own.groupBy(*SOLD_PAIR).agg(F.collect_set("fc").alias("__taken"))
    listed = null_safe_join(pairs, taken, [(c, c) for c in SOLD_PAIR])
    brand = [c for c in SOLD_PAIR if c != "fsn"]
    rows = null_safe_join(listed, of_brand, [(c, c) for c in brand], "inner")
    return rows.where(~F.coalesce(F.array_contains("__taken", F.col("fc")), F.lit(False))).drop("__taken")


def supplied_fcs(
    pairs: DataFrame, lanes: DataFrame, fsn_vendors: DataFrame, brand_vendors: DataFrame
) -> DataFrame:
    """The candidates with at least one vendor.

    Built from the vendor side: a product meets the centres it is supplied at,
    and the centres a brand is supplied at are worked out once per destination,
    not once per product. The lane check only thins them out, so the work
    follows the number of supplied candidates, not pairs times lanes. A brand
    that dominates a destination makes its join partition large on the side of
    the pairs, which adaptive execution splits.
    """
    near = _near_fcs(lanes)
    of_brand = pairs.select("brand", "vertical", "dest_pincode").distinct()
    brand_fcs = at_near(of_brand, brand_vendors, ["brand", "vertical"], near)
    own = at_near(pairs, fsn_vendors, ["fsn"], near).join(brand_vendors, ["brand", "vertical", "fc"], "left")
    found = own.unionByName(_brand_rows_but(pairs, brand_fcs, own), allowMissingColumns=True)
    count = F.coalesce("fsn_vendor_count", F.lit(0)) + F.coalesce("brand_vendor_count", F.lit(0))
    return found.select(*SOLD_PAIR, "fc", count.alias("vendor_count"))


def supplied_row_counts(
    pairs: DataFrame, near: DataFrame, fsn_vendors: DataFrame, brand_vendors: DataFrame
) -> DataFrame:
    """How many rows (``fc_rows``) ``supplied_fcs`` has for each product and destination, without making them.

    A product sold under several brands has a centre once per brand that it is
    supplied for. ``near`` are the rows of ``near_centres``. The centres of a
    brand are counted once per destination; a pair adds those that only its
    own product is supplied at.
    """
    brand = ["brand", "vertical"]
    of_brand = (
        brand_vendors.join(near, "fc").groupBy(*brand, "dest_pincode").agg(F.count(F.lit(1)).alias("brand_rows"))
    )
    own = (
        at_near(pairs, fsn_vendors.select("fsn", "fc"), ["fsn"], near.select("dest_pincode", "fc"))
        .join(brand_vendors.select(*brand, "fc"), [*brand, "fc"], "left_anti")
        .groupBy(*SOLD_PAIR)
        .agg(F.count(F.lit(1)).alias("own_rows"))
    )
    counted = pairs.join(own, SOLD_PAIR, "left").join(of_brand, [*brand, "dest_pincode"], "left")
    rows = F.coalesce("own_rows", F.lit(0)) + F.coalesce("brand_rows", F.lit(0))
    return counted.groupBy("fsn", "dest_pincode").agg(F.sum(rows).alias("fc_rows")).where("fc_rows > 0")


def supplied_rows_at(
    pairs: DataFrame, near: DataFrame, fsn_vendors: DataFrame, brand_vendors: DataFrame, at: DataFrame
) -> DataFrame:
    """The rows of ``at`` (product, centre) at each row of ``supplied_fcs`` with that product and centre.

    As (fsn, dest_pincode, fc, further columns of ``at``), once per brand the
    pair is supplied for there. No centre beyond those of ``at`` is looked at.
    """
    brand = ["brand", "vertical"]
    of_fsn = fsn_vendors.select("fsn", "fc", F.lit(True).alias("__by_fsn"))
    of_brand = brand_vendors.select(*brand, "fc", F.lit(True).alias("__by_brand"))
    issues = at.join(of_fsn, ["fsn", "fc"], "left")
    met = (
        at_near(pairs, issues, ["fsn"], near.select("dest_pincode", "fc"))
        .join(of_brand, [*brand, "fc"], "left")
    )
    rest = [c for c in at.columns if c not in ("fsn", "fc")]
    return met.where("__by_fsn or __by_brand").select("fsn", "dest_pincode", "fc", *rest)


def supply_of_pairs(
    pairs: DataFrame, lanes: DataFrame, fsn_vendors: DataFrame, brand_vendors: DataFrame
) -> DataFrame:
    """Vendors and supplying centres of each product and destination, as numbers only.

    The same numbers as counting ``supplied_fcs`` by pair, from bitmaps of the
    centres (``centre_sets``) instead of its rows.
    """
    return supply_of_sets(
        pairs, centre_sets(pairs, near_centres(lanes), fsn_vendors, brand_vendors)
    )


def supply_of_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``supply_of_pairs`` from the sets of ``centre_sets``; pairs without a centre have zeros."""
    every = pairs.select("fsn", "dest_pincode").distinct()
    counted = every.join(counts_of_sets(sets), ["fsn", "dest_pincode"], "left")
    return fill_zero(counted, ["vendor_count", "fc_count"])


def supplied_issues(
    pairs: DataFrame,
    lanes: DataFrame,
    fsn_vendors: DataFrame,
    brand_vendors: DataFrame,
    issues: DataFrame,
) -> DataFrame:
    """The rows of ``issues`` (product, centre) at each destination the centre supplies."""
    near = near_centres(lanes)
    return issues_at_sets(centre_sets(pairs, near, fsn_vendors, brand_vendors), near, issues)


def vendor_availability(
    pairs: DataFrame, serviceable: DataFrame, supplied: DataFrame
) -> DataFrame:
    """Vendors per product and destination over all near centres, zero included.

    ``supplied`` is ``supply_of_pairs`` or, at full grain, ``supplied_fcs``.
    """
    reachable = pairs.select("fsn", "dest_pincode").distinct().join(
        serviceable.where("is_serviceable = 1").select("dest_pincode"), "dest_pincode", "left_semi"
    )
    counts = supplied.groupBy("fsn", "dest_pincode").agg(
        F.sum("vendor_count").alias("vendor_count")
    )
    return (
        reachable.join(counts, ["fsn", "dest_pincode"], "left")
        .fillna(0, subset=["vendor_count"])
        .withColumn("is_vendor_avl", (F.col("vendor_count") > 0).cast("int"))
    )


def low_sales_depth(
    sales_raw: DataFrame,
    min_sale_threshold: DataFrame,
    period: Period,
    inclusive: bool = True,
    days: int = 28,
) -> DataFrame:
    """Products whose sales in the weeks before the period stay within their threshold.

    ``inclusive=False`` keeps only those strictly below it.
    """
    history = sales_raw.where(
        (F.col("day") < F.lit(period.wk_start))
        & (F.col("day") >= F.lit(period.shift("wk_start", -days)))
    )
    depth = (
        history.groupBy("fsn", "category")
        .agg(strict_sum("sales").alias("sales"))
        .join(min_sale_threshold, "category", "left")
        .fillna(0, subset=["min_sales_depth"])
    )
    sales, limit = F.col("sales"), F.col("min_sales_depth")
    return depth.where(sales <= limit if inclusive else sales < limit).select(
        "fsn", "category", "sales", "min_sales_depth"
    )


def low_sale_products(pairs: DataFrame, low_sales: DataFrame) -> DataFrame:
    """Sold products with low sales depth in any of their categories."""
    return (
        low_sales.select("fsn")
        .distinct()
        .join(pairs.select("fsn").distinct(), "fsn", "left_semi")
        .withColumn("low_sale_flag", F.lit(1))
    )


def placement_losses(
    sales_fsn_dp: DataFrame,
    serviceable: DataFrame,
    vendor_avl: DataFrame,
    low_products: DataFrame,
    exclusions: DataFrame,
) -> DataFrame:
    """National units of each product and destination by the reason no placement was possible."""
    flags = ["is_serviceable", "is_vendor_avl", "low_sale_flag", "is_excluded"]
    # the pair-level join comes first: both sides are already partitioned by pair
    flagged = sales_fsn_dp.join(
        vendor_avl.select("fsn", "dest_pincode", "is_vendor_avl"), ["fsn", "dest_pincode"], "left"
    )
    flagged = salted_join(
        flagged,
        serviceable.select("dest_pincode", "is_serviceable"),
        on=["dest_pincode"],
        spread_by=["fsn"],
        how="left",
    )
    flagged = flagged.join(low_products.select("fsn", "low_sale_flag"), "fsn", "left").join(
        exclusions.select("fsn", "is_excluded"), "fsn", "left"
    )
    served, vendored, low, excluded = (F.col(c) == 1 for c in flags)
    nat = F.col("nat_sales")
    none = F.lit(0.0)

    def units(claimed):
        return F.when(claimed, nat).otherwise(none)

    # each cause takes all national units of a pair unless an earlier one has them
    return (
        fill_zero(flagged, flags)
        .withColumns(
            {
                "serviceability_loss": units(~served),
                "vendor_loss": units(served & ~vendored),
                "low_sale_depth_loss": units(served & vendored & low),
                "exclusion_loss": units(served & vendored & ~low & excluded),
                "placement_loss": units(~(served & vendored & ~low & ~excluded)),
            }
        )
        .select(*sales_fsn_dp.columns, *flags, *PLACEMENT_LOSSES, "placement_loss")
    )


def placement_blocked(placement: DataFrame) -> DataFrame:
    """Products and destinations that lost units to placement."""
    return placement.where(F.col("placement_loss") > 0)


def loss_share_pct(placement: DataFrame) -> DataFrame:
    """Units and share of all sales per placement cause, one row."""
    total = F.sum("sales")
    cols = [*PLACEMENT_LOSSES, "placement_loss"]
    return placement.agg(
        total.alias("sales"),
        *[F.sum(c).alias(c) for c in cols],
        *[
            F.round(F.sum(c) / total * 100, 5 if c == "exclusion_loss" else 2).alias(f"{c}_pct")
            for c in cols
        ],
    )
