"""Placement flags from wide matrices with one column per centre or lane slot.

The number of centres is the number of columns, so the per-pair fan-out over
centres is bounded by the width of the inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.functions.text import to_number
from shortfall.operators.prepare import NEAR_LANES
from shortfall.operators.relational import (
    columns_like,
    count_where_in,
    wide_to_long,
)
from shortfall.operators.skew import HeavyKeys, heavy_join, heavy_keys_of

DEST = "Destination_Pincode"
PAIR = ["fsn", "dest_pincode"]

# Marks of an unused lane slot, and the reasons a centre is
# closed for a product from weakest to strongest.
UNUSED_SLOT = ["", "0"]
LOSS_RANK = ["N", "tax", "u2s", "vendor"]


def lane_slots(lane_wide: DataFrame) -> DataFrame:
    """Destination and its near lane slots; unused slots are blank."""
    slots = columns_like(lane_wide, prefixes=NEAR_LANES)
    return lane_wide.select(
        DEST, *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in slots]
    ).distinct()


def fc_available_flag(lane_wide: DataFrame) -> DataFrame:
    """Whether a destination uses any near lane slot."""
    slots_table = lane_slots(lane_wide)
    slots = [c for c in slots_table.columns if c != DEST]
    return slots_table.select(
        DEST, count_where_in([f"`{c}`" for c in slots], UNUSED_SLOT).alias("blank_slots")
    ).withColumn("fc_available_flag", (F.col("blank_slots") != len(slots)).cast("int"))


def lane_unpivot(lane_wide: DataFrame) -> DataFrame:
    """One row per destination and used lane slot."""
    return wide_to_long(lane_slots(lane_wide), [DEST], "lzn", "FC").where(
        ~F.col("FC").isin(*UNUSED_SLOT)
    )


def tax_unpivot(tax_wide: DataFrame, sold: DataFrame, tax_enabled: bool = True) -> DataFrame:
    """Closed centres per sold product for tax reasons.

    A product open at every centre has no closed one and drops out by itself.
    ``tax_enabled=False`` treats every centre as open.
    """
    sold_products = sold.select(F.col("fsn").alias("FSN")).distinct()
    closed = wide_to_long(tax_wide, ["FSN"], "FC", "tax_flg").where("tax_flg <> 1")
    closed = closed.join(sold_products, "FSN", "left_semi")
    return closed if tax_enabled else closed.where(F.lit(False))


def vendor_unpivot(vendor_wide: DataFrame) -> DataFrame:
    """Vendor flag per upper-case brand, vertical, category and centre."""
    long = wide_to_long(
        vendor_wide.withColumnRenamed("Brand", "brand"),
        ["brand", "Vertical", "Category"],
        "FC",
        "vendor_flag",
    )
    return long.withColumn("brand", F.upper("brand"))


def u2s_unpivot(u2s_wide: DataFrame) -> DataFrame:
    """Stock-transfer flag per brand, hierarchy and centre."""
    return wide_to_long(
        u2s_wide, ["brand", "vertical", "super_category", "category"], "FC", "u2s_flag"
    )


def heavy_of_pairs(pairs: DataFrame) -> list[HeavyKeys]:
    """Heavy destinations and brands of the sold pairs, as ``placement_matrix`` joins them; one pass."""
    keys = [["dest_pincode"], ["brand", "vertical"], ["brand_upper", "vertical"]]
    return heavy_keys_of(pairs.withColumn("brand_upper", F.upper("brand")), keys)


def placement_matrix(
    pairs: DataFrame,
    lanes: DataFrame,
    tax: DataFrame,
    u2s: DataFrame,
    vendor: DataFrame,
    strict_fanout: bool = False,
    heavy: Sequence[HeavyKeys] | None = None,
) -> DataFrame:
    """Flags of every near centre of every sold pair; a centre nobody lists is open.

    The flag tables are finer than the join keys. A centre counts as open if any
    of its rows says so, hence they are reduced to the best flag per key first;
    ``strict_fanout`` keeps one row per combination. Rows of heavy destinations
    and brands (``heavy_of_pairs``) are spread, and only the flags of these
    brands are repeated.
    """
    at_place, of_brand, of_upper = heavy or heavy_of_pairs(pairs)
    tax_flags = tax.select(F.col("FSN").alias("fsn"), "FC", to_number("tax_flg").alias("tax_flg"))
    u2s_flags = u2s.select("brand", "vertical", "FC", to_number("u2s_flag").alias("u2s_flag"))
    vendor_flags = vendor.select(
        F.col("brand").alias("brand_upper"),
        F.col("Vertical").alias("vertical"),
        "FC",
        to_number("vendor_flag").alias("vendor_flag"),
    )
    if not strict_fanout:
        u2s_flags = u2s_flags.groupBy("brand", "vertical", "FC").agg(
            F.max("u2s_flag").alias("u2s_flag")
        )
        vendor_flags = vendor_flags.groupBy("brand_upper", "vertical", "FC").agg(
            F.max("vendor_flag").alias("vendor_flag")
        )
    per_dest = lanes.withColumnRenamed(DEST, "dest_pincode")
    at_fc = heavy_join(pairs, per_dest, ["dest_pincode"], ["fsn"], heavy=at_place)
    flagged = at_fc.join(tax_flags, ["fsn", "FC"], "left")
    flagged = heavy_join(flagged, u2s_flags, ["brand", "vertical", "FC"], PAIR, "left", of_brand)
    flagged = heavy_join(
        flagged.withColumn("brand_upper", F.upper("brand")),
        vendor_flags,
        ["brand_upper", "vertical", "FC"],
        PAIR,
        "left",
        of_upper,
    )
    flags = ["tax_flg", "u2s_flag", "vendor_flag"]
    tax_open, u2s_open, vendor_open = (F.col(c) != 0 for c in flags)
    return flagged.fillna(1.0, subset=flags).select(
        *pairs.columns,
        "FC",
        "lzn",
        *flags,
        (tax_open & u2s_open & vendor_open).cast("int").alias("placement_flag"),
    )


def _all_open():
    return (F.col("tax_flg") == 1) & (F.col("u2s_flag") == 1) & (F.col("vendor_flag") == 1)


def placement_ratio(matrix: DataFrame, strict_fanout: bool = False) -> DataFrame:
    """Equal share of every open centre of a pair.

    ``strict_fanout`` keeps one row per brand of the product.
    """
    keys = [*PAIR, "FC", "brand"] if strict_fanout else [*PAIR, "FC"]
    open_fcs = matrix.where(_all_open()).select(*keys).distinct()
    if strict_fanout:
        counts = open_fcs.groupBy(*PAIR).agg(F.count_distinct("FC").alias("fc_count"))
        shared = open_fcs.join(counts, PAIR)
    else:
        shared = open_fcs.withColumn("fc_count", F.count("*").over(Window.partitionBy(*PAIR)))
    return shared.select(*keys, (F.lit(1.0) / F.col("fc_count")).alias("ratio"))


def placement_loss_class(matrix: DataFrame) -> DataFrame:
    """Strongest reason per pair among those without any open centre."""
    tax, u2s, vendor = F.col("tax_flg"), F.col("u2s_flag"), F.col("vendor_flag")
    reason = (
        F.when(tax == 0, LOSS_RANK.index("tax"))
        .when((tax == 1) & (u2s == 0), LOSS_RANK.index("u2s"))
        .when((tax == 1) & (u2s == 1) & (vendor == 0), LOSS_RANK.index("vendor"))
        .otherwise(LOSS_RANK.index("N"))
    )
    per_pair = matrix.groupBy(*PAIR).agg(
        F.max(_all_open()).alias("any_open"), F.max(reason).alias("rank")
    )
    names = F.array(*[F.lit(name) for name in LOSS_RANK])
    return per_pair.where(~F.col("any_open")).select(*PAIR, F.get(names, F.col("rank")).alias("loss"))
