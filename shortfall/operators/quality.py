"""Checks that the parts add up, as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.functions.nulls import fill_zero, sum_or_zero
from shortfall.operators.allocate import CASCADE_LOSSES, PAIR
from shortfall.operators.centres import counts_of_sets, issues_at_sets
from shortfall.operators.relational import totals, union_ragged
from shortfall.operators.waterfall import LOSSES


def summary_checks() -> list[Column]:
    """The figures of ``scalar_summary`` that an observation can carry: all but the distinct count."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sum("sales").alias("sales"),
        F.sum("unmapped_sales").alias("unmapped_sales"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
    ]


def scalar_summary(sales: DataFrame) -> DataFrame:
    """Totals and counts looked at before a run is trusted."""
    return sales.agg(*summary_checks(), F.count_distinct("fc").alias("fc_count"))


def _column_sum(cols):
    return sum((F.coalesce(F.sum(c), F.lit(0.0)) for c in cols), F.lit(0.0))


def reconcile_checks() -> dict[str, list[Column]]:
    """The totals ``reconcile`` compares, by the table they come from.

    Observed on the writes of these tables they need no second pass
    (``reconcile_observed``).
    """
    is_blocked = F.coalesce(F.col("placement_loss") > 0, F.lit(False))
    nat = F.col("nat_sales")
    return {
        "placement": [
            sum_or_zero(nat).alias("national"),
            sum_or_zero(F.when(is_blocked, nat)).alias("blocked"),
            sum_or_zero(F.when(~is_blocked, nat)).alias("unblocked"),
            sum_or_zero("placement_loss").alias("placement_loss"),
        ],
        "pool": [
            sum_or_zero("fe_loss").alias("fe_loss"),
            sum_or_zero("fsn_dp_loss").alias("pool"),
        ],
        "cascaded": [
            sum_or_zero("fsn_dp_fc_loss").alias("allocated"),
            _column_sum([*CASCADE_LOSSES, "residual"]).alias("cascaded"),
        ],
        "detail": [_column_sum(LOSSES).alias("explained")],
    }


def reconcile(
    placement: DataFrame, pool: DataFrame, cascaded: DataFrame, detail: DataFrame
) -> DataFrame:
    """One row of totals that must agree, with the gaps between them."""
    tables = {"placement": placement, "pool": pool, "cascaded": cascaded, "detail": detail}
    parts = union_ragged(*[tables[name].agg(*checks) for name, checks in reconcile_checks().items()])
    # each total is present in exactly one of the four rows
    return _with_gaps(totals(parts, parts.columns))


def reconcile_observed(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``reconcile`` from the totals observed while the four tables were written."""
    missing = [name for name in reconcile_checks() if not metrics.get(name)]
    if missing:
        raise ValueError(f"no totals were observed for {', '.join(missing)}")
    found = {k: float(v) for name in reconcile_checks() for k, v in metrics[name].items()}
    return _with_gaps(spark.createDataFrame([tuple(found.values())], [*found]))


def _with_gaps(wide: DataFrame) -> DataFrame:
    return wide.select(
        "national", "blocked", "unblocked", "placement_loss", "fe_loss", "pool",
        "allocated", "cascaded", "explained",
        (F.col("blocked") + F.col("unblocked") - F.col("national")).alias("blocked_gap"),
        (F.col("fe_loss") + F.col("pool") - F.col("unblocked")).alias("fe_gap"),
        (F.col("allocated") - F.col("pool")).alias("allocation_gap"),
        (F.col("cascaded") - F.col("allocated")).alias("cascade_gap"),
        (F.col("explained") - F.col("national")).alias("explained_gap"),
    )


def allocation_gap(
    ratio: DataFrame, pool: DataFrame, unblocked: DataFrame, digits: int = 6
) -> DataFrame:
    """Pairs whose split loses part of the pool or whose sales have no centre in the split.

    ``ratio`` and ``unblocked`` are per product, destination and centre.
    """
    keys = [*PAIR, "fc"]
    matched = ratio.join(unblocked.select(*keys, F.col("nat_sales").alias("sold")), keys, "full")
    per_pair = matched.groupBy(*PAIR).agg(
        F.sum("ratio").alias("ratio_sum"),
        sum_or_zero(F.when(F.col("ratio").isNull(), F.col("sold"))).alias("unmatched_nat_sales"),
        F.count_if(F.col("ratio").isNull()).alias("unmatched_rows"),
    )
    return _gaps(per_pair, pool, digits)


def allocation_gap_of_sets(
    sets: DataFrame, near: DataFrame, pool: DataFrame, unblocked: DataFrame, digits: int = 6
) -> DataFrame:
    """``allocation_gap`` from sets of centres: only the centres with sales are looked up."""
    keys = [*PAIR, "fc"]
    sold = unblocked.select(*keys, F.col("nat_sales").alias("sold"))
    unmatched = (
        sold.join(issues_at_sets(sets, near, sold).select(*keys), keys, "left_anti")
        .groupBy(*PAIR)
        .agg(sum_or_zero("sold").alias("unmatched_nat_sales"), F.count("*").alias("unmatched_rows"))
    )
    ratio_sum = (F.lit(1.0) / F.col("fc_count") * F.col("fc_count")).alias("ratio_sum")
    per_pair = counts_of_sets(sets).select(*PAIR, ratio_sum).join(unmatched, PAIR, "full")
    return _gaps(fill_zero(per_pair, ["unmatched_nat_sales", "unmatched_rows"]), pool, digits)


def _gaps(per_pair: DataFrame, pool: DataFrame, digits: int) -> DataFrame:
    loss = F.coalesce(F.col("fsn_dp_loss"), F.lit(0.0))
    allocated = F.coalesce(F.col("ratio_sum"), F.lit(0.0)) * loss
    return (
        per_pair.join(pool.select(*PAIR, "fsn_dp_loss"), PAIR, "left")
        .withColumns({"fsn_dp_loss": loss, "allocated": allocated})
        .withColumn("gap", F.round(F.col("fsn_dp_loss") - F.col("allocated"), digits))
        .where((F.col("gap") > 0) | (F.col("unmatched_rows") > 0))
    )


def preferred_coverage(sales_fsn_dp: DataFrame, preferred: DataFrame) -> DataFrame:
    """Sales and destinations with and without a preferred centre, one row."""
    known = preferred.select("dest_pincode").distinct().withColumn("__known", F.lit(1))
    per_dest = (
        sales_fsn_dp.groupBy("dest_pincode")
        .agg(F.sum("sales").alias("sales"))
        .join(known, "dest_pincode", "full")
    )
    has = F.col("__known").isNotNull()
    sold = F.col("sales").isNotNull()
    return per_dest.agg(
        sum_or_zero("sales").alias("sales"),
        sum_or_zero(F.when(has, F.col("sales"))).alias("covered_sales"),
        sum_or_zero(F.when(~has, F.col("sales"))).alias("uncovered_sales"),
        F.count_if(sold).alias("sold_destinations"),
        F.count_if(has).alias("preferred_destinations"),
    )
