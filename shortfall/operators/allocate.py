"""Pool of unexplained national units, its split over centres, and the cascade."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.functions.nulls import excess, fill_zero, strict_greatest, strict_least, strict_sum
from shortfall.functions.nulls import sum_or_zero, zero
from shortfall.operators import centres
from shortfall.operators.placement import PLACEMENT_LOSSES
from shortfall.operators.relational import join_chain, union_ragged

PAIR = ["fsn", "dest_pincode"]

#: Cause, the column that holds its issue, in the order the causes are served.
CAUSES = [
    ("forecast_loss", "forecast_issue"),
    ("ndoh_loss", "ndoh_issue"),
    ("ipc_override_loss", "ipc_override_issue"),
    ("cdo_override_loss", "cdo_override_issue"),
    ("po_loss", "po_issue"),
    ("vendor_adherence_loss", "vendor_adherence_issue"),
]
CASCADE_LOSSES = [name for name, _ in CAUSES]


def unblocked_sales(sales_fsn_dp_fc: DataFrame, blocked: DataFrame) -> DataFrame:
    """Sales by centre of the pairs where placement was possible."""
    return sales_fsn_dp_fc.join(blocked.select(*PAIR), PAIR, "left_anti")


def unblocked_pairs(placement: DataFrame) -> DataFrame:
    """National units of the pairs where placement was possible, from the placement table."""
    is_blocked = F.coalesce(F.col("placement_loss") > 0, F.lit(False))
    return placement.where(~is_blocked).select(*PAIR, "nat_sales")


def fe_loss(unblocked: DataFrame, fe_issue: DataFrame) -> DataFrame:
    """National units owed to the fulfilment engine, and the pool left per pair."""
    pool = unblocked.groupBy(*PAIR).agg(strict_sum("nat_sales").alias("nat_sales"))
    return fe_loss_of_pairs(pool, fe_issue)


def fe_loss_of_pairs(pool: DataFrame, fe_issue: DataFrame) -> DataFrame:
    """``fe_loss`` where the national units are already one row per pair."""
    issue = zero(F.col("fe_issue").cast("double"))
    return (
        pool.join(fe_issue, PAIR, "left")
        .withColumn("fe_loss", strict_least(issue, F.col("nat_sales")))
        .withColumn("fsn_dp_loss", excess("nat_sales", "fe_loss"))
        .select(*PAIR, "nat_sales", "fe_loss", "fsn_dp_loss")
    )


def fc_split_ratio(supplied: DataFrame, strict_fanout: bool = False) -> DataFrame:
    """Equal share of each supplied centre in its pair.

    A product sold under several brands has its centres once here; with
    ``strict_fanout`` once per brand, each with the full share.
    """
    usable = supplied.where(F.col("vendor_count") > 0)
    if strict_fanout:
        counts = usable.groupBy(*PAIR).agg(F.count_distinct("fc").alias("fc_count"))
        shared = usable.select(*PAIR, "fc").join(counts, PAIR)
    else:
        # one exchange by pair serves the distinct, the count and later joins by
        # pair; the centres of a pair are bounded by the lanes of its destination
        by_pair = usable.select(*PAIR, "fc").repartition(*PAIR)
        shared = by_pair.distinct().withColumn(
            "fc_count", F.count("*").over(Window.partitionBy(*PAIR))
        )
    return shared.select(*PAIR, "fc", (F.lit(1.0) / F.col("fc_count")).alias("ratio"))


def allocate_to_fc(ratio: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """The pool of each pair split over its centres; missing where the pair has no pool.

    Without ``pool`` the ratio has the pool already, from ``split_ratio_of_sets``.
    """
    if pool is not None:
        ratio = ratio.join(pool.select(*PAIR, "fsn_dp_loss"), PAIR, "left")
    return ratio.withColumn("fsn_dp_fc_loss", F.col("ratio") * F.col("fsn_dp_loss"))


def allocate_pool(ratio: DataFrame, pool: DataFrame) -> DataFrame:
    """``allocate_to_fc`` without the rows that have nothing to allocate."""
    open_pool = pool.where(F.col("fsn_dp_loss") > 0).select(*PAIR, "fsn_dp_loss")
    return ratio.join(open_pool, PAIR).withColumn(
        "fsn_dp_fc_loss", F.col("ratio") * F.col("fsn_dp_loss")
    )


def cascade(
    df: DataFrame,
    pool: str,
    causes: Sequence[tuple[str, str] | tuple[str, str, str]],
    residual: str = "residual",
) -> DataFrame:
    """Serve the causes from a pool in order; what is left is the residual.

    A cause is ``(name, issue column)`` and takes up to its issue, or
    ``(name, flag column, "all_if_flag")`` and takes everything left where the
    flag is 1. Issues must not be null. The result is one projection.
    """
    left = F.col(pool)
    for name, issue, *kind in causes:
        if kind == ["all_if_flag"]:
            taken = F.when(F.col(issue) == 1, left).otherwise(F.lit(0.0))
        else:
            taken = strict_least(left, F.col(issue))
        df = df.withColumn(name, taken)
        df = df.withColumn("__left", strict_greatest(left - F.col(name), F.lit(0.0)))
        left = F.col("__left")
    return df.withColumn(residual, left).drop("__left")


def issues_by_fc(
    forecast: DataFrame, overrides: DataFrame, adherence: DataFrame
) -> DataFrame:
    """All issues per product and centre in one table, so the pool is joined once."""
    keys = ["fsn", "fc"]
    columns = [issue for _, issue in CAUSES]
    parts = union_ragged(
        forecast.select(*keys, "forecast_issue"),
        overrides.select(*keys, *columns[1:5]),
        adherence.select(*keys, "vendor_adherence_issue"),
    )
    return parts.groupBy(*keys).agg(*[sum_or_zero(c).alias(c) for c in columns])


def cascade_issues(allocated: DataFrame, issues: DataFrame) -> DataFrame:
    """``cascade_losses`` from the one table of ``issues_by_fc``."""
    joined = allocated.join(issues, ["fsn", "fc"], "left")
    filled = fill_zero(joined, ["fsn_dp_loss", "fsn_dp_fc_loss", *[i for _, i in CAUSES]])
    return cascade(filled, "fsn_dp_fc_loss", CAUSES)


def cascade_pairs(pool: DataFrame, supply: DataFrame, issues: DataFrame) -> DataFrame:
    """The cascade added up by pair, from the centres that have an issue.

    ``supply`` has the number of centres of each pair (``supply_of_pairs``),
    ``issues`` the issues at its centres (``supplied_issues``). Every centre
    has an equal share of the pool; the shares of centres without an issue are
    residual as a whole. ``fsn_dp_fc_loss`` is what was given out in all.
    """
    share = F.lit(1.0) / F.col("fc_count") * F.col("fsn_dp_loss")
    shared = (
        pool.where(F.col("fsn_dp_loss") > 0)
        .select(*PAIR, "fsn_dp_loss")
        .join(supply.where("fc_count > 0").select(*PAIR, "fc_count"), PAIR)
        .withColumn("fsn_dp_fc_loss", share)
    )
    joined = fill_zero(shared.join(issues, PAIR, "left"), [issue for _, issue in CAUSES])
    served = cascade(joined, "fsn_dp_fc_loss", CAUSES)
    has_issue = F.col("fc").isNotNull()
    untouched = F.max("fsn_dp_fc_loss") * (F.max("fc_count") - F.count("fc"))
    return served.groupBy(*PAIR).agg(
        (F.max("fsn_dp_fc_loss") * F.max("fc_count")).alias("fsn_dp_fc_loss"),
        *[sum_or_zero(c).alias(c) for c in CASCADE_LOSSES],
        (sum_or_zero(F.when(has_issue, F.col("residual"))) + untouched).alias("residual"),
    )


def cascade_of_supply(supply: DataFrame, cascaded: DataFrame) -> DataFrame:
    """The cascade of every supplied pair, those with nothing to allocate as zeros."""
    losses = [*CASCADE_LOSSES, "residual"]
    supplied = supply.where("fc_count > 0").select(*PAIR)
    joined = supplied.join(cascaded.select(*PAIR, *losses), PAIR, "left")
    return fill_zero(joined, losses)


def open_issues(issues: DataFrame) -> DataFrame:
    """Rows of ``issues_by_fc`` with an issue above zero."""
    return issues.where(" or ".join(f"{issue} > 0" for _, issue in CAUSES))


def cascade_losses(
    allocated: DataFrame, forecast: DataFrame, overrides: DataFrame, adherence: DataFrame
) -> DataFrame:
    """Split each centre's share of the pool over the planning and supply causes."""
    overs = [issue for _, issue in CAUSES[1:5]]
    collated = join_chain(
        allocated,
        [
            forecast.select("fsn", "fc", "forecast_issue"),
            overrides.select("fsn", "fc", *overs),
            adherence.select("fsn", "fc", "vendor_adherence_issue"),
        ],
        on=["fsn", "fc"],
    )
    filled = fill_zero(
        collated, ["fsn_dp_loss", "fsn_dp_fc_loss", *[issue for _, issue in CAUSES]]
    )
    return cascade(filled, "fsn_dp_fc_loss", CAUSES)


def cascade_of_sets(
    sets: DataFrame,
    near: DataFrame,
    pool: DataFrame,
    forecast: DataFrame,
    overrides: DataFrame,
    adherence: DataFrame,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``cascade_losses`` at every centre of the sets, from one row per product and centre of each issue.

    Centres with an issue are looked up in the sets; the others get no issue.
    All of these in a pair have the same cascade, so it is worked out once per
    pair, and they are made rows last. ``finish`` works on the cascades before that.
    """
    issues = open_issues(issues_by_fc(forecast, overrides, adherence))
    columns = [issue for _, issue in CAUSES]
    at = centres.issues_at_sets(sets, near, issues)
    shares = centres.shares_of_sets(sets).join(pool.select(*PAIR, "fsn_dp_loss"), PAIR, "left")
    pools = ["fsn_dp_loss", "fsn_dp_fc_loss"]

    def served(allocated: DataFrame) -> DataFrame:
        return finish(cascade(fill_zero(allocated, [*pools, *columns]), "fsn_dp_fc_loss", CAUSES))

    met = served(allocate_to_fc(at.join(shares, PAIR)))
    alone = allocate_to_fc(shares).withColumns({c: F.lit(0.0) for c in columns})
    rest = centres.rows_but(sets, near, at, served(alone))
    # a pair without a product has no share, and so no loss
    return met.unionByName(fill_zero(rest, [*pools, *columns, *CASCADE_LOSSES, "residual"]))


def issue_combinations(
    forecast: DataFrame, overrides: DataFrame, adherence: DataFrame
) -> DataFrame:
    """The issues of each product and centre, a row for every combination of the three tables' rows.

    What ``cascade_losses`` joins to a centre of a pair when the tables have
    several rows per product and centre. ``first`` marks one row of each. Left
    out are products and centres with a single combination that has no issue.
    """
    keys, columns = ["fsn", "fc"], [issue for _, issue in CAUSES]
    combined = (
        forecast.select(*keys, "forecast_issue")
        .join(overrides.select(*keys, *columns[1:5]), keys, "full")
        .join(adherence.select(*keys, "vendor_adherence_issue"), keys, "full")
        .dropna(subset=keys)
    )
    group = Window.partitionBy(*keys)
    numbered = fill_zero(combined, columns).withColumns(
        {
            "first": F.row_number().over(group.orderBy(*columns)) == 1,
            "__rows": F.count(F.lit(1)).over(group),
        }
    )
    return numbered.where(" or ".join(["__rows > 1", *[f"{c} <> 0" for c in columns]])).drop("__rows")


def cascade_fanout(pool: DataFrame, supply: DataFrame, issues: DataFrame) -> DataFrame:
    """``cascade_losses`` with literal fan-outs added up by pair, from the rows that have an issue.

    ``supply`` has the centres of each pair (``fc_count``) and the rows of
    ``supplied_fcs`` for it (``fc_rows``), each with a full share of the pool.
    ``issues`` are the rows of ``issue_combinations`` at these
    (``supplied_rows_at``). The shares of all other rows are residual.
    ``fsn_dp_fc_loss`` is what was given out in all.
    """
    shared = (
        pool.where(F.col("fsn_dp_loss") > 0)
        .select(*PAIR, "fsn_dp_loss")
        .join(supply.where("fc_rows > 0").select(*PAIR, "fc_count", "fc_rows"), PAIR)
        .withColumn("fsn_dp_fc_loss", F.lit(1.0) / F.col("fc_count") * F.col("fsn_dp_loss"))
    )
    joined = shared.join(issues, PAIR, "left")
    filled = fill_zero(joined, [issue for _, issue in CAUSES])
    served = cascade(filled, "fsn_dp_fc_loss", CAUSES)
    has_issue = F.col("fc").isNotNull()
    untouched = F.max("fsn_dp_fc_loss") * (F.max("fc_rows") - F.count_if(has_issue & F.col("first")))
    return served.groupBy(*PAIR).agg(
        (sum_or_zero(F.when(has_issue, F.col("fsn_dp_fc_loss"))) + untouched).alias("fsn_dp_fc_loss"),
        *[sum_or_zero(c).alias(c) for c in CASCADE_LOSSES],
        (sum_or_zero(F.when(has_issue, F.col("residual"))) + untouched).alias("residual"),
    )


def cascade_by_destination(cascaded: DataFrame) -> DataFrame:
    return cascaded.groupBy(*PAIR).agg(
        *[sum_or_zero(c).alias(c) for c in [*CASCADE_LOSSES, "residual"]]
    )


def combine_losses(blocked: DataFrame, fe: DataFrame, by_destination: DataFrame) -> DataFrame:
    """All causes per pair, from tables that each hold some of them."""
    parts = union_ragged(
        blocked.select(*PAIR, *PLACEMENT_LOSSES), fe.select(*PAIR, "fe_loss"), by_destination
    )
    return parts.groupBy(*PAIR).agg(
        *[
            sum_or_zero(c).alias(c)
            for c in [*PLACEMENT_LOSSES, "fe_loss", *CASCADE_LOSSES, "residual"]
        ]
    )


def losses_of_pairs(
    placement: DataFrame, pool: DataFrame, by_destination: DataFrame
) -> DataFrame:
    """``combine_losses`` where each table has one row per pair and the placement
    table holds all pairs: two joins by pair instead of a union and a regrouping."""
    is_blocked = F.coalesce(F.col("placement_loss") > 0, F.lit(False))
    blocked = placement.select(
        *PAIR, *[F.when(is_blocked, F.col(c)).otherwise(0.0).alias(c) for c in PLACEMENT_LOSSES]
    )
    joined = join_chain(blocked, [pool.select(*PAIR, "fe_loss"), by_destination], PAIR)
    return fill_zero(joined, [*PLACEMENT_LOSSES, "fe_loss", *CASCADE_LOSSES, "residual"])


def exclusion_after_fe(
    pool: DataFrame, fe_issue: DataFrame, exclusions: DataFrame
) -> DataFrame:
    """Variant that books exclusions after the fulfilment engine instead of before placement."""
    excluded = F.coalesce(F.col("is_excluded"), F.lit(0)) == 1
    return (
        pool.select(*PAIR, "nat_sales")
        .join(fe_issue, PAIR, "left")
        .join(exclusions, "fsn", "left")
        .withColumn("fe_loss", zero(F.col("fe_issue").cast("double")))
        .withColumn(
            "exclusion_loss",
            F.when(excluded, F.col("nat_sales") - F.col("fe_loss")).otherwise(F.lit(0.0)),
        )
        .withColumn("fsn_dp_loss", F.col("nat_sales") - F.col("fe_loss") - F.col("exclusion_loss"))
        .select(*PAIR, "nat_sales", "fe_loss", "exclusion_loss", "fsn_dp_loss")
    )
