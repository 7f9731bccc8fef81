"""The earlier form of the weekly run: wide matrices, plan files, warehouse extracts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shortfall.functions.dates import Period
from shortfall.operators import legacy, matrix, prepare, skew
from shortfall.sources import files
from shortfall.sources.schemas import SCHEMAS

PRODUCT_COLUMNS = ["fsn", "bu", "super_category", "category", "sub_category", "vertical", "brand"]


@dataclass(frozen=True)
class EarlierInputs:
    sales: DataFrame
    lane_wide: DataFrame
    tax_wide: DataFrame
    vendor_wide: DataFrame
    u2s_wide: DataFrame
    leadtime_wide: DataFrame
    cat_floor: DataFrame
    preferred_wh: DataFrame
    exclusions: DataFrame
    explain: DataFrame
    lane_static: DataFrame
    lane_source: DataFrame
    lane_tier: DataFrame
    reco_file: DataFrame
    po_raised: DataFrame
    po_receipts: DataFrame
    offers: DataFrame
    low_sale: DataFrame


class EarlierRun:
    """All frames of one run; each is built once, on first use.

    ``stage`` works as in the weekly run; it is applied to the frames several
    branches need: sold pairs and their sales, placement matrix, blocked pairs, lead times and plan.
    """

    def __init__(
        self,
        inputs: EarlierInputs,
        period: Period,
        tax_enabled: bool = True,
        stage: Callable[[DataFrame, str], DataFrame] | None = None,
    ):
        self.inputs, self.period, self.tax_enabled = inputs, period, tax_enabled
        self._stage = stage or (lambda df, name: df)

    @cached_property
    def sales_fsn_dp(self) -> DataFrame:
        return self._stage(prepare.sales_by_fsn_dp(self.inputs.sales), "sales_fsn_dp")

    @cached_property
    def pairs(self) -> DataFrame:
        sold = self.inputs.sales.select("fsn", "dest_pincode", "brand", "bu", "category", "vertical")
        return self._stage(sold.distinct(), "sold_pairs")

    @cached_property
    def heavy(self) -> list[skew.HeavyKeys]:
        """Destinations and brands that hold much of the pairs; counted when first asked for."""
        return matrix.heavy_of_pairs(self.pairs)

    @cached_property
    def availability(self) -> DataFrame:
        return matrix.fc_available_flag(self.inputs.lane_wide)

    @cached_property
    def matrix(self) -> DataFrame:
        flags = matrix.placement_matrix(
            self.pairs,
            matrix.lane_unpivot(self.inputs.lane_wide),
            matrix.tax_unpivot(self.inputs.tax_wide, self.inputs.sales, self.tax_enabled),
            matrix.u2s_unpivot(self.inputs.u2s_wide),
            matrix.vendor_unpivot(self.inputs.vendor_wide),
            heavy=self.heavy,
        )
        return self._stage(flags, "matrix")

    @cached_property
    def ratio(self) -> DataFrame:
        return matrix.placement_ratio(self.matrix)

    @cached_property
    def loss_class(self) -> DataFrame:
        return matrix.placement_loss_class(self.matrix)

    @cached_property
    def blocked(self) -> DataFrame:
        blocked = legacy.blocked_losses(
            self.sales_fsn_dp, self.availability, self.loss_class, self.heavy[0]
        )
        return self._stage(blocked, "blocked")

    @cached_property
    def ff_issue(self) -> DataFrame:
        i = self.inputs
        return legacy.fe_issue_tiered(i.explain, i.lane_static, i.lane_source, i.lane_tier)

    @cached_property
    def allocated(self) -> DataFrame:
        unblocked = self.sales_fsn_dp.join(
            self.blocked.select("fsn", "dest_pincode"), ["fsn", "dest_pincode"], "left_anti"
        )
        return legacy.ff_allocation(self.ratio, unblocked, self.ff_issue)

    @cached_property
    def products(self) -> DataFrame:
        return prepare.week_products(self.inputs.sales)

    @cached_property
    def lead_time(self) -> DataFrame:
        lead = legacy.policy_lead_time_floor(
            self.inputs.leadtime_wide, self.products, self.inputs.cat_floor, self.period
        )
        return self._stage(lead, "lead_time")

    @cached_property
    def reco(self) -> DataFrame:
        plan = legacy.reco_agg(self.lead_time, self.inputs.reco_file, self.period.week_rule)
        return self._stage(plan, "plan")

    @cached_property
    def forecast_diff(self) -> DataFrame:
        return legacy.forecast_diff(self.inputs.preferred_wh, self.sales_fsn_dp, self.reco)

    @cached_property
    def national_doh(self) -> DataFrame:
        return legacy.national_doh(self.reco)

    @cached_property
    def po_adherence(self) -> DataFrame:
        return legacy.po_adherence(self.inputs.po_raised, self.reco)

    @cached_property
    def po_window(self) -> DataFrame:
        return legacy.po_leadtime_window(self.inputs.po_receipts, self.lead_time, self.period)

    @cached_property
    def cascaded(self) -> DataFrame:
        return legacy.cascade_g1(
            self.allocated,
            self.inputs.exclusions,
            self.inputs.offers,
            self.po_window,
            self.po_adherence,
            self.national_doh,
            self.forecast_diff,
        )

    @cached_property
    def waterfall(self) -> DataFrame:
        return legacy.waterfall_g1(
            self.sales_fsn_dp,
            self.blocked,
            self.cascaded,
            self.inputs.sales.select(*PRODUCT_COLUMNS).distinct(),
            self.inputs.low_sale,
        )


def plan_file_anchor(period: Period) -> dt.date:
    """Day of the newest of the weekly plan files a run reads."""
    tuesday = period.shift("wk_start", -5)
    return period.shift("wk_start", -7 + tuesday.isoweekday() % 7)


#: A plan row replaces those of older files for the same product, centre and plan day.
PLAN_KEYS = ["FSN", "FC", "reco_date"]


def plan_of_files(spark: SparkSession, template: str, period: Period, newest: bool = True) -> DataFrame:
    """The plan of the ten dated files a run reads; all must be there.

    With ``newest`` a file that restates a product, centre and plan day
    replaces what older files say of it; otherwise all rows add up.
    """
    rows = files.read_dated_files(spark, template, plan_file_anchor(period), SCHEMAS["auto_reco"])
    return files.newest_rows(rows, PLAN_KEYS) if newest else rows.drop(files.FILE_DAY)


def with_plan_files(inputs: EarlierInputs, spark: SparkSession, template: str, period: Period) -> EarlierInputs:
    """``inputs`` whose plan comes from the dated files."""
    return replace(inputs, reco_file=plan_of_files(spark, template, period))
