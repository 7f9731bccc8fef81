"""The weekly run: inputs to detail table, each frame built when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame

from shortfall.functions.dates import Period
from shortfall.functions.nulls import missing_keys, present_keys
from shortfall.operators import allocate, centres, issues, placement, prepare, quality, skew, waterfall


#: Keys by which a missing value matches a missing value.
MATCHED_KEYS = [
    "dest_pincode", "destination_pincode", "pincode", "brand", "vertical", "category",
]


@dataclass(frozen=True)
class WeeklyInputs:
    """The thirteen input tables. ``history`` may name a lighter source of the
    sales before the period; by default they come from ``sales_raw``."""

    sales_raw: DataFrame
    lzn_mapping: DataFrame
    vendor_site: DataFrame
    vendor_brand: DataFrame
    lead_time: DataFrame
    cat_lead_time: DataFrame
    min_sale_threshold: DataFrame
    exclusion_list: DataFrame
    preferred_warehouse: DataFrame
    requirement: DataFrame
    explain: DataFrame
    vendor_adherence: DataFrame
    offer_sales: DataFrame
    history: DataFrame | None = None

    def with_present_keys(self) -> WeeklyInputs:
        """Stand-ins for missing keys in every table."""
        tables = {f.name: getattr(self, f.name) for f in fields(self)}
        return replace(
            self,
            **{k: present_keys(df, MATCHED_KEYS) for k, df in tables.items() if df is not None},
        )


@dataclass(frozen=True)
class WeeklyOptions:
    drop_fcs: Sequence[str] = ()
    sales_by: str = "week"
    explain_by_week: bool = True
    reco_keys: Sequence[str] = ("fsn", "fc", "reco_week")
    fallback: str = "row_mean"
    promotions: str = "excess"
    strict_fanout: bool = False
    national: str = "given"
    inclusive: bool = True
    direction: str = "cut"
    clamp: bool = True


class WeeklyRun:
    """All frames of one run; each is built once, on first use.

    ``stage`` may be a function ``(frame, name) -> frame`` that writes a frame
    and reads it back (``shortfall.sources.stage.stage``). It is applied to the
    frames several branches need: the sales cube, the supplying centres of each
    pair, the placement table, the lead times, the plan at lead time, the issues, the
    pool and the cascade. Asking for a late frame then starts the jobs that write these.

    Missing destinations, brands, verticals and categories are keys like any
    other: they match each other. Within the run a stand-in takes their place;
    ``detail`` and ``output`` show them as missing again.
    """

    def __init__(
        self,
        inputs: WeeklyInputs,
        period: Period,
        options: WeeklyOptions = WeeklyOptions(),
        stage: Callable[[DataFrame, str], DataFrame] | None = None,
    ):
        self.inputs = inputs.with_present_keys()
        self.period, self.options = period, options
        self.staged = stage is not None
        self._stage = stage or (lambda df, name: df)

    @cached_property
    def sales(self) -> DataFrame:
        return prepare.clean_sales(
            self.inputs.sales_raw, self.period, self.options.drop_fcs, self.options.sales_by,
            self.options.national,
        )

    @cached_property
    def cube(self) -> DataFrame:
        """Sales added up to the finest grain any later step needs."""
        extra = ["product_id_key", "destination_pincode_key"]
        keys = ["fsn", "dest_pincode", "fc", *prepare.HIERARCHY]
        keys += [c for c in extra if c in self.sales.columns]
        return self._stage(prepare.sales_by(self.sales, keys), "sales_cube")

    @cached_property
    def sales_fsn_dp(self) -> DataFrame:
        return prepare.sales_by_fsn_dp(self.cube)

    @cached_property
    def sales_fsn_dp_fc(self) -> DataFrame:
        return prepare.sales_by_fsn_dp_fc(self.cube)

    @cached_property
    def sales_hierarchy(self) -> DataFrame:
        return prepare.sales_by_hierarchy(self.cube)

    @cached_property
    def pairs(self) -> DataFrame:
        return placement.sold_pairs(self.cube)

    @cached_property
    def products(self) -> DataFrame:
        return prepare.week_products(self.cube)

    @cached_property
    def lanes(self) -> DataFrame:
        return prepare.clean_lanes(self.inputs.lzn_mapping)

    @cached_property
    def serviceability(self) -> DataFrame:
        return placement.serviceability(self.lanes)

    @cached_property
    def fsn_vendors(self) -> DataFrame:
        return prepare.fsn_vendor_count(self.inputs.vendor_site)

    @cached_property
    def brand_vendors(self) -> DataFrame:
        return prepare.brand_vendor_count(self.inputs.vendor_brand)

    @cached_property
    def candidates(self) -> DataFrame:
        return placement.candidate_fcs(
            self.pairs, self.lanes, self.fsn_vendors, self.brand_vendors
        )

    @cached_property
    def supplied(self) -> DataFrame:
        return self._stage(
            placement.supplied_fcs(self.pairs, self.lanes, self.fsn_vendors, self.brand_vendors),
            "supplied",
        )

    @cached_property
    def near_centres(self) -> DataFrame:
        """The near centres of each destination, numbered within it."""
        return self._stage(centres.near_centres(self.lanes), "near_centres")

    @cached_property
    def brand_sets(self) -> DataFrame:
        """The supplying centres of brands by destination, as bitmaps."""
        return self._stage(
            centres.brand_sets(self.pairs, self.near_centres, self.brand_vendors), "brand_sets"
        )

    @cached_property
    def centre_sets(self) -> DataFrame:
        """The supplying centres of each pair, as bitmaps."""
        sets = centres.pair_sets(self.pairs, self.near_centres, self.fsn_vendors, self.brand_sets)
        return centres.with_brands(self._stage(sets, "centre_sets"), self.brand_sets)

    @cached_property
    def supply(self) -> DataFrame:
        """Vendors and centres of each pair, in numbers."""
        return placement.supply_of_sets(self.pairs, self.centre_sets)

    @cached_property
    def vendor_availability(self) -> DataFrame:
        return placement.vendor_availability(self.pairs, self.serviceability, self.supply)

    @cached_property
    def low_sales(self) -> DataFrame:
        history = self.inputs.history
        if history is None:
            history = prepare.drop_fcs(self.inputs.sales_raw, self.options.drop_fcs)
        return placement.low_sales_depth(
            history, self.inputs.min_sale_threshold, self.period, self.options.inclusive
        )

    @cached_property
    def low_products(self) -> DataFrame:
        return placement.low_sale_products(self.products, self.low_sales)

    @cached_property
    def exclusions(self) -> DataFrame:
        return prepare.active_exclusions(self.inputs.exclusion_list, self.period)

    @cached_property
    def placement(self) -> DataFrame:
        return self._stage(
            placement.placement_losses(
                self.sales_fsn_dp,
                self.serviceability,
                self.vendor_availability,
                self.low_products,
                self.exclusions,
            ),
            "placement",
        )

    @cached_property
    def blocked(self) -> DataFrame:
        return placement.placement_blocked(self.placement)

    @cached_property
    def fe_issue(self) -> DataFrame:
        period = self.period if self.options.explain_by_week else None
        return issues.fulfilment_engine_issue(self.inputs.explain, period)

    @cached_property
    def lead_time(self) -> DataFrame:
        lead_times = prepare.policy_lead_time(
            self.inputs.lead_time, self.products, self.inputs.cat_lead_time, self.period
        )
        if not self.options.strict_fanout:
            lead_times = prepare.one_lead_time(lead_times)
        return self._stage(lead_times, "lead_time")

    @cached_property
    def reco(self) -> DataFrame:
        return self._stage(
            issues.reco_at_lead_time(
                prepare.requirement_clean(self.inputs.requirement),
                self.lead_time,
                self.options.reco_keys,
                self.options.fallback,
                self._stage,
            ),
            "reco",
        )

    @cached_property
    def preferred(self) -> DataFrame:
        return prepare.preferred_fc(self.inputs.preferred_warehouse)

    @cached_property
    def forecast_issue(self) -> DataFrame:
        return issues.forecast_issue(
            self.sales_fsn_dp, self.preferred, self.reco, self.options.strict_fanout
        )

    @cached_property
    def override_issues(self) -> DataFrame:
        return issues.override_issues(
            self.reco, self.options.direction, self.options.strict_fanout
        )

    @cached_property
    def adherence_issue(self) -> DataFrame:
        return issues.vendor_adherence_issue(
            self.inputs.vendor_adherence,
            self.products,
            self.lead_time,
            self.inputs.cat_lead_time,
            self.period,
            self.options.clamp,
            self.options.strict_fanout,
        )

    @cached_property
    def unblocked(self) -> DataFrame:
        return allocate.unblocked_sales(self.sales_fsn_dp_fc, self.blocked)

    @cached_property
    def pool(self) -> DataFrame:
        unblocked = allocate.unblocked_pairs(self.placement)
        return self._stage(allocate.fe_loss_of_pairs(unblocked, self.fe_issue), "pool")

    @cached_property
    def ratio(self) -> DataFrame:
        if self.options.strict_fanout:
            return allocate.fc_split_ratio(self.supplied, True)
        return centres.split_ratio_of_sets(self.centre_sets, self.near_centres)

    @cached_property
    def allocated(self) -> DataFrame:
        return allocate.allocate_pool(self.ratio, self.pool)

    def _write_stages(self) -> None:
        """Write the pool and the issues side by side; they share only the cube."""
        if not self.staged:
            return
        _ = self.cube, self.sales_fsn_dp, self.products
        with ThreadPoolExecutor(2) as threads:
            chains = [
                threads.submit(getattr, self, "pool"),
                threads.submit(getattr, self, "issues"),
            ]
            for chain in chains:
                chain.result()

    @cached_property
    def cascaded(self) -> DataFrame:
        """The cascade by pair."""
        self._write_stages()
        open_pairs = self.pool.where("fsn_dp_loss > 0")
        if self.options.strict_fanout:
            return self._stage(self._fanout_cascade(open_pairs), "cascaded")
        issues_of_pairs = centres.issues_at_sets(
            self.centre_sets,
            self.near_centres,
            allocate.open_issues(self.issues),
            open_pairs,
        )
        cascaded = allocate.cascade_pairs(self.pool, self.supply, issues_of_pairs)
        return self._stage(cascaded, "cascaded")

    def _fanout_cascade(self, open_pairs: DataFrame) -> DataFrame:
        """The cascade of literal fan-outs by pair; only rows with an issue are made."""
        open_pairs = self.pairs.join(open_pairs.select(*centres.PAIR), centres.PAIR, "left_semi")
        vendors = self.near_centres, self.fsn_vendors, self.brand_vendors
        issues_of_rows = placement.supplied_rows_at(open_pairs, *vendors, self.issues)
        counts = placement.supplied_row_counts(open_pairs, *vendors)
        return allocate.cascade_fanout(
            self.pool, self.supply.join(counts, centres.PAIR), issues_of_rows
        )

    @cached_property
    def issues(self) -> DataFrame:
        if self.options.strict_fanout:
            combined = allocate.issue_combinations(
                self.forecast_issue, self.override_issues, self.adherence_issue
            )
            return self._stage(combined, "issues")
        return self._stage(
            allocate.issues_by_fc(
                self.forecast_issue, self.override_issues, self.adherence_issue
            ),
            "issues",
        )

    @cached_property
    def by_destination(self) -> DataFrame:
        return self.cascaded.drop("fsn_dp_fc_loss")

    @cached_property
    def losses(self) -> DataFrame:
        self._write_stages()
        return allocate.losses_of_pairs(self.placement, self.pool, self.by_destination)

    @cached_property
    def offers(self) -> DataFrame:
        return prepare.offer_sales_week(self.inputs.offer_sales, self.period)

    @cached_property
    def with_promotions(self) -> DataFrame:
        return waterfall.promotions_loss(self.losses, self.offers, self.options.promotions)

    @cached_property
    def _keyed_detail(self) -> DataFrame:
        return waterfall.waterfall_detail(self.sales_hierarchy, self.with_promotions, self.period)

    def stage_detail(self) -> None:
        """Write the detail once where several of detail, totals and output are wanted."""
        self.__dict__["_keyed_detail"] = self._stage(self._keyed_detail, "detail")

    @cached_property
    def detail(self) -> DataFrame:
        return missing_keys(self._keyed_detail, MATCHED_KEYS)

    @cached_property
    def totals(self) -> DataFrame:
        return waterfall.waterfall_totals(self.detail, self.period)

    @cached_property
    def output(self) -> DataFrame:
        heavy = skew.heavy_keys(self.cube, ["dest_pincode"])  # of the written cube, not of the detail
        keyed = waterfall.attach_keys(
            self._keyed_detail, self.cube, self.inputs.preferred_warehouse, heavy
        )
        return missing_keys(keyed, MATCHED_KEYS)

    @cached_property
    def checks(self) -> DataFrame:
        return quality.reconcile(self.placement, self.pool, self.cascaded, self.detail)
