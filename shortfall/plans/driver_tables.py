"""The star-schema tables seen as the inputs of the weekly run.

A nation is a destination, a supplier a fulfilment centre, a part a product, a
line item a sold unit batch. The reporting period is a year, since a single
week holds few rows at small scale.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.functions.dates import Period
from shortfall.operators.relational import salted_join
from shortfall.plans.weekly import WeeklyInputs, WeeklyOptions, WeeklyRun
from shortfall.sources.stage import stage

PERIOD = Period(dt.date(1997, 6, 29), dt.date(1998, 6, 27))


def _since(col: str, day: dt.date) -> Column:
    """Range test on the raw timestamp, which Parquet can use to skip row groups."""
    return F.col(col) >= F.lit(day.isoformat()).cast("timestamp_ntz")


def in_days(col: str, first: dt.date, last: dt.date) -> Column:
    return _since(col, first) & ~_since(col, last + dt.timedelta(days=1))


def text(c: str) -> Column:
    return F.col(c).cast("string")


class DriverTables:
    """Adapters over one directory of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- shared pieces -------------------------------------------------

    def nation(self, prefix: str) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias(f"{prefix}_nation"),
            F.col("n_regionkey").alias(f"{prefix}_region"),
        )

    @cached_property
    def nations(self) -> int:
        """How many nation keys there are, from zero; wide tables have a column for each.

        Reads one row at once, since columns must be known when a plan is built.
        """
        return (self.table("nation").agg(F.max("n_nationkey")).first()[0] or 0) + 1

    @cached_property
    def suppliers(self) -> DataFrame:
        """Fulfilment centres with the place they ship from."""
        return self.table("supplier").select(
            F.col("s_suppkey").alias("fc_no"),
            F.col("s_nationkey").alias("src_nation"),
            (F.col("s_acctbal") >= 0).cast("int").alias("is_first_party_seller"),
        ).join(self.nation("src"), "src_nation")

    @staticmethod
    def lane_class() -> Column:
        """Lane of a centre and destination; some destinations have national
        lanes only and some centres have none that is mapped."""
        return (
            F.when(F.col("dest_nation") % 7 == 3, "N2")
            .when(F.col("fc_no") % 9 == 4, "")
            .when(F.col("src_nation") == F.col("dest_nation"), "L1")
            .when(F.col("src_region") == F.col("dest_region"), "Z1")
            .otherwise("N1")
        )

    @cached_property
    def lzn_mapping(self) -> DataFrame:
        last = self.table("nation").agg(F.max("n_nationkey").cast("int")).scalar()
        every_nation = F.explode(F.sequence(F.lit(0), last))
        return (
            self.suppliers.withColumn("dest_nation", every_nation)
            .join(self.nation("dest"), "dest_nation")
            .select(
                text("fc_no").alias("src_fc_code"),
                "fc_no",
                F.col("src_nation").alias("src_pincode"),
                F.col("dest_nation").alias("dest_pincode"),
                self.lane_class().alias("lzn_value"),
            )
        )

    def lines(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Line items, of a span of days if one is given."""
        lines = self.table("lineitem")
        return lines if first is None else lines.where(in_days("l_shipdate", first, last))

    def shipped(self, lines: DataFrame) -> DataFrame:
        """Line items with order, destination, product and lane."""
        orders = self.table("orders").join(
            self.table("customer").select(
                F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest_nation")
            ),
            "o_custkey",
        )
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.suppliers, F.col("l_suppkey") == F.col("fc_no"))
            .join(self.nation("dest"), "dest_nation")
            .withColumn("lzn_value", self.lane_class())
        )

    def sales_between(self, first: dt.date | None, last: dt.date | None) -> DataFrame:
        lane, units = F.col("lzn_value"), F.col("l_quantity")
        return self.shipped(self.lines(first, last)).select(
            F.to_date("l_shipdate").alias("day"),
            F.col("l_orderkey").alias("fiu_id"),
            F.col("l_partkey").alias("fsn"),
            F.col("dest_nation").alias("dest_pincode"),
            F.col("src_nation").alias("source_pincode"),
            text("l_suppkey").alias("fc"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.col("p_type").alias("super_category"),
            F.col("p_name").alias("vertical"),
            F.when(F.col("p_size") <= 25, "Small").otherwise("Large").alias("bu"),
            units.alias("sales"),
            F.when(lane.isin("L1", "Z1"), units).otherwise(0.0).alias("ru_sales"),
            F.when(lane.isin("N1", "N2"), units).otherwise(0.0).alias("nat_sales"),
            "lzn_value",
            "l_discount",
            "l_linestatus",
            (F.col("l_partkey") + 1000000).alias("product_id_key"),
            (F.col("dest_nation") + 1000).alias("destination_pincode_key"),
        )

    # --- inputs of the weekly run ----------------------------------------

    @cached_property
    def sales_raw(self) -> DataFrame:
        return self.sales_between(None, None)

    @cached_property
    def sales(self) -> DataFrame:
        """Sales lines of the reporting period."""
        return self.sales_between(PERIOD.wk_start, PERIOD.wk_end)

    @cached_property
    def history(self) -> DataFrame:
        """All sales with the columns the depth check reads; the check picks its days."""
        span = self.lines()
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category")
        )
        return span.join(part, "l_partkey").select(
            F.to_date("l_shipdate").alias("day"),
            F.col("l_partkey").alias("fsn"),
            "category",
            F.col("l_quantity").alias("sales"),
        )

    @cached_property
    def vendor_site(self) -> DataFrame:
        """Product-level vendor sites; every fifth product has none."""
        return (
            self.table("lineitem")
            .where(F.col("l_partkey") % 5 != 0)
            .select(
                F.col("l_partkey").alias("fsn"),
                text("l_suppkey").alias("fc"),
                (F.col("l_orderkey") % 50).alias("vsid"),
            )
        )

    @cached_property
    def vendor_brand(self) -> DataFrame:
        """Brand-level vendor sites at a third of the centres."""
        return (
            self.table("lineitem")
            .where(F.col("l_suppkey") % 3 == 0)
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("p_brand").alias("brand"),
                F.col("p_name").alias("vertical"),
                text("l_suppkey").alias("fc"),
                (F.col("l_orderkey") % 20).alias("vsid"),
            )
        )

    @cached_property
    def lead_time(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("fsn"),
            text("l_suppkey").alias("warehouse"),
            ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 3) % 63).alias("lead_time"),
        ).distinct()

    @cached_property
    def cat_lead_time(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("category"), (2 * F.length("p_type")).alias("lead_time")
        ).distinct()

    @cached_property
    def min_sale_threshold(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("category"), (10 + F.length("p_type")).alias("min_sales_depth")
        ).distinct()

    @cached_property
    def exclusion_list(self) -> DataFrame:
        until = F.when(F.col("p_partkey") % 2 == 0, "1998-12-31").otherwise("1996-01-01")
        return (
            self.table("part")
            .where(F.col("p_size") >= 46)
            .select(F.col("p_partkey").alias("fsn"), until.alias("skip_upto"))
        )

    def _planned_by(self, *keys: Column) -> DataFrame:
        units = F.sum("l_quantity").cast("int").alias("q")
        return self.table("lineitem").groupBy(*keys).agg(units)

    @cached_property
    def planned_units(self) -> DataFrame:
        return self._planned_by(F.col("l_partkey"), F.col("l_suppkey"))

    @cached_property
    def requirement(self) -> DataFrame:
        """Plan per product and centre; forecasts shrink with the horizon.

        Added up by the centre's name, by which it is joined: the shuffle of the sum serves the joins."""
        q = F.col("q")
        steps = {"max_doh_qty": 3, "ipc_reviewed_qty": 5, "cdo_reviewed_qty": 7, "po_qty": 11}
        return self._planned_by(F.col("l_partkey").alias("fsn"), text("l_suppkey").alias("warehouse")).select(
            "fsn",
            "warehouse",
            q.alias("system_qty"),
            *[(q - q % m).alias(c) for c, m in steps.items()],
            (q % 20).alias("forecast_n"),
            *[(q % (20 - k)).alias(f"forecast_n{k}") for k in range(1, 8)],
        )

    @cached_property
    def preferred_warehouse(self) -> DataFrame:
        first, last = F.min("fc_no").cast("string"), F.max("fc_no").cast("string")
        single = F.col("dest_pincode") % 6 == 5
        return (
            self.lzn_mapping.groupBy("dest_pincode")
            .agg(first.alias("first"), last.alias("last"))
            .select(
                F.col("dest_pincode").alias("pincode"),
                F.when(single, F.col("first"))
                .otherwise(F.concat_ws(",", "first", "last"))
                .alias("preferred_fc_non_large"),
            )
        )

    @cached_property
    def explain(self) -> DataFrame:
        """Offers of each unit: its own lane, and for some one on a near lane."""
        near = (
            self.lzn_mapping.where(F.col("lzn_value").isin("L1", "Z1"))
            .groupBy("dest_pincode")
            .agg(F.min("lzn_value").alias("near_lane"))
        )
        also_near = (
            F.col("near_lane").isNotNull()
            & (F.col("lzn_value") == "N1")
            & (F.col("fiu_id") % 4 == 0)
        )
        own = F.struct(
            F.col("lzn_value"),
            F.when(F.col("l_linestatus") == "F", "true").otherwise("false").alias("is_accepted"),
            (F.col("sales") - 10).alias("effective_inventory"),
        )
        nearby = F.struct(
            F.col("near_lane").alias("lzn_value"),
            F.lit("false").alias("is_accepted"),
            (F.col("sales") - 25).alias("effective_inventory"),
        )
        offers = F.when(also_near, F.array(own, nearby)).otherwise(F.array(own))
        return (
            salted_join(self.sales, near, ["dest_pincode"], ["fiu_id"], how="left")
            .select("fiu_id", "fsn", "dest_pincode", "day", F.explode(offers).alias("offer"))
            .select("fiu_id", "fsn", "dest_pincode", "day", "offer.*")
        )

    @cached_property
    def purchase_orders(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "O", "approved")
            .when(F.col("o_orderstatus") == "F", "completed")
            .otherwise("cancelled")
        )
        short = F.floor(F.col("l_quantity") * F.col("l_discount")).cast("double")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_partkey").alias("fsn"),
                text("l_suppkey").alias("fc"),
                F.to_date("o_orderdate").alias("poi_created_day"),
                status.alias("po_status"),
                F.col("l_quantity").alias("poi_ordered_qty"),
                (F.col("l_quantity") - short).alias("poi_received_qty"),
            )
        )

    @cached_property
    def offer_sales(self) -> DataFrame:
        """Units by week of the offer; only well discounted lines are of this period's."""
        week = F.when(F.col("l_discount") >= 0.08, PERIOD.week).otherwise(PERIOD.week - 1)
        return self.sales.select(
            week.alias("week_num"), "fsn", "dest_pincode", F.col("sales").alias("offer_sales")
        )

    @cached_property
    def inputs(self) -> WeeklyInputs:
        return WeeklyInputs(
            sales_raw=self.sales,
            lzn_mapping=self.lzn_mapping,
            vendor_site=self.vendor_site,
            vendor_brand=self.vendor_brand,
            lead_time=self.lead_time,
            cat_lead_time=self.cat_lead_time,
            min_sale_threshold=self.min_sale_threshold,
            exclusion_list=self.exclusion_list,
            preferred_warehouse=self.preferred_warehouse,
            requirement=self.requirement,
            explain=self.explain,
            vendor_adherence=self.purchase_orders,
            offer_sales=self.offer_sales,
            history=self.history,
        )

    def staged(self) -> DriverTables:
        """The same tables with the centres and the derived sales lines written
        once, as a real extract would be, instead of joined anew by every branch.

        Spark takes the size of a join for the product of its sides, so only
        written centres show how few they are before line items are shuffled."""
        tables = type(self)(self.spark, self.sf_dir)
        tables.suppliers = stage(self.suppliers, "suppliers")
        tables.sales = stage(tables.sales, "sales")
        return tables

    def run(self, staged: bool = False, written: Sequence[str] = ()) -> WeeklyRun:
        """The run, with all its stages written (``staged``) or only those ``written`` names."""
        options = WeeklyOptions(
            sales_by="day", explain_by_week=False, reco_keys=("fsn", "fc")
        )
        if staged:
            return WeeklyRun(self.staged().inputs, PERIOD, options, stage)
        if written:
            return WeeklyRun(
                self.inputs, PERIOD, options, lambda df, name: stage(df, name) if name in written else df
            )
        return WeeklyRun(self.inputs, PERIOD, options)

    @cached_property
    def weekly(self) -> WeeklyRun:
        return self.run()

    @cached_property
    def weekly_staged(self) -> WeeklyRun:
        return self.run(staged=True)

    @cached_property
    def weekly_leads(self) -> WeeklyRun:
        """For plans and orders together: both meet the lead times, which are written once."""
        return self.run(written=["lead_time"])
