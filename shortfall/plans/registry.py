"""Registered queries: every operator over the star-schema tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.plans.earlier_tables import EarlierTables
from shortfall.plans.earlier_views import EARLIER_VIEWS
from shortfall.plans.views import rounded, with_views
from shortfall.session import tune



@dataclass(frozen=True)
class Presented:
    """A result that is ``presentable`` already: what all centres of a pair share is rounded once per pair."""

    df: DataFrame


Build = Callable[[EarlierTables], DataFrame | Presented]

BUILDS: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Build], Build]:
    """Register a query and, where SQL can express it, its equivalent."""

    def register(build: Build) -> Build:
        if name in BUILDS:
            raise ValueError(f"query {name} is registered twice")
        BUILDS[name] = build
        if sql is not None:
            ORACLES[name] = with_views(sql, EARLIER_VIEWS)
        return build

    return register


def presentable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, since the order of additions differs, and show dates as text."""
    shown = {
        "double": lambda c: F.round(c, digits) + F.lit(0.0),
        "date": lambda c: F.date_format(c, "yyyy-MM-dd"),
    }
    return df.select(
        *[
            shown[kind](F.col(f"`{c}`")).alias(c) if kind in shown else F.col(f"`{c}`")
            for c, kind in df.dtypes
        ]
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from shortfall.plans import queries_blocks, queries_earlier, queries_weekly  # noqa: F401

    def shown(built: DataFrame | Presented) -> DataFrame:
        return built.df if isinstance(built, Presented) else presentable(built)

    def runner(build: Build):
        return lambda spark, sf_dir: shown(build(EarlierTables(tune(spark), sf_dir)))

    return {name: runner(build) for name, build in BUILDS.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)


__all__ = ["Presented", "presentable", "query", "queries", "oracle_sql", "rounded"]
