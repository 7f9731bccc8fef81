"""Missing-value semantics that differ from Spark's defaults.

The job this library reproduces treats a missing value as contagious in sums
and minima, counts it as a value of its own in distinct counts, and lets it
match itself in joins. Spark skips it in the first three and never matches it
in the last, so each rule has one explicit helper here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c: Column | str) -> Column:
    """Sum that is null as soon as one input of the group is null."""
    return F.when(F.count_if(_col(c).isNull()) == 0, F.sum(_col(c)))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that skips nulls; zero where nothing is left."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def count_distinct_na(c: Column | str) -> Column:
    """Distinct count in which all nulls together are one value."""
    has_null = F.coalesce(F.max(_col(c).isNull().cast("int")), F.lit(0))
    return F.count_distinct(_col(c)) + has_null


def _all_present(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, (c.isNotNull() for c in cols))


def strict_least(*cols: Column | str) -> Column:
    """Row minimum, null if any input is null."""
    cs = [_col(c) for c in cols]
    return F.when(_all_present(cs), F.least(*cs))


def strict_greatest(*cols: Column | str) -> Column:
    """Row maximum, null if any input is null."""
    cs = [_col(c) for c in cols]
    return F.when(_all_present(cs), F.greatest(*cs))


def excess(a: Column | str, b: Column | str) -> Column:
    """How far ``a`` exceeds ``b``, never negative; null if either is null."""
    return strict_greatest(_col(a) - _col(b), F.lit(0.0))


def if_else(cond: Column, yes, no) -> Column:
    """Conditional whose result is null where the condition is null."""
    return F.when(cond, yes).when(~cond, no)


def zero(c: Column | str) -> Column:
    """Null to 0.0 for one measure."""
    return F.coalesce(_col(c), F.lit(0.0))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null to zero in the named columns."""
    return df.fillna(0, subset=list(cols))


#: Stand-ins for a missing key, by column type; no real key has these values.
MISSING_KEYS = {"string": "<missing>", "int": -(1 << 31), "bigint": -(1 << 63)}


def present_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace missing values of key columns, so that plain joins match them with each other."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(MISSING_KEYS[kinds[c]]).cast(kinds[c]))
            for c in cols
            if kinds.get(c) in MISSING_KEYS
        }
    )


def missing_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Undo ``present_keys``."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.nullif(F.col(c), F.lit(MISSING_KEYS[kinds[c]]).cast(kinds[c]))
            for c in cols
            if kinds.get(c) in MISSING_KEYS
        }
    )


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Equi-join on ``(left key, right key)`` pairs in which null matches null.

    The right keys are dropped from the result.
    """
    renamed = right.withColumnsRenamed({r: f"__r_{r}" for _, r in keys})
    cond = reduce(
        lambda a, b: a & b, (left[lk].eqNullSafe(renamed[f"__r_{rk}"]) for lk, rk in keys)
    )
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{r}" for _, r in keys])
