"""General table operators the domain operators are built from."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.functions.text import to_number

#: How many parts a hot key is spread over by ``salted_join``.
SALT_PARTS = 16


def columns_like(
    df: DataFrame, prefixes: Sequence[str] = (), suffixes: Sequence[str] = ()
) -> list[str]:
    """Names of the columns with one of the prefixes or suffixes, in table order."""
    return [c for c in df.columns if c.startswith(tuple(prefixes)) or c.endswith(tuple(suffixes))]


def cast_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text columns to double; null where a value is not a number."""
    return df.withColumns({c: to_number(c) for c in cols})


def drop_sentinels(df: DataFrame, col: str, sentinels: Sequence[str]) -> DataFrame:
    """Keep rows whose value is present and not one of the stand-ins for missing."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*sentinels))


def overwrite_where(df: DataFrame, cond: Column, cols: Iterable[str], value) -> DataFrame:
    """Set several columns to ``value`` in the rows where ``cond`` is true."""
    return df.withColumns({c: F.when(cond, F.lit(value)).otherwise(F.col(c)) for c in cols})


def join_chain(base: DataFrame, others: Iterable[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left-join several tables onto ``base`` by the same keys."""
    return reduce(lambda acc, df: acc.join(df, list(on), "left"), others, base)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on every column name the two tables share."""
    shared = [c for c in left.columns if c in right.columns]
    return left.join(right, shared, how)


def join_on_upper(
    left: DataFrame, right: DataFrame, key: str, on: Sequence[str] = (), how: str = "left"
) -> DataFrame:
    """Join on ``key`` ignoring its case, and on further plain keys.

    The left spelling of the key is kept.
    """
    upper = f"__{key}_upper"
    right_upper = right.withColumn(upper, F.upper(key)).drop(key)
    return left.withColumn(upper, F.upper(key)).join(right_upper, [upper, *on], how).drop(upper)


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    parts: int = SALT_PARTS,
) -> DataFrame:
    """Equi-join in which one key value may hold a large share of ``large``.

    Rows of ``large`` with the same key are spread over ``parts`` by a hash of
    ``spread_by``; ``small`` is repeated once per part. The salt is a function
    of the row, so a retried task sends every row to the same place again.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only join types that keep the large side whole can be salted")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int")
    left = large.withColumn("__salt", salt)
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(right, ["__salt", *on], how).drop("__salt")


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """Union all by name; a column some table lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The distinct combinations of a column subset."""
    return df.select(*cols).distinct()


def wide_to_long(df: DataFrame, ids: Sequence[str], var: str, value: str) -> DataFrame:
    """One row per id and remaining column; null values are kept."""
    values = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, var, value)


def count_where_in(cols: Iterable[str], values: Sequence[str]) -> Column:
    """How many of the columns hold one of the values in this row."""
    return reduce(lambda a, b: a + b, (F.col(c).isin(*values).cast("int") for c in cols))


def row_sum(cols: Iterable[str]) -> Column:
    """Sum across columns of one row; null if any is null."""
    return reduce(lambda a, b: a + b, (F.col(c) for c in cols))


def totals(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row of column totals."""
    return df.agg(*[F.sum(c).alias(c) for c in cols])


def frequency(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def fanout_audit(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values per key, most first: any count above one repeats rows in a join by key."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(value).alias("value_count"))
        .orderBy(F.desc("value_count"), key)
    )


def last_rows(df: DataFrame, key: Sequence[str], n: int = 6) -> DataFrame:
    """The last ``n`` rows in key order."""
    return df.orderBy(*[F.desc(k) for k in key]).limit(n)


def few_distinct(df: DataFrame, keys: Sequence[Column | str], value: str, limit: int, name: str) -> DataFrame:
    """Groups with fewer than ``limit`` distinct values, with their exact number; missing values do not count.

    ``HAVING COUNT(DISTINCT value) < limit`` needs no more than ``limit``
    values of a group. A theta sketch of at least twice that size holds the
    hashes themselves as long as they are that few, so the number is exact up
    to equal 64-bit hashes. Each task keeps and ships one such set per group,
    however many rows or values the group has, instead of every distinct value.
    """
    size = max(4, (2 * limit - 1).bit_length())
    sketch = F.theta_sketch_agg(value, size)
    counted = df.groupBy(*keys).agg(F.theta_sketch_estimate(sketch).alias(name))
    return counted.where(F.col(name) < limit)
