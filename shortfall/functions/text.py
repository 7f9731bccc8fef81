"""Text clean-up expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; null where it is not a number."""
    return _col(c).try_cast("double")


def is_true(c: Column | str) -> Column:
    """A flag that arrives as true/TRUE, as text 1 or as a number."""
    return F.lower(_col(c).cast("string")).isin("true", "1", "1.0")


def first_of_list(c: Column | str, sep: str = ",") -> Column:
    """First item of a separated list; a value without separator gives ''."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.when(F.instr(c, sep) > 0, F.substring_index(c, sep, 1)).otherwise(F.lit(""))
    )


def strip_qualifiers(df: DataFrame) -> DataFrame:
    """Drop a leading ``table.`` from every column name."""
    return df.toDF(*[re.sub(r"^.*\.", "", name) for name in df.columns])
