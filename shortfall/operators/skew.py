"""Joins in which a few keys hold a large share of the rows.

Heavy keys are found by a frequent-items sketch: one pass over the key columns
with partial aggregation, a state of fixed size, at most ``1 / share`` keys on
the driver. Only these are salted, each over as many parts as its share asks
for, and only their rows of the small side are repeated. Without a heavy key
the join is the plain one.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on; a part holds about as much at most.
HEAVY_SHARE = 1 / 64
KEPT_TYPES = ("inner", "left", "left_semi", "left_anti")


@dataclass(frozen=True)
class HeavyKeys:
    """Parts of each heavy key of some columns, by the key's hash.

    Hashes depend on the column types, so both sides must have those in ``kinds``.
    """

    on: tuple[str, ...]
    kinds: tuple[str, ...]
    parts: Mapping[int, int] = field(default_factory=dict)

    def parts_of(self) -> Column:
        """Parts of a row's key, 1 for any but heavy keys."""
        literals = [F.lit(v).cast(t) for h, n in sorted(self.parts.items()) for v, t in ((h, "bigint"), (n, "int"))]
        return F.coalesce(F.create_map(*literals)[F.xxhash64(*self.on)], F.lit(1))

    def check(self, df: DataFrame) -> None:
        kinds = dict(df.dtypes)
        if tuple(kinds[c] for c in self.on) != self.kinds:
            raise ValueError(f"key columns {self.on} must have the types {self.kinds} on both sides")


def heavy_keys_of(
    df: DataFrame, key_sets: Sequence[Sequence[str]], share: float = HEAVY_SHARE
) -> list[HeavyKeys]:
    """For each set of key columns the keys that hold ``share`` of the rows of ``df`` or more.

    Runs one aggregation for all sets. A null key counts as a key: its rows meet
    in one task as well, in a left join. The sketches track 64 times as many
    keys as can be heavy, so counts are off by a small part of ``share`` at
    most, which moves parts, never results.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie between 0 and 1")
    wanted = math.ceil(1 / share)
    names = [f"key{i}" for i in range(len(key_sets))]
    keys = df.select(*[F.xxhash64(*on).alias(name) for on, name in zip(key_sets, names)])
    sketches = [
        F.expr(f"approx_top_k({name}, {wanted}, {min(64 * wanted, 1_000_000)})").alias(name) for name in names
    ]
    row = keys.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    least = share * row["n"]
    kinds = dict(df.dtypes)
    return [
        HeavyKeys(
            tuple(on),
            tuple(kinds[c] for c in on),
            {
                int(each["item"]): math.ceil(each["count"] / least)
                for each in row[name] or []
                if each["count"] > least  # a key of one part needs no salt
            },
        )
        for on, name in zip(key_sets, names)
    ]


def heavy_keys(df: DataFrame, on: Sequence[str], share: float = HEAVY_SHARE) -> HeavyKeys:
    """``heavy_keys_of`` for one set of key columns."""
    return heavy_keys_of(df, [on], share)[0]


def heavy_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Equi-join that spreads the rows of heavy keys of ``large`` by a hash of ``spread_by``.

    ``heavy`` may come from another table with the same keys, such as a staged
    one that ``large`` is made from, and may name some of the join's columns;
    by default ``large`` is counted. The part
    depends on the row alone, so a retried task sends every row to the same
    place again.
    """
    if how not in KEPT_TYPES:
        raise ValueError("only join types that keep the large side whole can be salted")
    heavy = heavy_keys(large, on) if heavy is None else heavy
    if not set(heavy.on) <= set(on):
        raise ValueError(f"heavy keys of {heavy.on} do not serve a join on {tuple(on)}")
    if not heavy.parts:
        return large.join(small, list(on), how)
    heavy.check(large)
    heavy.check(small)
    part = f"part_{uuid.uuid4().hex}"
    left = large.withColumn(part, F.pmod(F.xxhash64(*spread_by), heavy.parts_of()).cast("int"))
    right = small.withColumn(part, F.explode(F.sequence(F.lit(0), heavy.parts_of() - 1)))
    joined = left.join(right, [part, *on], how).drop(part)
    rest = [c for c in small.columns if c not in on] if how in ("inner", "left") else []
    # in the order of a plain join on names: keys first
    names = [*on, *[c for c in large.columns if c not in on], *rest]
    return joined.select(*[f"`{c}`" for c in names])
