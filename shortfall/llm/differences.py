"""Near copies that fall short of a link, compared by their differences to a common set.

In a group of near copies most pairs share most of their tokens, whether they
link or not, so a join by shared tokens makes nearly all pairs. Such a group
gets a common set, of the tokens that most of its members hold, and a member x
is written as its difference to it, D(x). Since x and y differ in exactly the
tokens in which D(x) and D(y) do, ``|x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|``
for any common set, and x and y are similar enough when

    2 (100 + t) |D(x) & D(y)| >= W(x) + W(y), W(x) = (100 + t) |D(x)| - (100 - t) |x|

Where the right side is not above zero, x and y link, and so do both with the
member of least W. All other pairs must share rare tokens: their differences
are joined by prefixes in which the place of a shared token still leaves room
for enough of them. No pair is left out, whatever the common set is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store


def gathered(rows: DataFrame, least: int) -> DataFrame:
    """Rows (node, centre): each class that meets a centre, and the centre; ``least`` classes or more meet it.

    ``rows``: token, node, n, ask. A bucket names its class of least hash, so
    that the buckets of a group agree; a class goes with the centre that
    most classes meet as often as a candidate pair must. Linear in the rows.
    """
    first = F.struct(F.xxhash64("node").alias("any"), "node", "n", "ask")
    leaders = rows.groupBy("token").agg(F.min(first).alias("leader"))
    votes = (
        rows.join(leaders, "token")
        .filter("2 * least(n, leader.n) >= greatest(n, leader.n)")
        .groupBy("node", F.col("leader.node").alias("centre"))
        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("ask", "leader.ask")).alias("ask"))
        .filter("shared >= ask")
    )
    sizes = votes.groupBy("centre").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least)
    chosen = votes.join(sizes, "centre").groupBy("node").agg(
        F.max(F.struct("size", "shared", "centre")).alias("best")
    )
    return chosen.select("node", F.col("best.centre").alias("centre"))


def common_sets(members: DataFrame, texts: DataFrame, shingler, least: int, sample: int) -> DataFrame:
    """Rows (centre, common): the tokens in most sets of some ``sample`` members of each group.

    Members are chosen by hash. Which tokens are common only decides how short
    the differences are, not what links.
    """
    sizes = members.groupBy("centre").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least)
    some = members.join(sizes, "centre").filter(f"pmod(xxhash64(node, 1), greatest(size div {sample}, 1)) = 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for centre, text in zip(batch.column("centre"), batch.column("text")):
                tokens = shingler.hashes(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(tokens), centre.as_py(), np.int64)), pa.array(tokens)],
                    names=["centre", "token"],
                )

    tokens = some.join(texts, "node").select("centre", "text").mapInArrow(run, "centre long, token long")
    chosen = some.groupBy("centre").agg(F.count(F.lit(1)).alias("chosen"))
    return (
        tokens.groupBy("centre", "token").agg(F.count(F.lit(1)).alias("sets"))
        .join(chosen, "centre").filter("2 * sets > chosen")
        # no more tokens than twice those of a set
        .groupBy("centre").agg(F.collect_list("token").alias("common"))
    )


def differences(members: DataFrame, texts: DataFrame, common: DataFrame, shingler, threshold: int) -> DataFrame:
    """Rows (centre, node, size, weight, tokens) of members that hold much of the common set; size is that of tokens."""
    rows = texts.join(members, "node").join(common, "centre").select("centre", "node", "text", "common")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            out: list[tuple] = []
            for centre, node, text, common in zip(*(batch.column(i) for i in range(4))):
                if centre.as_py() != last:
                    last, held = centre.as_py(), np.array(common.values, np.int64).view(np.uint64)
                hashes = shingler.hashes(text.as_py())
                apart = np.setxor1d(hashes, held, assume_unique=True)
                if 2 * len(apart) <= len(hashes) + len(held):
                    weight = (100 + threshold) * len(apart) - (100 - threshold) * len(hashes)
                    out.append((last, node.as_py(), len(apart), weight, apart.view(np.int64)))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), kind) for x, kind in zip(columns, kinds)],
                names=["centre", "node", "size", "weight", "tokens"],
            )

    return rows.mapInArrow(run, "centre long, node long, size long, weight long, tokens array<long>")


def of_components(apart: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return apart.withColumn("component", F.col("node"))
    return apart.join(labels, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")


def links_to_least(apart: DataFrame) -> DataFrame:
    """Pairs (a, b) of each group's member of least weight and those that link with it whatever they share.

    Two members of any other weights that need share nothing both link with it.
    """
    least = apart.groupBy("centre").agg(F.min(F.struct("weight", "component", "node")).alias("least"))
    return (
        apart.join(least, "centre")
        .filter("component != least.component and weight + least.weight <= 0")
        .select(F.least("node", "least.node").alias("a"), F.greatest("node", "least.node").alias("b"))
    )


def differing_pairs(apart: DataFrame, store: Store, threshold: int) -> DataFrame:
    """Candidate pairs (a, b) within the groups, of different components and weights that add up to more than zero."""
    unit = 2 * (100 + threshold)
    # the least weight that a member meets outside its component
    lows = apart.groupBy("centre", "component").agg(F.min("weight").alias("low"))
    least = lows.groupBy("centre").agg(F.min(F.struct("low", "component")).alias("least"))
    least = (
        lows.join(least, "centre").groupBy("centre")
        .agg(F.min("least").alias("least"), F.min(F.expr("if(component != least.component, low, null)")).alias("next"))
        .filter("next is not null")
    )
    tokens = store.put(
        apart.join(least, "centre")
        .withColumn("met", F.expr("if(component = least.component, next, least.low)"))
        .withColumn("shared", F.expr(f"greatest(1, (weight + met + {unit - 1}) div {unit})"))
        .select("centre", "component", "node", "size", "weight", "shared", F.explode("tokens").alias("token"))
    )
    counts = tokens.groupBy("centre", "token", "component").agg(F.count(F.lit(1)).alias("sets"))
    held = counts.groupBy("centre", "token").agg(
        F.sum("sets").alias("sets"), F.count(F.lit(1)).alias("components"),
        F.max_by("component", F.struct("sets", "component")).alias("largest"),
    ).filter("components > 1")
    # tokens of one component first, then rare ones; from a token on, ``rest`` may be shared, itself included
    rest = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sets"), "token"))
    rows = store.put(
        tokens.join(held, ["centre", "token"]).withColumn("rest", rest).filter("rest >= shared")
        .select("centre", "token", "component", "node", "weight", "rest", "largest")
    )
    other = rows.select("centre", "token", *[F.col(c).alias(f"o_{c}") for c in ("component", "node", "weight", "rest", "largest")])
    room = f"component != o_component and {unit} * least(rest, o_rest) >= weight + o_weight"
    small = rows.filter("component != largest")
    met = small.join(other.filter("o_component = o_largest"), ["centre", "token"]).filter(room).unionByName(
        small.join(other.filter("o_component != o_largest"), ["centre", "token"]).filter(room).filter("node < o_node")
    )
    return met.select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()
