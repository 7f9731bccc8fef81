"""Mixing sources to target weights along a time-varying curriculum, on DataFrames only.

Every source has a weight schedule over training time 0 to 1, linear from its
start to its end. Its integral is the source's cumulative token demand; the
inverse of the demand, taken at a document's place among its source's words,
is the document's training position. Sorting by position gives the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store

def word_count(text: Column) -> Column:
    """Runs of non-space in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def by_rank(sources: DataFrame, store: Store, parts: int = 32) -> DataFrame:
    """Source rows with ``rank`` 0, 1, ... by code point, null last; any number of sources."""
    null_last = F.col("source").isNull()
    ranged = store.put(
        sources.repartitionByRange(parts, null_last, "source").withColumn(
            "part", F.spark_partition_id()
        )
    )
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = counts.select(
        "part",
        (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(null_last, "source"))
    return ranged.join(before, "part").withColumn("rank", F.col("before") + place - 1).drop("part", "before")


def targets(sources: DataFrame, store: Store, most_epochs: float) -> DataFrame:
    """Source rows with ``target``: weighted shares of all words, none above ``most_epochs`` epochs.

    What a source can't take is shared again by weight among the others, until
    no target is above its limit.
    """
    ranked = by_rank(sources, store)
    ranked = store.put(
        ranked.withColumn("weight", F.pmod("rank", F.lit(3)) + F.lit(1.0)).withColumn(
            "limit", F.col("source_size") * F.lit(float(most_epochs))
        )
    )
    level, full = 0.0, -1
    while True:
        at_limit = F.col("limit") <= F.col("weight") * F.lit(level)
        got = ranged_sums(ranked, at_limit)
        if got["full"] == full or not got["free_weight"]:
            break
        full = got["full"]
        level = (got["total"] - got["full_limit"]) / got["free_weight"]
    target = F.least("limit", F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def ranged_sums(ranked: DataFrame, at_limit: Column) -> dict:
    row = ranked.agg(
        F.sum(F.col("source_size").cast("double")).alias("total"),
        F.sum(F.when(at_limit, 1).otherwise(0)).alias("full"),
        F.sum(F.when(at_limit, F.col("limit")).otherwise(0.0)).alias("full_limit"),
        F.sum(F.when(at_limit, 0.0).otherwise(F.col("weight"))).alias("free_weight"),
    ).first()
    return {k: v or 0 for k, v in row.asDict().items()}


def demand_time(done: Column, slope: Column) -> Column:
    """Training time at which a share ``done`` of a source's demand is used up.

    The schedule runs linearly from (1 - slope) to (1 + slope) times its mean,
    so its integral is (1 - slope) t + slope t^2, and this is its inverse.
    """
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * done)
    return F.when(F.abs(slope) < 1e-9, done).otherwise((root - (1 - slope)) / (2 * slope))


def plan(
    spark: SparkSession,
    docs: DataFrame,
    most_epochs: float = 3.0,
    first_slope: float = -0.6,
    last_slope: float = 0.6,
    carry: list[str] | None = None,
) -> DataFrame:
    """Structs ``_doc`` (the columns ``carry`` of ``docs``, all by default) and ``_mix`` of each row.

    ``_mix``: size, source_size, target, copies, taken, place, slope.

    A source's words are added up in 4,096 ranges of the hash, so that no source,
    however large, is summed in one task. A document is taken a whole number of times: the whole epochs of its source,
    and once more if the middle of its words, in the order of md5(doc_id), lies
    in the started epoch's share. ``place`` is its word offset in one epoch.
    Slopes of the schedules go from ``first_slope`` to ``last_slope`` over the
    ranks of the sources: early ranks are read early, late ranks late.

    Null sources are a source of their own, null and empty texts have size 0
    and are never taken, a null doc_id is hashed as empty text; repeated rows
    share their places in any order, with equal results on reruns. No row is
    dropped; no rows give no rows. ``docs`` may have any other columns.
    """
    store = Store(spark, "mixing")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    sized = docs.select(
        kept.alias("_doc"),
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),  # never null
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
    ).withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    buckets = store.put(
        sized.groupBy("name", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    )
    sources = buckets.groupBy("name").agg(
        F.first("source").alias("source"), F.sum("words").alias("source_size")
    )
    aimed = targets(sources, store, most_epochs)
    top = float(max(aimed.agg(F.max("rank").alias("top")).first()["top"] or 0, 1))
    aimed = aimed.select(
        "name", "source_size", "target",
        (F.lit(first_slope) + F.lit(last_slope - first_slope) * F.col("rank") / F.lit(top)).alias("slope"),
    )
    rising = Window.partitionBy("name").orderBy("bucket")
    starts = store.put(
        buckets.withColumn("start", F.sum("words").over(rising) - F.col("words"))
        .join(aimed, "name").drop("words", "source")
    )
    order = Window.partitionBy("name", "bucket").orderBy("key", "doc_id", "size")
    rows = sized.join(starts, ["name", "bucket"])
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("place", F.col("start") + before).withColumn("epochs", epochs)
    whole = F.floor("epochs")
    started = (F.col("epochs") - whole) * F.col("source_size")
    once_more = F.col("place") + F.col("size") / 2 < started
    copies = F.when(F.col("size") > 0, whole + once_more.cast("long")).otherwise(F.lit(0))
    return rows.select(
        "_doc",
        F.struct(
            "size", "source_size", "target", copies.alias("copies"),
            (copies * F.col("size")).alias("taken"), "place", "slope",
        ).alias("_mix"),
    )


def position(copy: Column) -> Column:
    """Training time, 0 to 1, of a document's copy (0, 1, ...)."""
    words = F.col("_mix.place") + copy * F.col("_mix.source_size") + F.col("_mix.size") / 2
    done = F.least(F.lit(1.0), words / F.col("_mix.target"))
    return demand_time(done, F.col("_mix.slope"))


def positioned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The training stream: the rows of ``docs`` as often as the mix takes them, each with ``_position``.

    Output is range-partitioned by training position and sorted within partitions.
    """
    rows = plan(spark, docs).filter("_mix.copies > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), (F.col("_mix.copies") - 1).cast("int"))))
    rows = rows.withColumn("_position", position(F.col("_copy")))
    return (
        rows.repartitionByRange("_position")
        .sortWithinPartitions("_position", "_doc.doc_id")
        .select("_doc.*", "_position")
    )


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of the training stream, in its order, without their positions."""
    return positioned(spark, docs).drop("_position")


def mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, position), one for each document.

    ``position`` is the first copy's training time, null if the mix doesn't
    take the document; rows are range-sorted by it.
    """
    rows = plan(spark, docs.select("doc_id", "text", "source"), carry=["doc_id"])
    first = F.when(F.col("_mix.copies") > 0, position(F.lit(0)))
    out = rows.select(
        "_doc.doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken",
        first.alias("position"),
    )
    return out.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
