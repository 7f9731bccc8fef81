"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store

SLOTS = 4096
#: Parts of training time in which a shard's rows are numbered.
TIMES = 1024
MAP = "version int, slot int, bytes long, rows long, shard int, before long"


def hashed(text: Column, slots: int) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % slots).cast("int")


def spread(load: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Shard of each slot: the largest slot next, always to the shard with the fewest bytes."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for slot, size, rows in sorted(load, key=lambda x: (-x[1], x[0])):
        used, held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (used + size, held + rows, shard))
    return out


def rebalanced(
    old: dict[int, int], load: list[tuple[int, int, int]], shards: int, slack: float = 0.01
) -> dict[int, int]:
    """An edited map: slots leave the fullest shard for the emptiest until all are within ``slack``.

    Slots of shards that no longer exist move first; no other slot moves
    without need, so that a new version rewrites little.
    """
    size = {slot: b for slot, b, _ in load}
    held: dict[int, set[int]] = {s: set() for s in range(shards)}
    homeless = []
    for slot in sorted(size):
        if old.get(slot, shards) < shards:
            held[old[slot]].add(slot)
        else:
            homeless.append(slot)
    used = {s: sum(size[x] for x in held[s]) for s in held}
    for slot in sorted(homeless, key=lambda x: (-size[x], x)):
        to = min(used, key=lambda s: (used[s], s))
        held[to].add(slot)
        used[to] += size[slot]
    mean = sum(size.values()) / shards
    for _ in range(len(size)):
        high = max(used, key=lambda s: (used[s], -s))
        low = min(used, key=lambda s: (used[s], s))
        gap = used[high] - used[low]
        moves = [x for x in held[high] if 0 < size[x] < gap]
        if gap <= slack * mean or not moves:
            break
        slot = min(moves, key=lambda x: (abs(2 * size[x] - gap), x))
        held[high].remove(slot)
        held[low].add(slot)
        used[high] -= size[slot]
        used[low] += size[slot]
    return {slot: s for s, slots in held.items() for slot in slots}


def map_rows(load: list[tuple[int, int, int]], shard_of: dict[int, int], version: int) -> list[tuple]:
    """Rows of the map, with each slot's row offset in its shard."""
    out, filled = [], {}
    for slot, size, rows in sorted(load):
        shard = shard_of[slot]
        out.append((version, slot, size, rows, shard, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + rows
    return out


def with_slots(docs: DataFrame, store: Store, shards: int, slots: int) -> DataFrame:
    """``docs`` with ``_size``, ``_slot`` and ``_tie``.

    Equal texts meet in one slot, unless together they hold more than a quarter
    of a slot's mean share of a shard's bytes: such groups (at most four for
    each shard and slot share, a bounded list) are spread by doc_id.
    """
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + F.lit(8)).cast("long")
    rows = docs.withColumn("_size", size).withColumn("_group", F.md5(text))
    groups = rows.groupBy("_group").agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    groups = store.put(groups.filter("rows > 1"))
    total = rows.agg(F.sum("_size").alias("total")).first()["total"] or 0
    # at most 16 * shards groups can hold more than this
    hot = groups.filter(F.col("bytes") > F.lit(total / (16.0 * shards))).select(
        "_group", F.lit(True).alias("_hot")
    )
    key = F.when(
        F.col("_hot"),
        F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_group"),
    ).otherwise(F.col("_group"))
    return (
        rows.join(F.broadcast(hot), "_group", "left")
        .withColumn("_slot", hashed(key, slots))
        .withColumn("_tie", F.xxhash64("text"))
        .drop("_hot", "_group")
    )


def assign(
    spark: SparkSession,
    docs: DataFrame,
    shards: int = 24,
    slots: int = SLOTS,
    old: DataFrame | None = None,
    carry: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with ``_size``, ``_virtual``, ``_shard`` and ``_place``; the slot map).

    Bytes and rows are added up by virtual slot; the map, one row a slot, is
    made from these sums on the driver (``slots`` bounds it) and written to the
    shared folder with its version. With an ``old`` map its shards are kept
    and only edited to balance again. ``_place`` counts a shard's rows from 0
    without gaps: the slot's offset plus the row's number in its slot.

    Null and empty texts count 8 bytes; null doc_ids count as empty text where
    ids are hashed; repeated rows take places of their own; no rows give no
    rows. The columns ``carry`` of ``docs``, all by default, stay as they are.
    """
    store = Store(spark, "sharding")
    kept = [f"`{c}`" for c in (docs.columns if carry is None else carry)]
    placed = with_slots(docs, store, shards, slots).select(*kept, "_size", "_slot", "_tie")
    sums = placed.groupBy("_slot").agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    load = [(r["_slot"], r["bytes"], r["rows"]) for r in sums.collect()]
    if old is None:
        shard_of, version = spread(load, shards), 1
    else:
        before = old.select("version", "slot", "shard").collect()
        version = max((r.version for r in before), default=0) + 1
        shard_of = rebalanced({r.slot: r.shard for r in before}, load, shards)
    slot_map = store.put(spark.createDataFrame(map_rows(load, shard_of, version), MAP))
    found = slot_map.select(
        F.col("slot").alias("_slot"), F.col("shard").alias("_shard"), F.col("before").alias("_before")
    )
    order = Window.partitionBy("_slot").orderBy("doc_id", "_size", "_tie")
    rows = placed.withColumn("_row", F.row_number().over(order))
    rows = rows.join(F.broadcast(found), "_slot")
    return (
        rows.withColumn("_place", F.col("_before") + F.col("_row") - 1)
        .withColumnRenamed("_slot", "_virtual")
        .drop("_row", "_before", "_tie"),
        slot_map,
    )


def numbered(rows: DataFrame, store: Store) -> DataFrame:
    """``rows`` with ``_place`` by training position: 0, 1, ... in each shard, without gaps.

    Rows are counted by shard and part of training time (a bounded table), so
    that a task sorts one such part, not a shard.
    """
    timed = F.least(F.floor(F.col("_position") * TIMES), F.lit(TIMES - 1)).cast("int")
    rows = store.put(rows.withColumn("_time", timed))
    counts = rows.groupBy("_shard", "_time").agg(F.count(F.lit(1)).alias("_rows"))
    rising = Window.partitionBy("_shard").orderBy("_time")
    starts = counts.select(
        "_shard", "_time", (F.sum("_rows").over(rising) - F.col("_rows")).alias("_start")
    )
    order = Window.partitionBy("_shard", "_time").orderBy("_position", "doc_id", "_size", "_virtual")
    return (
        rows.withColumn("_row", F.row_number().over(order))
        .join(F.broadcast(starts), ["_shard", "_time"])
        .withColumn("_place", F.col("_start") + F.col("_row") - 1)
        .drop("_time", "_row", "_start")
    )


def sharded(spark: SparkSession, docs: DataFrame, shards: int = 24) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot) of the documents.

    The law is ``bytes``: shards are near equal in bytes, so grown_shard is null.
    ``slot`` is the place in the shard: by training position where ``docs``
    has it as ``_position``, else by virtual slot and doc_id.
    """
    timed = ["_position"] if "_position" in docs.columns else []
    slim = docs.select(
        "doc_id",
        "text",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        *timed,
    )
    rows, _ = assign(spark, slim, shards, carry=["doc_id", "text_crc32", *timed])
    if timed:
        rows = numbered(rows.drop("_place"), Store(spark, "places"))
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        F.col("_place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_virtual").alias("virtual_slot"),
    )
