"""Similarity join of shingle sets with adaptive multi-match prefixes.

Every document orders the tokens (hashed shingles) of its set by one global
order, frequent tokens last. If two sets are similar enough, the prefixes of
length ``n - ceil(t * n) + l`` share at least ``l`` tokens. Each document picks
its own ``l`` by the estimated number of candidates in its plain prefix, so a
prefix full of frequent tokens becomes longer and asks for more shared tokens.

Texts with one set form a class; classes are the nodes of the join. No step
pairs a class with all others of a bucket while they may still turn out to be
connected: each class first tries the best leader among its buckets, and only
classes of different components that remain in one bucket are then paired;
those of one large group of near copies by what they do not share with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store, arrow_rows
from shortfall.llm.components import connected_components
from shortfall.llm.differences import (
    common_sets,
    differences,
    differing_pairs,
    gathered,
    links_to_least,
    of_components,
)
from shortfall.llm.words import word_hashes

EMPTY = np.empty(0, np.uint64)


@dataclass
class Shingler:
    """Distinct shingles of a text; words are runs of non-space, A-Z lower-cased."""

    words: int = 5

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
        ids = word_hashes(text.encode("utf-8", "surrogatepass").lower() if text else b"")
        if not len(ids):
            return EMPTY
        k = min(self.words, len(ids))
        mixed = np.full(len(ids) - k + 1, k, np.uint64)
        for i in range(k):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - k + 1 + i]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)

    def exact(self, text: str) -> set[bytes]:
        """The shingles themselves."""
        got = text.encode("utf-8", "surrogatepass").lower().split()
        if not got:
            return set()
        k = min(self.words, len(got))
        return {b" ".join(got[i : i + k]) for i in range(len(got) - k + 1)}


def class_id(hashes: np.ndarray) -> int | None:
    """Hash of a whole set, null for the empty set; its low four bits are left free."""
    return (xxhash.xxh3_64_intdigest(hashes.tobytes()) & ~15) - (1 << 63) if len(hashes) else None


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def both_hold(some: np.ndarray, others: np.ndarray) -> int:
    """How many hashes two sorted sets share."""
    few, many = (some, others) if len(some) < len(others) else (others, some)
    at = np.searchsorted(many, few)
    at[at == len(many)] = 0
    return int(np.count_nonzero(many[at] == few)) if len(many) else 0


def needed(n: int, threshold: int) -> int:
    """Fewest shared tokens with any similar set."""
    return -(-threshold * n // 100)


@dataclass
class Order:
    """The global order: rare tokens by hash, then frequent ones by document frequency."""

    tokens: np.ndarray
    counts: np.ndarray
    threshold: int = 75
    most_extra: int = 6

    def prefix(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Prefix tokens, whether each is frequent, whether each counts against larger sets, matches asked for.

        Against a set that is no smaller, ``2 t / (1 + t)`` of the tokens must
        be shared, so that a shorter start of the prefix does.

        The estimated cost is what the listed tokens of the plain prefix occur
        in, and a chance match for some tokens of the others. Its logarithm is
        the number of further tokens, and of further matches asked for.
        """
        n = len(hashes)
        need = needed(n, self.threshold)
        if len(self.tokens):
            at = np.searchsorted(self.tokens, hashes)
            at[at == len(self.tokens)] = 0
            hot = self.tokens[at] == hashes
            df = np.where(hot, self.counts[at], 0)
        else:
            hot, df = np.zeros(n, bool), np.zeros(n, np.int64)
        order = np.concatenate(
            [np.flatnonzero(~hot), np.flatnonzero(hot)[np.argsort(df[hot], kind="stable")]]
        )
        plain = n - need + 1
        cost = df[order[:plain]].sum() / plain + plain / 12
        ask = int(min(1 + min(self.most_extra, np.log2(1 + cost)), need))
        use = order[: plain + ask - 1]
        most = -(-2 * self.threshold * n // (100 + self.threshold))
        against_larger = np.arange(len(use)) < n - most + ask
        return hashes[use], hot[use], against_larger, ask


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows at most, so that a task's arrays stay small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


PROFILE = "doc_id long, text_key long, n_shingles long, node long, token long, docs long"


def profiles(docs: DataFrame, shingler: Shingler, least: int = 3) -> DataFrame:
    """A row for each document, and counts of tokens seen ``least`` times in a batch.

    Rows of documents have a null token. Counts leave out repeated sets of the
    batch; they only order the tokens, so what they miss costs time at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3000):
            nodes, sizes, sets = [], [], {}
            for text in batch.column("text"):
                hashes = shingler.hashes(text.as_py())
                node = class_id(hashes)
                nodes.append(node)
                sizes.append(len(hashes))
                if node is not None:
                    sets[node] = hashes
            size = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.nulls(size, pa.int64()),
                    pa.nulls(size, pa.int64()),
                ],
                names=["doc_id", "text_key", "n_shingles", "node", "token", "docs"],
            )
            if not sets:
                continue
            tokens, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            tokens, counts = tokens[counts >= least], counts[counts >= least]
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.array(signed(tokens)), pa.array(counts.astype(np.int64))],
                names=["doc_id", "text_key", "n_shingles", "node", "token", "docs"],
            )

    return docs.mapInArrow(run, PROFILE)


def frequent(counts: DataFrame, most: int, threshold: int) -> Order:
    """The order, from the ``most`` most frequent tokens at most; any others count as rare."""
    top = (
        counts.groupBy("token").agg(F.sum("docs").alias("docs")).filter("docs >= 6")
        .orderBy(F.desc("docs"), "token").limit(most).toPandas()
    )
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return Order(tokens[order], top["docs"].to_numpy(np.int64)[order], threshold)


PREFIX = "token long, node long"


def prefixes(docs: DataFrame, shingler: Shingler, order: Order) -> DataFrame:
    """Rows (token, node) of the prefix of each set, once a set and batch.

    Rows are narrow, since there are many: a token's low bit says that it is
    frequent, a node's low four bits are the matches it asks for and
    whether the token counts against larger sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            seen: set[int] = set()
            tokens, nodes = [], []
            for text in batch.column("text"):
                hashes = shingler.hashes(text.as_py())
                node = class_id(hashes)
                if node is None or node in seen:
                    continue
                seen.add(node)
                use, hot, against_larger, ask = order.prefix(hashes)
                tokens.append((signed(use) & ~1) | hot)
                nodes.append(node + ask + 8 * against_larger.astype(np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(nodes))],
                    names=["token", "node"],
                )

    return docs.mapInArrow(run, PREFIX)


#: Words of a bitmap of text keys; it only spares the join texts that it can't need.
BITMAP_WORDS = 1 << 18


def texts_of(docs: DataFrame, pairs: DataFrame, classes: DataFrame, store: Store) -> DataFrame:
    """Rows (node, text): one text of each class in ``pairs``.

    ``docs``: text_key, text; ``classes``: node, text_key. A bitmap of the
    wanted keys, of fixed size, keeps most other texts out of the shuffle.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = store.put(nodes.join(classes.select("node", "text_key"), "node"))
    bit = F.pmod("text_key", F.lit(64 * BITMAP_WORDS))
    word, place = (bit / 64).cast("int"), (bit % 64).cast("int")
    bitmap = keys.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("bits")
    )
    wanted = (
        docs.filter("text is not null").withColumn("word", word)
        .join(F.broadcast(bitmap), "word")
        .filter(F.call_function("getbit", "bits", place) == 1)
        .select("text_key", "text")
    )
    # with the key, the rows of a node are together already
    return store.put(wanted.join(keys, "text_key").dropDuplicates(["text_key", "node"]).select("node", "text"))


def of_like_size(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose set sizes allow the similarity."""
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("na"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
    return (
        pairs.join(left, "a").join(right, "b")
        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold)
        .select("a", "b")
    )


def verified(pairs: DataFrame, texts: DataFrame, shingler: Shingler, threshold: int) -> DataFrame:
    """Pairs (a, b) of classes whose texts' exact shingle sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_hashes, last_set = None, EMPTY, None
        for batch in slices(batches, 1000):
            a, b = [], []
            for x, y, left, right in zip(*(batch.column(i) for i in range(4))):
                x, y, left = x.as_py(), y.as_py(), left.as_py()
                if y != last:
                    last, last_hashes, last_set = y, shingler.hashes(right.as_py()), None
                # most pairs fall short already by the hashes that made them candidates
                hashes = shingler.hashes(left)
                shared = both_hold(hashes, last_hashes)
                if 100 * shared < threshold * (len(hashes) + len(last_hashes) - shared):
                    continue
                if last_set is None:
                    last_set = shingler.exact(right.as_py())
                other = shingler.exact(left)
                shared = len(other & last_set)
                if 100 * shared >= threshold * (len(other) + len(last_set) - shared):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return both.mapInArrow(run, "a long, b long")


def best_leaders(rows: DataFrame, tries: int = 4) -> DataFrame:
    """For each class a few classes to try: leaders that most of its buckets name.

    ``rows``: token, node, ask, inner, component. A bucket's leaders are a node of its
    lowest and one of its highest component, by a hash of node and token: so
    the buckets of a class name several members of a large component. Classes
    in fewer buckets than matches asked for try nothing. Linear in the rows.
    """
    first = F.struct("component", F.xxhash64("node", "token").alias("any"), "node", "ask")
    leaders = rows.groupBy("token").agg(F.min(first).alias("low"), F.max(first).alias("high"))
    tried = (
        rows.join(leaders, "token")
        .withColumn(
            "leader", F.when(F.col("low.component") != F.col("component"), F.col("low")).otherwise(F.col("high"))
        )
        .filter(F.col("leader.component") != F.col("component"))
        .groupBy("node", F.col("leader.node").alias("leader"))
        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("ask", "leader.ask")).alias("ask"))
    )
    ranked = tried.groupBy("node").agg(
        F.sum("shared").alias("met"), F.min("ask").alias("ask"),
        # no more leaders than tokens of the prefix
        F.sort_array(F.collect_list(F.struct((-F.col("shared")).alias("order"), "leader"))).alias("leaders"),
    )
    chosen = ranked.filter("met >= ask").select(
        "node", F.explode(F.slice("leaders", 1, tries)).alias("leader")
    )
    return chosen.select(
        F.least("node", "leader.leader").alias("a"), F.greatest("node", "leader.leader").alias("b")
    ).distinct()


def remaining_pairs(
    rows: DataFrame, apart: DataFrame | None, classes: DataFrame, store: Store, threshold: int
) -> DataFrame:
    """All candidate pairs of classes that are still in different components, but for those of one group of ``apart``.

    In each bucket the rows outside its largest part, a group or else a component, meet all
    others, so the largest part is never paired with itself.
    """
    if apart is None:
        rows = rows.withColumn("part", F.col("component"))
    else:
        # a centre's low bit sets it off from components
        groups = apart.select("node", (F.col("centre") + 1).alias("group"))
        rows = rows.join(groups, "node", "left").withColumn("part", F.coalesce("group", "component"))
    rows = store.put(enough(rows).join(classes.select("node", "n"), "node"))
    sizes = rows.groupBy("token", "part").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("token").agg(F.max_by("part", F.struct("size", "part")).alias("largest"))
    rows = rows.join(largest, "token")
    other = rows.select(
        "token", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "ask", "component", "part", "largest")]
    )
    # the smaller of two sets meets the larger by its inner tokens
    smaller = "component != o_component and part != o_part and (n < o_n or n = o_n and node < o_node) and 100 * n >= {} * o_n"
    smaller = smaller.format(threshold)
    inner = rows.filter("inner")
    met = inner.filter("part != largest").join(other, "token").filter(smaller).unionByName(
        inner.filter("part = largest").join(other.filter("o_part != o_largest"), "token").filter(smaller)
    )
    counted = met.groupBy("node", "n", "ask", "o_node", "o_n", "o_ask").agg(
        F.count(F.lit(1)).alias("shared")
    )
    # what the prefixes share and all that may follow the end of the first that ends
    both = 100 + threshold
    after = f"({2 * threshold} * n + {both - 1}) div {both} - ask"
    o_after = f"({threshold} * o_n + 99) div 100 - o_ask"
    return counted.filter("shared >= least(ask, o_ask)").filter(
        f"(shared + greatest({after}, {o_after})) * {both} >= {threshold} * (n + o_n)"
    ).select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b"))


def grouped_apart(
    docs: DataFrame, rows: DataFrame, classes: DataFrame, store: Store, shingler: Shingler,
    threshold: int, least: int = 32, sample: int = 24,
) -> DataFrame:
    """The differences of the classes in groups of ``least`` or more, from one text of each.

    Both numbers only decide which pairs are compared by differences, not what links.
    """
    members = store.put(gathered(rows.join(classes.select("node", "n"), "node"), least))
    texts = texts_of(docs, members.select(F.col("node").alias("a"), F.col("node").alias("b")), classes, store)
    common = store.put(common_sets(members, texts, shingler, least, sample))
    apart = store.put(differences(members, texts, common, shingler, threshold))
    store.drop(texts)
    return apart


def with_components(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket rows with their component, without buckets that lie in one component."""
    rows = rows.select("token", "node", "ask", "inner")
    if labels is None:
        rows = rows.withColumn("component", F.col("node"))
    else:
        rows = rows.join(labels, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    mixed = rows.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    return rows.join(mixed.filter("low != high").select("token"), "token")


def enough(rows: DataFrame) -> DataFrame:
    """Bucket rows without buckets that lie in one part, and without classes that then meet no other often enough.

    A class needs as many buckets as the least that any pair in them asks for.
    """
    mixed = rows.groupBy("token").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.min("ask").alias("least")
    ).filter("low != high")
    rows = rows.join(mixed.select("token", "least"), "token")
    met = rows.groupBy("node").agg(F.count(F.lit(1)).alias("met"), F.min("least").alias("least"))
    return rows.drop("least").join(met.filter("met >= least").select("node"), "node")


def jaccard_groups(
    spark: SparkSession,
    docs: DataFrame,
    words: int = 5,
    threshold: int = 75,
    most_frequent: int = 65_536,
    leader_rounds: int = 2,
) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, component_id, component), one for each row of ``docs``.

    Two documents link when 100 * shared >= threshold * union of their shingle
    sets; component_id is the smallest doc_id that links reach, the document's
    own included. Null and empty texts have no shingles, link with nothing and
    keep their own doc_id; a text of fewer words than a shingle is one shingle.
    Equal sets always share a component; repeated rows give repeated results.
    Null doc_ids are never the smallest, unless a component has no other. Very
    long texts are read whole. No rows give no rows; other columns are ignored.

    ``component`` names a component where ids can't; ``text_key`` is
    xxhash64(text). Sets are told apart, and candidates found, by 64-bit hashes; candidate
    pairs are verified on the shingles themselves. ``most_frequent`` bounds the
    table of frequent tokens that orders the prefixes, not the results.
    """
    store = Store(spark, "jaccard")
    shingler = Shingler(words)
    with arrow_rows(spark, 2000):
        return grouped(spark, docs, store, shingler, threshold, most_frequent, leader_rounds)


def grouped(
    spark: SparkSession, docs: DataFrame, store: Store, shingler: Shingler,
    threshold: int, most_frequent: int, leader_rounds: int,
) -> DataFrame:
    """The steps of ``jaccard_groups``; all that runs Python is written before it returns."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    seen = store.put(profiles(keyed, shingler))
    order = frequent(seen.filter("token is not null"), most_frequent, threshold)
    profile = seen.filter("token is null").select("doc_id", "text_key", "n_shingles", "node")

    classes = store.put(
        profile.filter("node is not null").groupBy("node").agg(
            F.min("text_key").alias("text_key"), F.max("n_shingles").alias("n"),
            F.min("doc_id").alias("component_id"),
        )
    )

    # a frequent token is spread over parts, since it surely has several classes
    hot = F.col("token").bitwiseAND(F.lit(1)) == 1
    part = F.when(hot, F.pmod(F.shiftright("node", 4), F.lit(64))).otherwise(F.lit(0))
    bucket = Window.partitionBy("token", "part")
    plain_node = F.col("node").bitwiseAND(F.lit(-16))
    buckets = store.put(
        prefixes(keyed.select("text"), shingler, order)
        .withColumn("part", part)
        .select(
            "token", "part", "node", F.min(plain_node).over(bucket).alias("low"), F.max(plain_node).over(bucket).alias("high")
        )
        .filter(hot | (F.col("low") != F.col("high")))
        .select("token", "part", "node")
        .distinct()  # rows of one token and part are together already
        .select(
            "token",
            plain_node.alias("node"),
            F.col("node").bitwiseAND(F.lit(7)).cast("int").alias("ask"),
            (F.col("node").bitwiseAND(F.lit(8)) != 0).alias("inner"),
        )
    )

    links, labels, apart, rows = None, None, None, buckets
    for turn in range(leader_rounds + 1):
        # components only grow, so what the last round left out stays out
        before, rows = rows, store.put(with_components(rows, labels))
        store.drop(before)
        if rows.isEmpty():
            break
        if turn < leader_rounds:
            pairs = best_leaders(rows)
            if turn == leader_rounds - 1:
                apart = grouped_apart(keyed, rows, classes, store, shingler, threshold)
                pairs = pairs.unionByName(links_to_least(of_components(apart, labels))).distinct()
        else:
            pairs = remaining_pairs(rows, apart, classes, store, threshold)
            if apart is not None:
                pairs = pairs.unionByName(differing_pairs(of_components(apart, labels), store, threshold))
        pairs = store.put(of_like_size(pairs, classes, threshold))
        if not pairs.isEmpty():
            texts = texts_of(keyed, pairs, classes, store)
            found = store.put(verified(pairs, texts, shingler, threshold))
            links = found if links is None else links.unionByName(found)
            labels = connected_components(links, store)
            store.drop(texts)

    classes = classes.select("node", "component_id").withColumn("component", F.col("node"))
    if labels is not None:
        rooted = classes.drop("component").join(labels, "node", "left")
        rooted = rooted.withColumn("component", F.coalesce("root", "node"))
        roots = rooted.groupBy("component").agg(F.min("component_id").alias("least"))
        classes = rooted.join(roots, "component").select(
            "node", F.col("least").alias("component_id"), "component"
        )
    return profile.join(classes, "node", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) at five words and a similarity of 0.75."""
    return jaccard_groups(spark, docs.select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id"
    )


def first_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, null last.

    Rows without words belong to no component and all stay.
    """
    groups = jaccard_groups(spark, docs.select("doc_id", "text")).filter("component is not null")
    best = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")
    )
    key = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text"))
    winners = best.select(F.xxhash64("best.doc_id", "best.text_key").alias("_key"))
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = (
        docs.filter(~wordless).withColumn("_key", key).join(winners, "_key", "left_semi")
        .dropDuplicates(["_key"]).drop("_key")
    )
    return kept.unionByName(docs.filter(wordless))
