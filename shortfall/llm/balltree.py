"""Ranked lexical search: exact inner products over sparse ball trees."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store

#: A term: ASCII letters and digits and everything beyond ASCII, as UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

SCALE = 1_000_000_000
SATURATION, LENGTH_SHARE = 20, 50  # k1 = 1.2 and b = 0.5 of the usual form, in whole numbers
EXACT = 1 << 53  # whole numbers below it are exact in doubles


def terms(data: bytes, size: int = 1 << 20) -> Counter[bytes]:
    """Terms of a whole text with their occurrences, read in pieces cut between terms."""
    found: Counter[bytes] = Counter()
    data = data.lower()
    start = 0
    while len(data) - start > size:
        gap = GAP.search(data, start + size)
        if gap is None:
            break
        found.update(TERM.findall(data, start, gap.start()))
        start = gap.start()
    found.update(TERM.findall(data, start))
    return found


@dataclass
class Items:
    """A block of queries: item ids, term numbers of each, all terms of the block."""

    ids: list
    members: list[list[int]]
    words: dict[bytes, int]
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @classmethod
    def of(cls, rows: list) -> Items:
        words: dict[bytes, int] = {}
        members = []
        for row in rows:
            found = sorted(terms((row.text or "").encode()))
            members.append([words.setdefault(t, len(words)) for t in found])
        return cls([row.item_id for row in rows], members, words)


def term_rows(docs: DataFrame, items: Items) -> DataFrame:
    """Rows (doc_id, n, term, tf) of all documents: length and the terms that an item of the block asks for."""
    words = items.words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers, times = [], [], []
            for data in batch.column(1):
                found = terms(data.as_py() or b"")
                lengths.append(found.total())
                known = sorted((words[t], n) for t, n in found.items() if t in words)
                numbers.append([k for k, _ in known])
                times.append([n for _, n in known])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(numbers, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "term", "tf"],
            )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n long, term array<int>, tf array<long>")


def weighted(items: Items, rows: DataFrame, n_docs: int) -> Items:
    """The block with the weight of each term, from the counts of all documents."""
    seen = rows.select(F.explode("term").alias("term")).groupBy("term").count().collect()  # one row a term of the block
    df = np.zeros(len(items.words), np.int64)
    for term, n in seen:
        df[term] = n
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    return Items(items.ids, items.members, items.words, np.array(weights, np.int64))


@dataclass
class Node:
    """A ball: rows ``low`` to ``high`` of the tree's order, its radius, its halves."""

    low: int
    high: int
    radius: float = 0.0
    halves: tuple[int, int] | None = None


class BallTree:
    """Sparse rows in balls round their centroids, halved until they hold ``leaf`` rows.

    The space is that of impacts times the root of the term weights, so that an
    item's vector is the root of the weights of its terms and inner products are
    the scores. Doubles serve the bounds only; scores at the leaves are exact.

    Documents differ in many rare terms, so one radius over all terms bounds
    little. Each ball therefore also has a radius on the axis of each term: how
    far a row reaches beyond the centroid there (upwards only, since items have
    no negative part). The sum of these bounds and the bound of the whole radius
    both hold; the smaller one counts.
    """

    def __init__(self, starts, columns, impacts, weights, leaf: int = 32):
        self.columns_used, local = np.unique(columns, return_inverse=True)
        self.width = len(self.columns_used)
        self.starts, self.columns, self.impacts = starts, local.astype(np.int64), impacts
        scale = np.sqrt(weights[self.columns_used].astype(float))
        self.values = impacts * scale[self.columns]
        self.rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.norms = np.bincount(self.rows, self.values**2, len(starts) - 1)
        self.order = np.arange(len(starts) - 1)
        self.nodes: list[Node] = []
        self.centres: list[np.ndarray] = []
        self.peaks: list[np.ndarray] = []  # centroid and radius on each axis, added up
        self._grow(0, len(self.order), leaf)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and which of these rows each belongs to."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), lengths)
        first = np.cumsum(lengths) - lengths
        return np.arange(lengths.sum()) - first[owner] + self.starts[rows][owner], owner

    def _distances(self, at, owner, rows, point: np.ndarray) -> tuple[np.ndarray, float]:
        """Squared distances of rows to a point, and the size that rounding errors are relative to."""
        inner = np.bincount(owner, self.values[at] * point[self.columns[at]], len(rows))
        length = float(point @ point)
        return self.norms[rows] - 2 * inner + length, length

    def _grow(self, low: int, high: int, leaf: int) -> int:
        rows = self.order[low:high]
        at, owner = self._entries(rows)
        centre = np.bincount(self.columns[at], self.values[at], self.width) / len(rows)
        far, length = self._distances(at, owner, rows, centre)
        # rounding of sums of at most some thousand terms stays far below one part in 10^9
        slack = 1e-9 * (float(self.norms[rows].max()) + length)
        node = Node(low, high, math.sqrt(max(float(far.max()), 0.0) + slack) * (1 + 1e-9))
        number = len(self.nodes)
        self.nodes.append(node)
        self.centres.append(centre)
        self.peaks.append(np.zeros(self.width))
        if high - low <= leaf:
            np.maximum.at(self.peaks[number], self.columns[at], self.values[at])
        else:
            ends = []
            for source in (far, None):
                if source is None:
                    source, _ = self._distances(at, owner, rows, ends[0])
                top = int(np.argmax(source))
                point = np.zeros(self.width)
                mine = slice(*np.searchsorted(owner, [top, top + 1]))
                point[self.columns[at[mine]]] = self.values[at[mine]]
                ends.append(point)
            side = self._distances(at, owner, rows, ends[0])[0] - self._distances(at, owner, rows, ends[1])[0]
            self.order[low:high] = rows[np.argsort(side, kind="stable")]
            middle = (low + high) // 2
            node.halves = (self._grow(low, middle, leaf), self._grow(middle, high, leaf))
            np.maximum(*(self.peaks[half] for half in node.halves), out=self.peaks[number])
        return number

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """An upper bound of each query's inner products in each ball (balls x queries), rounded up."""
        radii = np.array([n.radius for n in self.nodes])
        whole = np.stack(self.centres) @ queries.T + np.outer(radii, np.sqrt((queries**2).sum(1)))
        by_term = np.stack(self.peaks) @ queries.T
        return np.minimum(whole, by_term) * (1 + 1e-9) + 1e-6

    def leaf_matrix(self, node: Node) -> tuple[np.ndarray, np.ndarray]:
        """The columns a leaf uses and its impacts in them."""
        rows = self.order[node.low : node.high]
        at, owner = self._entries(rows)
        used, local = np.unique(self.columns[at], return_inverse=True)
        out = np.zeros((len(rows), len(used)), np.int64)
        out[owner, local] = self.impacts[at]
        return used, out


class Turned:
    """A doc_id that compares the other way round, null first: in a heap of the best, the last of equals is least."""

    __slots__ = ("doc",)

    def __init__(self, doc):
        self.doc = doc

    def __lt__(self, other: Turned) -> bool:
        if self.doc is None or other.doc is None:
            return self.doc is None and other.doc is not None
        return other.doc < self.doc

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Turned) and self.doc == other.doc


class Search:
    """The best documents of every item of a block, carried on from tree to tree."""

    def __init__(self, items: Items, n_docs: int, n_terms: int, top: int, leaf: int = 32):
        self.items, self.n_docs, self.n_terms, self.top, self.leaf = items, n_docs, n_terms, top, leaf
        self.best: list[list[tuple[int, Turned]]] = [[] for _ in items.ids]  # heaps, the least in front
        self.met = self.scored = 0  # pairs of item and document in the trees; those scored at leaves
        heaviest = max((int(items.weights[m].sum()) for m in items.members), default=0)
        # impacts are below SCALE / 1000; whole numbers below 2^53 are exact in doubles, which multiply faster
        self.kind = np.float64 if heaviest * (SCALE // 1000) < EXACT else np.int64

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * self.n_docs) // self.n_terms
        return (SCALE * tf) // (1000 * tf + SATURATION * m)

    def add(self, ids: list, n: np.ndarray, starts: np.ndarray, columns: np.ndarray, tf: np.ndarray) -> None:
        """Search a block of documents: ids, lengths and the terms they hold, row by row from ``starts``."""
        impacts = self.impacts(tf, np.repeat(n, np.diff(starts)))
        tree = BallTree(starts, columns, impacts, self.items.weights, self.leaf)
        whole = np.zeros((len(self.items.ids), len(self.items.weights)), np.int64)
        for i, members in enumerate(self.items.members):
            whole[i, members] = self.items.weights[members]
        whole = whole[:, tree.columns_used]
        bounds = tree.bounds(np.sqrt(whole.astype(float)))
        weights = whole.astype(self.kind)
        leaves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in np.flatnonzero(whole.any(1)).tolist():
            self.met += len(ids)
            reach = bounds[:, i].tolist()
            heap = [(-reach[0], 0)]
            while heap and -heap[0][0] >= self.least(i):  # best first: no other ball reaches further
                _, at = heapq.heappop(heap)
                node = tree.nodes[at]
                if node.halves:
                    for half in node.halves:
                        if reach[half] >= self.least(i):
                            heapq.heappush(heap, (-reach[half], half))
                    continue
                if at not in leaves:
                    used, matrix = tree.leaf_matrix(node)
                    leaves[at] = used, matrix.astype(self.kind)
                used, matrix = leaves[at]
                self.scored += len(matrix)
                scores = (matrix @ weights[i, used]).astype(np.int64)
                self.keep(i, scores, tree.order[node.low : node.high], ids)

    def least(self, item: int) -> int:
        """A score that a further document must reach."""
        best = self.best[item]
        return best[0][0] if len(best) == self.top else 1

    def keep(self, item: int, scores: np.ndarray, rows: np.ndarray, ids: list) -> None:
        best = self.best[item]
        for at in np.flatnonzero(scores >= self.least(item)).tolist():
            entry = (int(scores[at]), Turned(ids[rows[at]]))
            if len(best) < self.top:
                heapq.heappush(best, entry)
            elif best[0] < entry:
                heapq.heapreplace(best, entry)


def best_rows(
    rows: DataFrame, items: Items, n_docs: int, n_terms: int, top: int, block: int = 8192, leaf: int = 32
) -> DataFrame:
    """Rows (item, doc_id, score): for each task and item the best documents among the task's ``term_rows``."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(items, n_docs, n_terms, top, leaf)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            step = math.ceil(batch.num_rows / math.ceil(max(batch.num_rows, 1) / block))
            for low in range(0, batch.num_rows, max(step, 1)):
                part = batch.slice(low, step)
                lists = part.column(2)
                state.add(
                    part.column(0).to_pylist(),
                    part.column(1).to_numpy(),
                    np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].astype(np.int64),
                    lists.flatten().to_numpy().astype(np.int64),
                    part.column(3).flatten().to_numpy(),
                )
        if id_type is None:
            return
        found = [(i, turned.doc, score) for i, best in enumerate(state.best) for score, turned in best]
        columns = list(zip(*found)) or [(), (), ()]
        kinds = (pa.int32(), id_type, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc_id", "score"])

    return rows.filter(F.size("term") > 0).mapInArrow(search, f"item int, doc_id {kind}, score long")


def item_blocks(items: DataFrame, most_items: int, most_bytes: int) -> Iterator[Items]:
    """The queries in blocks of bounded number and bytes, read one after another."""
    rows: list = []
    size = 0
    for row in items.select("item_id", "text").toLocalIterator():
        here = len((row.text or "").encode())
        if rows and (len(rows) == most_items or size + here > most_bytes):
            yield Items.of(rows)
            rows, size = [], 0
        rows.append(row)
        size += here
    if rows:
        yield Items.of(rows)


def best_of(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The ``top`` rows of each key with their rank: highest score, then doc_id, null last."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(32))
    for more in ([part], []):  # first in parts of each key: as many rows as there are tasks meet there
        rank = F.row_number().over(Window.partitionBy(*keys, *more).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    return rows


def ranked(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    top: int = 50,
    most_items: int = 512,
    most_bytes: int = 1 << 20,
    store: Store | None = None,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``top`` documents of each item, scores above 0.

    Documents are read once for each block of items, whole texts, and reduced to
    the terms that the block asks for. Each task builds ball trees over its
    blocks of documents and searches them with every item of the block, keeping
    the scores found so far as a bar for later trees; a ball whose bound stays
    below the bar is left out with all below it. Equal scores rank by ascending
    doc_id, a null id last. A null or term-less text is no document and no
    query; repeated rows, documents and items, count and rank each by itself;
    an empty table gives no rows; other columns are ignored. A block holds
    ``most_items`` items and ``most_bytes`` bytes of them at most, or one item;
    any number of blocks runs, so every item is ranked.
    """
    if top < 1:
        raise ValueError("top must be positive")
    store = store or Store(spark, "search")
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {item_kind}, rank int, doc_id {kind}, score long"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items, most_items, most_bytes):
        rows = store.put(term_rows(docs, block))
        n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_terms or not block.words:
            continue
        block = weighted(block, rows, n_docs)
        found = best_of(best_rows(rows, block, n_docs, n_terms, top), ["item"], top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {item_kind}")
        found = store.put(found.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
        out = out.unionByName(found)
    return out
