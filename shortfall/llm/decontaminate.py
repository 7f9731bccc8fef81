"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are sequences of words. The CGK embedding copies a word and, by a random
bit of the word and the step, stays on it or goes on; two sequences at a small
edit distance walk in step most of the time, so that their embeddings have a
small Hamming distance. Tables of a few sampled steps of several walks then
find an item's windows, and the exact edit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm.words import word_hashes

#: ASCII letters in lower case, digits, bytes of other scripts; all else parts words.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
MIX = np.uint64(0x9E3779B97F4A7C15)
PAD = np.uint64(0)


def tokens(text: str | None) -> np.ndarray:
    """Hashed words of a text."""
    return word_hashes(text.encode("utf-8", "surrogatepass").translate(PLAIN) if text else b"")


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on."""
    out = ids[: len(ids) - k + 1].copy()
    for i in range(1, k):
        out = (out ^ (out >> np.uint64(31))) * MIX + ids[i : len(ids) - k + 1 + i]
    return out


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int]:
    """Least edit distance of ``a`` to a start of ``b``, and that start's length.

    Distances over ``most`` are given as ``most + 1``.
    """
    row = np.arange(len(b) + 1)
    steps = np.arange(len(b) + 1)
    for i, word in enumerate(a, 1):
        change = np.empty_like(row)
        change[0] = i
        change[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != word))
        row = np.minimum.accumulate(change - steps) + steps
        if row.min() > most:
            return most + 1, 0
    end = int(row.argmin())
    return min(int(row[end]), most + 1), end


@dataclass
class Walks:
    """CGK walks and the sampled steps of each hash table."""

    walks: int = 6
    tables: int = 24
    sampled: int = 3
    seed: int = 11

    def steps(self, length: int) -> list[np.ndarray]:
        """Sampled steps of each table for windows of ``length`` words."""
        rng = np.random.default_rng(self.seed * 1000 + length)
        return [np.sort(rng.choice(3 * length, self.sampled, replace=False)) for _ in range(self.tables)]

    def signatures(
        self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int
    ) -> np.ndarray:
        """Signature in each table of the windows from ``starts`` to ``ends``."""
        chosen = self.steps(length)
        padded = np.concatenate([ids, np.zeros(1, np.uint64)])
        out = np.zeros((len(starts), self.tables), np.uint64)
        for walk in range(self.walks):
            wanted: dict[int, list[int]] = {}
            for t in range(walk, self.tables, self.walks):
                for step in chosen[t].tolist():
                    wanted.setdefault(step, []).append(t)
            at = starts.copy()
            for step in range(max(wanted) + 1):
                word = np.where(at < ends, padded[np.minimum(at, len(ids))], PAD)
                for t in wanted.get(step, ()):
                    out[:, t] = (out[:, t] ^ word) * MIX + (word >> np.uint64(33))
                bit = (word * np.uint64(2 * (step * self.walks + walk) + 1) * MIX) >> np.uint64(63)
                at += ((bit == 1) & (at < ends)).astype(at.dtype)
        return out


@dataclass
class Benchmark:
    """Items, their signatures and the word runs that any near copy keeps.

    ``error``: edits allowed, as a share of an item's words. Of the n - k + 1
    runs of k words of an item each edit breaks k at most, and e edits shift
    the rest by e words at most. A window that aligns fewer runs than remain
    can't be within the limit and isn't embedded; this loses no leak.
    The item table is held by every task: it must be a benchmark, not a corpus.
    """

    items: dict[int, np.ndarray]
    error: float = 0.25
    walks: Walks = field(default_factory=Walks)
    runs: dict = field(default_factory=dict)
    signed: dict = field(default_factory=dict)

    def allowed(self, n: int) -> int:
        return int(self.error * n)

    def run(self, n: int) -> int:
        e = self.allowed(n)
        return min(4, -(-(n - e) // (e + 1)))

    def prepare(self) -> Benchmark:
        """Index the items' runs by length, and sign the items."""
        found: dict[int, list] = {}
        for item, ids in self.items.items():
            k = self.run(len(ids))
            hashes = grams(ids, k)
            found.setdefault(k, []).append((hashes, item, np.arange(len(hashes))))
            self.signed[item] = self.walks.signatures(
                ids, np.zeros(1, np.int64), np.array([len(ids)]), len(ids)
            )[0]
        for k, parts in found.items():
            hashes = np.concatenate([p[0] for p in parts])
            owner = np.concatenate([np.full(len(p[0]), p[1], np.int64) for p in parts])
            offset = np.concatenate([p[2] for p in parts])
            order = np.argsort(hashes, kind="stable")
            self.runs[k] = (hashes[order], owner[order], offset[order])
        return self

    def windows(self, ids: np.ndarray) -> dict[int, np.ndarray]:
        """Starts of windows to embed, by item: those that align enough runs, one word about."""
        out: dict[int, np.ndarray] = {}
        for k, (hashes, owner, offset) in self.runs.items():
            if len(ids) < k:
                continue
            got = grams(ids, k)
            low = np.searchsorted(hashes, got, "left")
            low[low == len(hashes)] = 0
            hit = np.flatnonzero(hashes[low] == got)
            if not len(hit):
                continue
            low = low[hit]
            times = np.searchsorted(hashes, got[hit], "right") - low
            entry = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
            starts, owners = np.repeat(hit, times) - offset[entry], owner[entry]
            order = np.lexsort((starts, owners))
            starts, owners = starts[order], owners[order]
            first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            for low, high in zip(first, np.r_[first[1:], len(owners)]):
                item = int(owners[low])
                n = len(self.items[item])
                e = self.allowed(n)
                least = max(1, n - k + 1 - k * e)
                if high - low < least:
                    continue
                mine = starts[low:high]
                close = np.flatnonzero(mine[least - 1 :] - mine[: len(mine) - least + 1] <= 2 * e)
                if len(close):
                    near = np.unique(np.concatenate([mine[close + i] for i in range(least)]))
                    out[item] = np.unique(np.maximum((near[:, None] + np.arange(-1, 2)).ravel(), 0))
        return out

    def matches(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item, distance, first word, end) of the best window of each leaked item.

        The windows of all texts that have one length are embedded together.
        """
        out: list[dict] = [{} for _ in texts]
        todo: dict[int, list] = {}
        for text, ids in enumerate(texts):
            for item, starts in self.windows(ids).items():
                n = len(self.items[item])
                starts = starts[starts + (n - self.allowed(n)) <= len(ids)]
                if len(starts):
                    todo.setdefault(n, []).append((text, item, starts))
        for n, parts in todo.items():
            used = sorted({text for text, _, _ in parts})
            base = dict(zip(used, np.cumsum([0] + [len(texts[t]) for t in used[:-1]])))
            ids = np.concatenate([texts[t] for t in used])
            starts = np.concatenate([base[t] + s for t, _, s in parts])
            limit = np.concatenate([np.full(len(s), base[t] + len(texts[t])) for t, _, s in parts])
            signed = self.walks.signatures(ids, starts, np.minimum(starts + n, limit), n)
            at = 0
            for text, item, mine in parts:
                same = (signed[at : at + len(mine)] == self.signed[item]).any(axis=1)
                at += len(mine)
                most = self.allowed(n)
                for start in mine[same]:
                    distance, length = edit_distance(
                        self.items[item], texts[text][start : start + n + most], most
                    )
                    if distance <= most and (item not in out[text] or distance < out[text][item][1]):
                        out[text][item] = (item, distance, int(start), int(start) + length)
        return [[found[item] for item in sorted(found)] for found in out]


def load(benchmark: DataFrame, error: float = 0.25, walks: Walks | None = None) -> Benchmark:
    """Items of a benchmark table; null and wordless items are left out.

    Rows are merged by text, the smallest item_id standing for equal items.
    """
    items, seen = {}, set()
    rows = benchmark.select("item_id", "text").filter("item_id is not null").collect()
    for row in sorted(rows, key=lambda r: r.item_id):
        ids = tokens(row.text)
        if len(ids) and ids.tobytes() not in seen:
            seen.add(ids.tobytes())
            items[int(row.item_id)] = ids
    return Benchmark(items, error, walks or Walks()).prepare()


LEAKS = "array<struct<item_id:long,distance:int,first_word:long,end_word:long>>"


def find_leaks(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """``docs`` with an array ``_leaks`` of the items found in each text, empty where clean.

    A leak is a run of words within ``error`` times the item's words of edit
    distance of an item. Null and empty texts are clean; long ones are read
    whole; repeated rows get equal results; ties go to the first window. An
    empty benchmark leaves all clean. Other columns stay as they are.
    """

    @F.pandas_udf(LEAKS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = []
            for low in range(0, len(texts), 10_000):
                part = texts.iloc[low : low + 10_000]
                found += bench.matches([tokens(t) for t in part])
            names = ("item_id", "distance", "first_word", "end_word")
            yield pd.Series([[dict(zip(names, m)) for m in ms] for ms in found], dtype=object)

    return docs.withColumn("_leaks", search(F.col("text")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, distance, first_word, end_word) of every leaked item of every document."""
    found = find_leaks(docs.select("doc_id", "text"), load(benchmark))
    return found.select("doc_id", F.explode("_leaks").alias("leak")).select("doc_id", "leak.*")
