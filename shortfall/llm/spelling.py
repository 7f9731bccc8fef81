"""Spelling variants: words one edit apart, found through a reduced alphabet."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.llm.base import Store

#: A run of letters: a to z and U+00C0 to U+00FF, as UTF-8 after lower-casing A to Z.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: A byte that no run holds: texts are cut there without touching a run.
BREAK = re.compile(rb"[^a-z\xc3\x80-\xbf]")
LETTERS = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]
SYMBOLS = "0123456789abcdefghijklmnopqrstuv"


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The whole text in pieces of about ``size`` bytes, cut between runs."""
    start = 0
    while len(data) - start > size:
        gap = BREAK.search(data, start + size)
        if gap is None:
            break
        yield data[start : gap.start()]
        start = gap.start()
    yield data[start:]


def damaged(run: bytes, check: int) -> bytes:
    """``run`` without its code point number ``check`` modulo its length."""
    letters = run.decode()
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def count_words(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, damage: int | None = None, held: int = 1 << 18
) -> DataFrame:
    """Rows (word, n): the letter runs of whole texts, A to Z lower-cased, with their occurrences.

    Words have ``min_length`` code points and ``min_count`` occurrences at least.
    With ``damage``, a run loses a letter where that number divides the crc32 of
    ``<doc_id>:<run>``, so that variants with a known origin exist. Null texts
    hold no words, a null id counts as empty text, repeated rows count again, an
    empty table gives none. Long texts are read piece by piece; a task holds
    ``held`` words and those of one piece, adds up before it shuffles, and sends
    every word on.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if len(w) - w.count(b"\xc3") >= min_length}
            total.clear()
            words = pa.array(list(kept), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(kept.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{doc}:".encode())
                for piece in pieces((data.as_py() or b"").lower()):
                    found = Counter(RUN.findall(piece))
                    if damage:
                        for run, n in found.items():
                            check = zlib.crc32(run, start)
                            total[damaged(run, check) if check % damage == 0 else run] += n
                    else:
                        total.update(found)
                    if len(total) > held:
                        yield flush()
        yield flush()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    words = rows.mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= min_count)


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter hashed to one of ``symbols`` symbols."""
    image = "".join(SYMBOLS[zlib.crc32(c.encode()) % symbols] for c in LETTERS)
    return F.translate(word, "".join(LETTERS), image)


def neighbourhood(word: Column, symbols: int) -> Column:
    """The reduced words at most one edit away from a reduced word, each pair named by one of its sides.

    The word itself, all deletions, and all replacements that sort before it: an
    insertion is a deletion of the longer side, a replacement that sorts behind
    is made by the other side.
    """
    places = F.sequence(F.lit(1), F.length(word))

    def around(at: Column, middle: Column) -> Column:
        return F.concat(F.substr(word, F.lit(1), at - 1), middle, F.substr(word, at + 1))

    alphabet = F.array(*[F.lit(s) for s in SYMBOLS[:symbols]])
    deleted = F.array_distinct(F.transform(places, lambda at: around(at, F.lit(""))))
    smaller = F.transform(
        places,
        lambda at: F.transform(
            F.filter(alphabet, lambda s: s < F.substr(word, at, F.lit(1))), lambda s: around(at, s)
        ),
    )
    return F.concat(F.array(word), deleted, F.flatten(smaller))


def near_pairs(vocabulary: DataFrame, store: Store, symbols: int = 8) -> DataFrame:
    """Rows (word, n, near, near_n) of words exactly one edit apart, in both directions.

    Two words one edit apart have reduced words at most one edit apart. So the
    neighbourhoods of the distinct reduced words are joined with the reduced
    words themselves, the pairs found with the words behind them, and each pair
    is verified on the original strings. More ``symbols`` make neighbourhoods
    larger and chance pairs fewer.
    """
    if not 2 <= symbols <= len(SYMBOLS):
        raise ValueError(f"symbols must lie between 2 and {len(SYMBOLS)}")
    words = store.put(vocabulary.select("word", "n", reduced(F.col("word"), symbols).alias("short")))
    shorts = words.select("short").distinct()
    made = shorts.select("short", F.explode(neighbourhood(F.col("short"), symbols)).alias("other"))
    met = made.join(shorts.select(F.col("short").alias("other")), "other")
    left = words.select("short", "word", "n")
    right = words.select(F.col("short").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    candidates = met.join(left, "short").join(right, "other")
    distinct = (F.col("short") != F.col("other")) | (F.col("word") < F.col("near"))
    pairs = candidates.filter(distinct & (F.levenshtein("word", "near", 1) == 1))
    both = F.explode(
        F.array(
            F.struct("word", "n", "near", "near_n"),
            F.struct(
                F.col("near").alias("word"),
                F.col("near_n").alias("n"),
                F.col("word").alias("near"),
                F.col("n").alias("near_n"),
            ),
        )
    )
    return pairs.select(both.alias("pair")).select("pair.*")


def variant_groups(
    spark: SparkSession, vocabulary: DataFrame, ratio: int = 5, symbols: int = 8, store: Store | None = None
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of a vocabulary (word, n) of distinct words.

    A word's form is the near word (one edit away) of largest n, the first in
    code-point order among equals, if that n is at least ``ratio`` times its
    own; its root is where following forms ends. Words without near words have
    n_near 0, no form, and are their own root; an empty vocabulary gives no
    rows; null words take no part; columns beyond the two are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms could run in a circle")
    store = store or Store(spark, "spelling")
    words = store.put(vocabulary.select("word", "n").filter(F.col("word").isNotNull()))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    judged = near_pairs(words, store, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    fits = -F.col("best.rank") >= ratio * F.col("n")
    rows = store.put(
        words.join(judged, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"),
            F.when(fits, -F.col("best.rank")).alias("form_n"),
        )
    )
    # counts grow by the ratio with every form, so the largest count bounds the length of a chain
    most, least = rows.agg(F.max("n"), F.min("n")).first()
    longest = int(math.log(most / least, ratio) + 1e-9) if most else 0
    roots = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(longest - 1, 0).bit_length()):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = store.put(
            roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        )
    found = rows.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(spark: SparkSession, docs: DataFrame, damage: int | None = 199) -> DataFrame:
    """The vocabulary of the documents with each word's form and root."""
    return variant_groups(spark, count_words(docs, damage=damage))
