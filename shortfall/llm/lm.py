"""Log-bilinear language model trained by noise-contrastive estimation.

Exact counts. Words are keyed by 64-bit hashes. A bounded table of frequent
words is counted task by task; every other word goes through one shuffle by
key, where its training count meets the texts that hold it. So counts cover
all tokens, and no table of the vocabulary is held by a task or the driver.

Model. Its symbols are the end, the most frequent words and 64 classes of all
other words by their last two bytes. The next symbol's score is bilinear in
the two symbols before it; batched matrix products over all pairs of contexts
give every normaliser. A word of a class gets its class's probability times
its share of the class, (c + 1) / (N_class + V_class + 1), where one more
share stands for all unseen words of the class: probabilities sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.llm.base import Store, arrow_rows, crc_mod
from shortfall.llm.words import IS_SPACE, TABLE

CLASSES = 64
SLOT_BITS = 22
#: Kinds of the rows that the counting pass gives.
HEAD, MARK, TAIL, WINDOW, CLASS = range(5)
ROWS = "kind int, key long, text long, n int"
#: The same with a column for windows in blocks: their keys, then their numbers, as bytes.
BLOCK_ROWS = ROWS + ", block binary"
BLOCK = 8192
CHUNK = 1 << 20
#: Windows of a batch that are added up at once.
HELD = 1 << 22


def keyed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(key, start) of each word; the low six bits of a key are its class."""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(~IS_SPACE[raw])
    if not len(at):
        return np.empty(0, np.uint64), at
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    bounds = np.r_[first, len(at)]
    place = at - np.repeat(at[first], np.diff(bounds))
    value = TABLE[((place & 255) << 8) | raw[at]]
    if place.max() > 255:
        value = value * ((place >> 8) * 2 + 1).astype(np.uint64)
    hashed = np.add.reduceat(value, first)
    end = bounds[1:] - 1
    last, before = raw[at[end]].astype(np.uint64), raw[at[np.maximum(end - 1, first)]].astype(np.uint64)
    ending = ((last * np.uint64(256) + before + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    return (hashed & ~np.uint64(CLASSES - 1)) | ending, at[first]


@dataclass
class Chunk:
    """Some texts: their words' keys and texts, all in order."""

    keys: np.ndarray
    owner: np.ndarray
    texts: np.ndarray
    training: np.ndarray


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, slice]]:
    """Texts of a batch in chunks of about a megabyte; a longer text is one of its own."""
    ids = batch.column("key").to_numpy(zero_copy_only=False)
    training = batch.column("training").to_numpy(zero_copy_only=False)
    column = batch.column("text")
    low, held, size = 0, [], 0
    for i in range(batch.num_rows + 1):
        if i == batch.num_rows or (held and size > CHUNK):
            if held:
                starts = np.cumsum([0] + [len(h) + 1 for h in held[:-1]])
                keys, at = keyed_words(b" ".join(held))
                owner = np.searchsorted(starts, at, "right") - 1
                part = slice(low, low + len(held))
                yield Chunk(keys, owner, ids[part], training[part]), part
            low, held, size = i, [], 0
        if i < batch.num_rows:
            text = column[i].as_py()
            held.append(text.encode("utf-8", "surrogatepass").lower() if text else b"")
            size += len(held[-1])


@dataclass
class Head:
    """The frequent words: an index by the low bits of a mixed key; who finds its slot taken is no head word."""

    keys: np.ndarray
    index: np.ndarray

    def __getstate__(self) -> dict:
        return {"keys": self.keys}  # the index is made again where it is needed

    def __setstate__(self, state: dict) -> None:
        self.keys = state["keys"]
        self.index = self.indexed(self.keys)

    @classmethod
    def indexed(cls, keys: np.ndarray) -> np.ndarray:
        index = np.full(1 << SLOT_BITS, -1, np.int32)
        index[cls.slots(keys)] = np.arange(len(keys), dtype=np.int32)
        return index

    @classmethod
    def of(cls, ranked: np.ndarray) -> Head:
        """From distinct keys, most frequent first."""
        slots = cls.slots(ranked)
        _, first = np.unique(slots, return_index=True)
        keys = ranked[np.sort(first)]
        return cls(keys, cls.indexed(keys))

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Head number of each key, -1 for others."""
        at = self.index[self.slots(keys)]
        if not len(self.keys):
            return at
        return np.where((at >= 0) & (self.keys[np.maximum(at, 0)] == keys), at, -1)


def batch_of(kind: int, key: np.ndarray, text: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    size = len(key)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, kind, np.int32)),
            pa.array(key.astype(np.uint64).view(np.int64) if key.dtype == np.uint64 else key.astype(np.int64)),
            pa.nulls(size, pa.int64()) if text is None else pa.array(text.astype(np.int64)),
            pa.array(n.astype(np.int32)),
        ],
        names=["kind", "key", "text", "n"],
    )


def least_cut(rows: DataFrame, value: str, room: int, high: int, parts: int = 4096) -> tuple[int, int]:
    """The least t with at most ``room`` rows of ``value`` >= t, and the number of these rows.

    Values are whole numbers from 0 up to ``high``. Each pass counts the rows in
    ``parts`` equal ranges and goes on in the one where the room runs out, so
    the driver receives that many numbers, however many rows there are.
    """
    low, high, above = 0, high + 1, 0
    while True:
        width = -(-(high - low) // parts)
        at = F.floor((F.col(value) - low) / width).alias("at")
        inside = rows.filter((F.col(value) >= low) & (F.col(value) < high))
        counts = {r["at"]: r["count"] for r in inside.groupBy(at).count().collect()}
        for part in sorted(counts, reverse=True):
            if above + counts[part] > room:
                break
            above += counts[part]
        else:
            return low, above
        low, high = low + part * width, min(high, low + (part + 1) * width)
        if width == 1:
            return high, above


def frequent_words(texts: DataFrame, most: int, store: Store | None = None) -> Head:
    """The head: the most frequent words by their exact counts in all training texts.

    The model's words are the first of it, so its order must not depend on how
    rows fall into batches: every word of a batch goes into the sum. The driver
    receives the words chosen, ``most`` at most, and a few thousand counts: the
    least count that fits is found first, then which of the words that have
    one less still do, those of least key first.
    """
    store = store or Store(texts.sparkSession, "lm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [c.keys[c.training[c.owner]] for c, _ in chunks(batch)]
            keys, counts = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_counts=True)
            yield batch_of(HEAD, keys, None, counts)

    counted = store.put(texts.mapInArrow(run, ROWS).groupBy("key").agg(F.sum("n").alias("n")))
    types, highest = counted.agg(F.count(F.lit(1)), F.max("n")).first()
    chosen = counted
    if types > most:
        least, taken = least_cut(counted, "n", most, highest)
        chosen = counted.filter(F.col("n") >= least)
        tied = counted.filter(F.col("n") == least - 1)
        halves = (1 << 31) - 1 - F.shiftright("key", 32), (1 << 32) - 1 - F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
        for half in halves:  # least keys first: by the upper bits, then the lower
            tied = tied.withColumn("turn", half)
            turn, more = least_cut(tied, "turn", most - taken, (1 << 32) - 1)
            taken += more
            chosen = chosen.unionByName(tied.filter(F.col("turn") >= turn).drop("turn"))
            tied = tied.filter(F.col("turn") == turn - 1)
    top = chosen.select("key", "n").toArrow()
    keys, n = top["key"].to_numpy(), top["n"].to_numpy()
    return Head.of(keys[np.lexsort((keys, -n))].view(np.uint64))


@dataclass
class Symbols:
    """Numbers of the model's symbols: 0 the end, words from 1 on, then classes, then the start."""

    head: Head
    words: int

    @property
    def outputs(self) -> int:
        return 1 + self.words + CLASSES

    @property
    def start(self) -> int:
        return self.outputs

    def of(self, keys: np.ndarray, found: np.ndarray) -> np.ndarray:
        return np.where(
            (found >= 0) & (found < self.words),
            found + 1,
            1 + self.words + (keys & np.uint64(CLASSES - 1)).astype(np.int64),
        )

    def stream(self, chunk: Chunk, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, the one before, the one before that, text) of each token, ends included."""
        texts = len(chunk.texts)
        sizes = np.bincount(chunk.owner, minlength=texts) + 1
        ends = np.cumsum(sizes) - 1
        symbol = np.zeros(int(sizes.sum()), np.int64)
        symbol[np.arange(len(chunk.keys)) + chunk.owner] = self.of(chunk.keys, found)
        owner = np.repeat(np.arange(texts), sizes)
        begin = ends - sizes + 1
        one, two = np.r_[self.start, symbol[:-1]], np.r_[self.start, self.start, symbol[:-2]][: len(symbol)]
        one[begin] = self.start
        two[begin] = self.start
        second = begin[sizes > 1] + 1
        two[second] = self.start
        return symbol, one, two, owner


def window_rows(packed: list[np.ndarray], seed: int, blocks: bool) -> Iterator[pa.RecordBatch]:
    """Equal windows as one row with their number, or as blocks of many, in random order."""
    keys, times = np.unique(np.concatenate(packed), return_counts=True)
    mixed = np.random.default_rng(seed & 0xFFFFFFFF).permutation(len(keys))
    keys, times = keys[mixed], times[mixed].astype(np.int32)
    if not blocks:
        yield batch_of(WINDOW, keys, None, times)
        return
    for start in range(0, len(keys), 16 * BLOCK):  # few blocks at once: they are large rows
        lows = range(start, min(start + 16 * BLOCK, len(keys)), BLOCK)
        sizes = np.array([len(keys[low : low + BLOCK]) for low in lows])
        bodies = [keys[low : low + BLOCK].tobytes() + times[low : low + BLOCK].tobytes() for low in lows]
        rows = batch_of(WINDOW, np.zeros(len(sizes), np.int64), None, sizes)
        yield rows.append_column("block", pa.array(bodies, pa.binary()))


def windows_of(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The packed windows of a block and how often each is met."""
    size = len(body) // 12
    return np.frombuffer(body, np.int64, size), np.frombuffer(body, np.int32, size, 8 * size)


def count(texts: DataFrame, symbols: Symbols, blocks: bool = False) -> DataFrame:
    """One pass over all texts: head counts, class counts, rows of other words, training windows.

    A TAIL row is (word, text, times in the text), times negative where the
    text is held out. Every training token is a window; a WINDOW row is
    (two before, one before and symbol packed, times among some of a batch), or,
    with ``blocks``, thousands of these in one value, which training reads
    several times without a row for each.
    """

    def shaped(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not blocks or "block" in rows.schema.names:
            return rows
        return rows.append_column("block", pa.nulls(rows.num_rows, pa.binary()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(len(symbols.head.keys) + 1, np.int64)
            classes = np.zeros(CLASSES, np.int64)
            packed, held = [], 0
            for chunk, _ in chunks(batch):
                found = symbols.head.find(chunk.keys)
                training = chunk.training[chunk.owner]
                counts[:-1] += np.bincount(found[training & (found >= 0)], minlength=len(counts) - 1)
                counts[-1] += int(chunk.training.sum())
                other = np.flatnonzero(found < 0)
                keys, owner = chunk.keys[other], chunk.owner[other]
                classes += np.bincount(
                    (keys[training[other]] & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES
                )
                order = np.lexsort((keys, owner))
                keys, owner = keys[order], owner[order]
                if len(keys):
                    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
                    times = np.diff(np.r_[first, len(keys)])
                    signed = np.where(chunk.training[owner[first]], times, -times)
                    yield batch_of(TAIL, keys[first], chunk.texts[owner[first]], signed)
                yield batch_of(MARK, np.zeros(len(chunk.texts), np.int64), chunk.texts, np.ones(len(chunk.texts)))
                symbol, one, two, of = symbols.stream(chunk, found)
                use = chunk.training[of]
                packed.append((two[use] << 40) | (one[use] << 20) | symbol[use])
                held += len(packed[-1])
                if held >= HELD:
                    yield from window_rows(packed, int(chunk.texts[0]), blocks)
                    packed, held = [], 0
            if held:
                yield from window_rows(packed, held, blocks)
            some = np.flatnonzero(counts)
            yield batch_of(HEAD, some, None, counts[some])
            some = np.flatnonzero(classes)
            yield batch_of(CLASS, some, None, classes[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(shaped, counted(batches))

    return texts.mapInArrow(run, BLOCK_ROWS if blocks else ROWS)


def summed(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """A table of ``size`` rows: the sum of ``rows`` by the table's row ``at``."""
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[ordered[first]] = np.add.reduceat(rows[order], first)
    return out


@dataclass
class Model:
    """Context vectors of the symbols, one scale for each context place, target vectors, biases."""

    context: np.ndarray
    scale: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, symbols: Symbols, unigram: np.ndarray, size: int, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.15, (symbols.outputs + 1, size)).astype(np.float32),
            (np.ones((2, size)) * [[1.0], [0.7]]).astype(np.float32),
            rng.normal(0, 0.15, (symbols.outputs, size)).astype(np.float32),
            np.log(unigram).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.scale, self.target, self.bias)])

    def filled(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for x in (self.context, self.scale, self.target, self.bias):
            out.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Model(*out)

    def train(self, windows: np.ndarray, times: np.ndarray, noise: np.ndarray, rng, negatives: int, rate: float, sums) -> None:
        """One NCE step by AdaGrad on windows (two before, one before, symbol), each met ``times``.

        The noise words are shared by the batch, so that their scores are one
        matrix product; each stands for ``negatives`` / their number draws.
        """
        two, one, symbol = windows
        times = times.astype(np.float32)
        drawn = rng.choice(len(noise), 4 * negatives, p=noise)
        each = np.float32(negatives / len(drawn))
        a, b = self.context[one], self.context[two]
        q = a * self.scale[0] + b * self.scale[1]
        offset = self.bias - np.log(negatives * noise).astype(np.float32)
        target, others = self.target[symbol], self.target[drawn]
        real = np.einsum("ij,ij->i", q, target) + offset[symbol]
        fake = q @ others.T + offset[drawn]
        g_real = times / (1 + np.exp(real))
        g_fake = (-each * times)[:, None] / (1 + np.exp(-fake))
        grad_q = g_real[:, None] * target + g_fake @ others
        at = np.concatenate([symbol, drawn])
        grads = [
            summed(
                np.concatenate([one, two]),
                np.concatenate([grad_q * self.scale[0], grad_q * self.scale[1]]),
                len(self.context),
            ),
            np.stack([np.einsum("ij,ij->j", grad_q, a), np.einsum("ij,ij->j", grad_q, b)]),
            summed(at, np.concatenate([g_real[:, None] * q, g_fake.T @ q]), len(self.target)),
            np.bincount(at, np.concatenate([g_real, g_fake.sum(0)]), len(self.bias)).astype(np.float32),
        ]
        for x, grad, total in zip((self.context, self.scale, self.target, self.bias), grads, sums):
            total += grad * grad
            x += np.float32(rate) * grad / np.sqrt(total)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (one before, symbol) and (two before, symbol), and log normalisers by both."""
        first = ((self.context * self.scale[0]) @ self.target.T + self.bias).astype(np.float32)
        second = ((self.context * self.scale[1]) @ self.target.T).astype(np.float32)
        low, high = np.exp(first - first.max(1, keepdims=True)), np.exp(second - second.max(1, keepdims=True))
        # sum over symbols of exp(first + second): one matrix product for all pairs of contexts
        norm = np.log(low @ high.T) + first.max(1)[:, None] + second.max(1)[None, :]
        return first, second, norm.astype(np.float32)


def trained(
    spark: SparkSession, windows: DataFrame, start: Model, noise: np.ndarray,
    rounds: int = 3, batch: int = 1024, negatives: int = 16, rate: float = 0.12,
) -> Model:
    """Rounds of local training in every partition over blocks of windows, then the mean of all models.

    What the driver receives is one mean per parameter, whatever the number of partitions.
    """
    model = start
    for turn in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model=model, turn=turn) -> Iterator[pa.RecordBatch]:
            mine = model.filled(model.flat())
            sums = [np.full_like(x, 0.05) for x in (mine.context, mine.scale, mine.target, mine.bias)]
            rng = np.random.default_rng(100 + turn)
            seen = 0
            blocks = (body.as_py() for part in batches for body in part.column("block"))
            for packed, times in map(windows_of, blocks):
                mixed = rng.permutation(len(packed))
                packed, times = packed[mixed], times[mixed]
                for low in range(0, len(packed), batch):
                    w, n = packed[low : low + batch], times[low : low + batch]
                    mine.train(
                        (w >> 40, (w >> 20) & 0xFFFFF, w & 0xFFFFF), n, noise, rng, negatives, rate, sums
                    )
                    seen += int(n.sum())
            if seen:
                flat = mine.flat().astype(float)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                    names=["i", "total", "weight"],
                )

        means = windows.mapInArrow(run, "i long, total double, weight double").groupBy("i").agg(
            (F.sum("total") / F.sum("weight")).alias("mean")
        )
        with arrow_rows(spark, 16):  # blocks are large rows
            means = means.toArrow()
        if not len(means):
            break
        model = model.filled(means.sort_by("i")["mean"].to_numpy())
    return model


SCORES = "doc_id long, key long, held_out boolean, n_tokens long, known long, base double, score double"


def language_model(
    spark: SparkSession,
    docs: DataFrame,
    most_frequent: int = 262_144,
    model_words: int = 1023,
    size: int = 32,
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one a document.

    Learns from every token of the documents whose crc32(doc_id) mod 7 is not
    2, in each round, and scores all, over whole texts. Null and empty texts are just an end. Null doc_ids are
    hashed as empty text. Repeated rows count as often in training and get
    equal results; no rows give no rows; other columns are ignored. Without a
    training token every word is unknown and the model is uniform.

    ``most_frequent`` and ``model_words`` bound the tables that tasks hold;
    words beyond them are counted exactly through a shuffle.
    """
    store = Store(spark, "lm")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("doc_id", "text").alias("key"),
        (crc_mod(F.col("doc_id"), 7) != 2).alias("training"),
    )
    slim = texts.select("key", "text", "training")
    head = frequent_words(slim, most_frequent, store)
    symbols = Symbols(head, min(model_words, len(head.keys)))
    rows = store.put(count(slim, symbols, blocks=True))

    # counts of the head and of the classes' other words: bounded tables
    known = rows.filter(F.col("kind").isin(HEAD, CLASS)).groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    head_counts = np.zeros(len(head.keys) + 1)
    class_tokens = np.zeros(CLASSES)
    for kind, into in ((HEAD, head_counts), (CLASS, class_tokens)):
        part = known.filter(pc.equal(known["kind"], kind))
        into[part["key"].to_numpy()] = part["n"].to_numpy()

    # every other word: its training count meets its texts
    word = Window.partitionBy("key")
    tail = rows.filter(F.col("kind") == TAIL).select("key", "text", "n")
    tail = tail.withColumn("c", F.sum(F.greatest("n", F.lit(0))).over(word)).withColumn(
        "number", F.row_number().over(word.orderBy("text"))
    )
    mine = F.struct(
        F.lit(False).alias("of_class"), F.col("text").alias("id"),
        (F.abs("n") * F.log10(F.col("c") + 1)).alias("base"),
        F.when(F.col("c") > 0, F.abs("n")).otherwise(0).cast("long").alias("known"),
        F.lit(0).cast("long").alias("rows"),
    )
    its_class = F.struct(
        F.lit(True).alias("of_class"), F.col("key").bitwiseAND(F.lit(CLASSES - 1)).alias("id"),
        F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("known"), F.lit(1).cast("long").alias("rows"),
    )
    new_word = (F.col("number") == 1) & (F.col("c") > 0)
    parts = tail.select(
        F.inline(F.when(new_word, F.array(mine, its_class)).otherwise(F.array(mine)))
    ).unionByName(
        rows.filter(F.col("kind") == MARK).select(
            F.lit(False).alias("of_class"), F.col("text").alias("id"), F.lit(0.0).alias("base"),
            F.lit(0).cast("long").alias("known"), F.lit(1).cast("long").alias("rows"),
        )
    )
    by_text = store.put(
        parts.groupBy("of_class", "id").agg(
            F.sum("base").alias("base"), F.sum("known").alias("known"), F.sum("rows").alias("rows")
        )
    )
    class_types = np.zeros(CLASSES)
    for row in by_text.filter("of_class").collect():
        class_types[row["id"]] = row["rows"]

    # totals, and the classes' shares of everything outside the model's words
    words = symbols.words
    end = head_counts[-1]
    tokens = head_counts.sum() + class_tokens.sum()
    types = int((head_counts > 0).sum() + (class_types.sum()))
    outside = np.arange(words, len(head.keys))
    of_class = (head.keys[outside] & np.uint64(CLASSES - 1)).astype(np.int64)
    class_tokens = class_tokens + np.bincount(of_class, head_counts[outside], CLASSES)
    class_types = class_types + np.bincount(of_class, head_counts[outside] > 0, CLASSES)
    class_size = np.log10(class_tokens + class_types + 1)
    unigram = np.concatenate([[end], head_counts[:words], class_tokens]) + 0.5
    noise = unigram / unigram.sum()

    windows = rows.filter(F.col("kind") == WINDOW).select("block")
    model = trained(spark, windows, Model.new(symbols, noise, size), noise)
    first, second, norm = model.tables()
    log_count = np.log10(head_counts[:-1] + 1)
    shared = spark.sparkContext.broadcast((symbols, first, second, norm, log_count, head_counts, class_size))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, first, second, norm, log_count, counts, class_size = shared.value
        end_log, end_known = float(np.log10(counts[-1] + 1)), int(counts[-1] > 0)
        for batch in batches:
            for chunk, part in chunks(batch):
                texts = len(chunk.texts)
                found = symbols.head.find(chunk.keys)
                symbol, one, two, owner = symbols.stream(chunk, found)
                logp = (
                    first[one, symbol].astype(float) + second[two, symbol] - norm[one, two]
                ) / np.log(10)
                total = np.bincount(owner, logp, texts)
                in_head = found >= 0
                counted = np.zeros(len(found))
                counted[in_head] = log_count[found[in_head]]
                seen = np.zeros(len(found), bool)
                seen[in_head] = counts[found[in_head]] > 0
                outside = (found < 0) | (found >= symbols.words)
                classes = (chunk.keys & np.uint64(CLASSES - 1)).astype(np.int64)
                share = np.where(outside, counted - class_size[classes], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[part.start : part.stop],
                        pa.array(chunk.texts),
                        pa.array(~chunk.training),
                        pa.array(np.bincount(chunk.owner, minlength=texts) + 1),
                        pa.array(np.bincount(chunk.owner, seen, texts).astype(np.int64) + end_known),
                        pa.array(np.bincount(chunk.owner, counted, texts) + end_log),
                        pa.array(total + np.bincount(chunk.owner, share, texts)),
                    ],
                    names=["doc_id", "key", "held_out", "n_tokens", "known", "base", "score"],
                )

    scored = texts.mapInArrow(score, SCORES)
    other = by_text.filter("not of_class").select(
        F.col("id").alias("key"), (F.col("base") / F.col("rows")).alias("other"),
        F.expr("known div rows").alias("other_known"),
    )
    return scored.join(other, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("other_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (
            F.col("base") + F.coalesce("other", F.lit(0.0))
            - F.col("n_tokens") * F.lit(float(np.log10(tokens + types + 1)))
        ).alias("base_score"),
        (F.col("score") + F.coalesce("other", F.lit(0.0))).alias("score"),
    )
