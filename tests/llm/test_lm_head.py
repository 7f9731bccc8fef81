"""The bounded head of the language model's words, and its scores as probabilities."""

import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shortfall.llm import lm
from shortfall.llm.base import Store


def frame(spark, n=60, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words[min(int(rng.expovariate(0.02)), 299)] for _ in range(40)) for _ in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("room", [0, 1, 7, 25, 60, 99, 100, 200])
@pytest.mark.parametrize("parts", [2, 16, 4096])
def test_least_cut_equals_a_sorted_list(spark, room, parts):
    rng = random.Random(room)
    values = [rng.choice([0, 1, 2, 3, 90, 1000, 2**31 - 1]) for _ in range(40)] + [rng.randrange(10**6) for _ in range(60)]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    t, n = lm.least_cut(rows, "v", room, max(values), parts)
    assert n == sum(v >= t for v in values) <= room
    assert t == 0 or sum(v >= t - 1 for v in values) > room


@pytest.mark.parametrize("most", [1, 20, 90, 10_000])
def test_head_holds_the_most_frequent_words(spark, most):
    docs = frame(spark).select(
        F.xxhash64("doc_id").alias("key"), "text", (F.col("doc_id") % 7 != 2).alias("training")
    )
    counts = Counter()
    for r in docs.collect():
        if r.training:
            counts.update(re.findall(r"\S+", r.text))
    head = lm.frequent_words(docs, most, Store(spark, "test"))
    keys, _ = lm.keyed_words(" ".join(counts).encode())
    by_key = dict(zip(keys.tolist(), counts.values()))
    got = [by_key[k] for k in head.keys.tolist()]
    assert got == sorted(counts.values(), reverse=True)[: len(got)]
    assert len(got) <= most and len(got) >= min(most, len(counts)) - 1  # a taken slot may cost a word
    again = pickle.loads(pickle.dumps(head))
    assert len(pickle.dumps(head)) < 8 * len(head.keys) + 1000
    assert (again.find(keys) == head.find(keys)).all()


def test_scores_do_not_depend_on_the_head(spark):
    """Words beyond the head are counted through a shuffle, with equal base scores."""
    docs = frame(spark)
    wide = {r.doc_id: r for r in lm.language_model(spark, docs, model_words=15).collect()}
    narrow = {r.doc_id: r for r in lm.language_model(spark, docs, most_frequent=40, model_words=15).collect()}
    for i, row in wide.items():
        assert narrow[i].base_score == pytest.approx(row.base_score, abs=1e-9)
        assert (narrow[i].n_known, narrow[i].train_tokens) == (row.n_known, row.train_tokens)
        assert narrow[i].score == pytest.approx(row.score, abs=1e-6)


def test_probabilities_of_a_context_sum_to_one():
    symbols = lm.Symbols(lm.Head.of(np.arange(1, 20, dtype=np.uint64)), 19)
    model = lm.Model.new(symbols, np.full(symbols.outputs, 1 / symbols.outputs), 8)
    first, second, norm = model.tables()
    context = model.context
    for one, two in ((0, 3), (symbols.start, symbols.start), (7, symbols.start)):
        logp = first[one].astype(float) + second[two] - norm[one, two]
        assert np.exp(logp).sum() == pytest.approx(1, abs=1e-4)
        q = context[one] * model.scale[0] + context[two] * model.scale[1]
        plain = q @ model.target.T + model.bias
        plain = plain - np.log(np.exp(plain).sum())
        assert np.allclose(logp, plain, atol=1e-4)


def test_blocks_hold_the_windows(spark):
    docs = frame(spark, 30).select(F.col("doc_id").alias("key"), "text", F.lit(True).alias("training"))
    symbols = lm.Symbols(lm.frequent_words(docs, 20), 15)
    plain, blocks = Counter(), Counter()
    for r in lm.count(docs, symbols).filter(f"kind = {lm.WINDOW}").collect():
        plain[r.key] += r.n
    for r in lm.count(docs, symbols, blocks=True).filter(f"kind = {lm.WINDOW}").collect():
        keys, times = lm.windows_of(bytes(r.block))
        assert len(keys) == r.n
        for k, n in zip(keys.tolist(), times.tolist()):
            blocks[k] += n
    assert blocks == plain and sum(plain.values()) == 30 * 41
