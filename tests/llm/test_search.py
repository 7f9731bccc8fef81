"""Ranked search against a plain scorer; bounds, ties, defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np

from shortfall.llm import balltree

DOCS = "doc_id long, text string, rank int, score string, item long"
ITEMS = "item_id long, text string, doc_id long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 3) for i, t in rows], ITEMS)


def terms(text):
    found = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return Counter(t.encode().lower() for t in found)


def brute(docs, items, top):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 50 + (50 * c.total() * n_docs) // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def made(seed=4, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "日本", "x9"]
    text = lambda k: " ".join(words[min(int(rng.expovariate(0.05)), 122)] for _ in range(k))
    docs = [(i, text(rng.choice([1, 5, 40, 300]))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(60)] + [docs[5]] * 4
    docs += [(None, docs[3][1]), (None, None), (9000, None), (9001, ""), (9002, "-- !"), (9003, "w1 " * 4000)]
    rng.shuffle(docs)
    items = [(i, text(rng.choice([1, 4, 30]))) for i in range(12)]
    items += [(12, docs[3][1]), (13, None), (14, ""), (15, "nowhere"), (3, "w1 W2"), (3, "w1 W2")]
    return docs, items


def ranks(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_search_equals_brute_force(spark):
    docs, items = made()
    got = balltree.ranked(spark, docs_of(spark, docs).repartition(3), items_of(spark, items), top=7)
    assert ranks(got) == brute(docs, items, 7)


def test_items_in_several_blocks(spark):
    docs, items = made(8, 60)
    got = balltree.ranked(spark, docs_of(spark, docs), items_of(spark, items), top=5, most_items=7)
    assert ranks(got) == brute(docs, items, 5)


def test_empty_tables(spark):
    docs, items = made(2, 10)
    assert balltree.ranked(spark, docs_of(spark, []), items_of(spark, items)).count() == 0
    assert balltree.ranked(spark, docs_of(spark, docs), items_of(spark, [])).count() == 0
    assert balltree.ranked(spark, docs_of(spark, [(1, None)]), items_of(spark, items)).count() == 0


def block(seed, rows, width):
    rng = np.random.default_rng(seed)
    columns = [np.sort(rng.choice(width, rng.integers(1, 12), replace=False)) for _ in range(rows)]
    for i in range(rows // 2, rows):  # copies, and copies with one more term
        columns[i] = np.unique(np.r_[columns[i % 9], rng.integers(0, width, i % 2)])
    starts = np.r_[0, np.cumsum([len(c) for c in columns])]
    tf = rng.integers(1, 5, starts[-1])
    return starts, np.concatenate(columns), tf


def search(rows, width, items, top, leaf):
    rng = np.random.default_rng(1)
    members = [sorted(rng.choice(width, 6, replace=False).tolist()) for _ in range(items)]
    words = {str(i).encode(): i for i in range(width)}
    weights = rng.integers(0, 9000, width)
    return balltree.Search(balltree.Items(list(range(items)), members, words, weights), rows, 10 * rows, top, leaf)


def test_bounds_hold_in_every_ball():
    starts, columns, tf = block(3, 300, 40)
    state = search(300, 40, 20, 5, 4)
    n = np.full(300, 10)
    impacts = state.impacts(tf, np.repeat(n, np.diff(starts)))
    weights = state.items.weights
    tree = balltree.BallTree(starts, columns, impacts, weights, 4)
    dense = np.zeros((300, 40), np.int64)
    dense[np.repeat(np.arange(300), np.diff(starts)), columns] = impacts
    whole = np.zeros((20, 40), np.int64)
    for i, m in enumerate(state.items.members):
        whole[i, m] = weights[m]
    bounds = tree.bounds(np.sqrt(whole[:, tree.columns_used].astype(float)))
    scores = dense @ whole.T
    assert sorted(tree.order.tolist()) == list(range(300))
    for number, node in enumerate(tree.nodes):
        assert (scores[tree.order[node.low : node.high]] <= bounds[number]).all()


def test_balls_are_left_out():
    starts, columns, tf = block(5, 4000, 30)
    state = search(4000, 30, 10, 5, 16)
    state.add(list(range(4000)), np.full(4000, 10), starts, columns, np.ones_like(tf))  # half of them near copies
    assert state.scored < state.met / 2


def test_large_weights_are_added_as_integers():
    state = search(10, 8, 2, 5, 4)
    assert state.kind is np.float64
    heavy = balltree.Items([0], [[0, 1]], {b"a": 0, b"b": 1}, np.array([1 << 34, 3], np.int64))
    state = balltree.Search(heavy, 2, 20, 5, 4)
    assert state.kind is np.int64
    state.add([5, 6], np.array([10, 10]), np.array([0, 2, 3]), np.array([0, 1, 0]), np.array([1, 1, 1]))
    impact = 10**9 // (1000 + 20 * 100)
    assert sorted((s, t.doc) for s, t in state.best[0]) == [((1 << 34) * impact, 6), (((1 << 34) + 3) * impact, 5)]


def test_long_text_is_read_whole():
    data = "Ein Wort, É9 ".encode() * 300_000
    assert balltree.terms(data, 1000) == {b"ein": 300_000, b"wort": 300_000, "É9".encode(): 300_000}
    assert balltree.terms(b"y" * 5000, 1000) == {b"y" * 5000: 1}
