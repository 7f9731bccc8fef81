"""Spelling variants against brute force; defined cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from shortfall.llm import spelling
from shortfall.llm.base import Store

DOCS = "doc_id long, text string, word string, n long, short string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 7, "clash") for i, t in rows], DOCS)


def lower(text):
    return text.encode().lower().decode()


def brute_vocabulary(rows, damage=199, min_length=6, min_count=5):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            check = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if damage and check % damage == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= ratio * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out[w] = (f, root, words[w], len(near[w]), words[f] if f else None)
    return out


def got_groups(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_words(seed, size):
    rng = random.Random(seed)
    letters = "abcehinorstéßÉ÷"
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 9]))) for _ in range(size)}
    for w in sorted(words):
        for _ in range(rng.choice([0, 1, 4])):
            at = rng.randrange(len(w))
            words.add(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + "ü" + w[at + 1 :]]))
    return {w: rng.choice([5, 5, 6, 25, 30, 125, 700, 4000]) for w in sorted(words)}


@pytest.mark.parametrize("symbols", [2, 8])
def test_groups_equal_brute_force(spark, symbols):
    words = made_words(1, 60)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = got_groups(spelling.variant_groups(spark, df, symbols=symbols))
    assert got == brute_groups(words)
    assert any(row[1] != row[0] and row[0] for row in got.values())  # chains of several forms


def test_long_chains_reach_their_root(spark):
    words = {"abcdefghijkl"[: 12 - i] + "z" * i: 5 ** (i + 1) for i in range(8)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = got_groups(spelling.variant_groups(spark, df))
    assert got == brute_groups(words)
    assert {row[1] for row in got.values()} == {"abcdezzzzzzz"}


def test_pairs_are_found_once_in_each_direction(spark):
    words = {w: 5 for w in ("aaaaaa", "aaaaaaa", "aaaaab", "aaaabb", "éaaaaa", "×aaaaa")}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = spelling.near_pairs(df, Store(spark, "test"), symbols=2).select("word", "near").collect()
    want = sorted((a, b) for a in words for b in words if one_edit(a, b))
    assert sorted(map(tuple, pairs)) == want


def test_documents_equal_brute_force(spark):
    rng = random.Random(5)
    words = sorted(made_words(2, 30))
    rows = [(i, " ".join(rng.choice(words).capitalize() for _ in range(80)) + "!Ünder") for i in range(40)]
    rows += [(7, rows[7][1])] * 3 + [(None, rows[0][1]), (50, None), (51, ""), (52, "12 _ -"), (53, "ÀÉ" * 3)]
    got = got_groups(spelling.spelling_variants(spark, frame(spark, rows)))
    assert got == brute_groups(brute_vocabulary(rows))


def test_damage_loses_a_letter(spark):
    rows = [(i, "spelling " * 5) for i in range(600)]
    got = {r.word: r.n for r in spelling.count_words(frame(spark, rows), damage=199).collect()}
    assert got == brute_vocabulary(rows)
    assert len(got) > 1


def test_long_text_is_read_whole():
    data = ("wörter und mehr, " * 200_000).encode()
    parts = list(spelling.pieces(data, 1000))
    assert b"".join(parts) == data and len(parts) > 1000
    assert sum(len(spelling.RUN.findall(p)) for p in parts) == 600_000
    assert list(spelling.pieces(b"x" * 5000, 1000)) == [b"x" * 5000]


def test_many_words_are_sent_on_in_parts(spark):
    rows = [(i, " ".join(f"word{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}" for k in range(100))) for i in range(6)]
    assert spelling.count_words(frame(spark, rows), held=10, damage=None).count() == 100


def test_empty_table_and_wrong_parameters(spark):
    empty = spelling.spelling_variants(spark, frame(spark, []))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0
    words = spark.createDataFrame([("abcdef", 5)], "word string, n long")
    with pytest.raises(ValueError):
        spelling.variant_groups(spark, words, ratio=1)
    with pytest.raises(ValueError):
        spelling.near_pairs(words, Store(spark, "test"), symbols=1)
