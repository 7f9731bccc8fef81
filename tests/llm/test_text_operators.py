"""Jaccard join, decontamination, language, toxicity: brute force and edge cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from shortfall.llm import decontaminate, jaccard, language, toxicity
from shortfall.llm.base import sample_texts

DOCS = "doc_id long, text string, lang string, source string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1.0) for i, t in rows], DOCS)


def made_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    out = []
    for group in range(8):
        base = [rng.choice(words) for _ in range(rng.choice([3, 12, 40, 120]))]
        for _ in range(rng.choice([1, 3, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text))
    out += ["", None, " \n", "One two", "one TWO", "one two three four five", "x " * 5000]
    return out


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 75 * len(sets[a] | sets[b]) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return {i: (len(sets[i]), least[i]) for i in sets}


def test_jaccard_equals_brute_force(spark):
    rows = list(enumerate(made_texts()))
    got = jaccard.jaccard_components(spark, frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_jaccard_defined_cases(spark):
    empty = jaccard.jaccard_components(spark, frame(spark, []))
    assert empty.count() == 0
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, "")]
    got = jaccard.jaccard_components(spark, frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [
        (-1, 0, -1), (-1, 2, 4), (4, 2, 4), (4, 2, 4), (9, 0, 9)
    ]


def test_one_row_of_each_component_stays(spark):
    rows = [(2, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (7, None), (8, "z")]
    kept = jaccard.first_of_each(spark, frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "score"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 8]


@pytest.mark.parametrize("ask", range(1, 5))
def test_prefixes_share_what_they_ask_for(ask):
    """Similar sets share min(l) tokens of prefixes of their own lengths."""
    import numpy as np

    rng = np.random.default_rng(ask)
    order = jaccard.Order(np.empty(0, np.uint64), np.empty(0, np.int64))
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 1 << 40, n, np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 40, n // 12 + 1, np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 75 * len(np.union1d(a, b)):
            continue
        small, large = sorted((a, b), key=len)
        (ps, _, inner, ls), (pl, _, _, ll) = order.prefix(small), order.prefix(large)
        assert len(np.intersect1d(ps[inner], pl)) >= min(ls, ll)


def brute_distance(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        last, row[0] = row[0], 0
        for i, want in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (want != word))
        best = min(best, row[-1])
    return best


def test_leaks_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [[rng.choice(words) for _ in range(rng.randint(14, 50))] for _ in range(12)]
    bench = spark.createDataFrame(
        [(i, " ".join(x).upper()) for i, x in enumerate(items)] + [(50, None), (51, ""), (None, "a b")],
        "item_id long, text string",
    )
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 200))]
        if i % 2:
            copy = list(rng.choice(items))
            for _ in range(rng.choice([0, 1, 2])):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["new"], [copy[at], "more"]])
            at = rng.randint(0, len(text))
            text[at:at] = copy
        rows.append((i, ", ".join(text)))
    rows += [(100, None), (101, "")]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    want = {}
    for i, text in rows:
        for j, item in enumerate(items):
            d = brute_distance(item, (text or "").replace(",", "").split())
            if d <= int(0.25 * len(item)):
                want[(i, j)] = d
    assert len(want) >= 25
    missed = set(want) - set(got)
    assert not set(got) - set(want) and len(missed) <= 0.05 * len(want)
    assert all(got[k] == want[k] for k in got)
    assert decontaminate.leaks(frame(spark, []), bench).count() == 0
    assert decontaminate.leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_language_on_small_samples(spark):
    rng = random.Random(1)
    pools = {"en": "the of and house water through night".split(), "de": "der die und haus wasser durch nacht".split()}
    rows = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(pools[lang]) for _ in range(40)), lang, None, 0.5))
    rows += [(500, None, "en", None, 0.1), (501, "12 !!", None, None, 0.1), (None, "the house and water of the night", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == ("en", "de")[i % 2] for i in range(120))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(120))
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[501].rejected
    assert got[None].lang_pred == "en"
    assert language.language_id(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.language_id(unlabelled).collect()} == {"und"}


def test_toxicity_on_small_samples(spark):
    rng = random.Random(2)
    plain = [a + b + "ing" for a in "bcdfghklmn" for b in ("a", "e", "i", "o", "u", "ar", "en", "ou")]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(5):
                text[rng.randrange(60)] = rng.choice(["grobian", "vileword", "nastyman"])
        rows.append((i, " ".join(text), None, None, 0.0))
        labels.append((i, int(i % 4 == 0), 1))
    rows += [(900, None, None, None, None), (901, "", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(labels + [(None, 1, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    right = [got[i].predicted == int(i % 4 == 0) for i in range(400)]
    assert sum(right) >= 0.97 * len(right)
    assert got[900].score == got[901].score < 0.5
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).filter("predicted = 1").count() == 0


def test_samples_take_different_texts(spark):
    rows = [(1, f"text {i}", "a") for i in range(300)] + [(None, "the same one", "b")] * 500 + [(2, "x" * 50, "b"), (3, "y", None)]
    rows += [(7, f"text {i % 40}", "c") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(7)
    got = sample_texts(frame, "label", 60, 20).collect()
    assert sorted((r.text, r.repeats) for r in got if r.label == "b") == [("the same one", 500), ("x" * 20, 1)]
    assert len({r.text for r in got if r.label == "a"}) == sum(r.label == "a" for r in got) == 60
    assert sorted((r.text, r.repeats) for r in got if r.label == "c") == sorted((f"text {i}", 10) for i in range(40))
    again = sample_texts(frame.repartition(3), "label", 60, 20).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    assert sample_texts(frame.limit(0), "label", 60, 20).count() == 0


def test_language_of_repeated_rows_and_null_ids(spark):
    en, de = "the house of the old man and the sea ", "das haus des alten mannes und das meer "
    rows = [(i % 40 if i % 40 % 3 else None, en * 3, "en") for i in range(8000)]
    rows += [(None, de * (1 + i % 3), "de") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {r.lang_pred: r["count"] for r in language.language_id(frame).groupBy("lang_pred").count().collect()}
    assert counts == {"en": 8000, "de": 300}


def test_texts_of_labelled_ids_are_not_shuffled(spark):
    """The labels, in a table of their own, meet hashes; whole texts used to be shuffled with them."""
    from shortfall.llm.base import sample_texts_of_ids

    docs = spark.createDataFrame(
        [(i, None if i % 40 == 0 else f"text {i % 90}") for i in range(400)], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(i % 300, i % 3 if i % 3 < 2 else None) for i in range(330)], "doc_id long, toxic int"
    )
    want = sample_texts(docs.join(labels, "doc_id"), "toxic", 30, 6)
    got = sample_texts_of_ids(docs, labels, "toxic", 30, 6)
    columns = ["toxic", "text", "repeats"]
    as_sorted = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert len(as_sorted(got)) == 60 and as_sorted(got) == as_sorted(want)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sample_texts_of_ids(docs, labels, "toxic", 30, 6)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [text_key" in plan
