"""The corpus pipeline's rows against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from shortfall.llm import sharding
from tests.llm.test_text_operators import brute_components, brute_distance


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute_stream(rows, most_epochs=3.0):
    """(position, doc_id, text) of every copy, in training order."""
    words = {i: len(text.split()) for i, (text, _) in rows.items()}
    size = Counter()
    for i, (_, source) in rows.items():
        size[source] += words[i]
    ranked = sorted(size)
    weight = {s: k % 3 + 1.0 for k, s in enumerate(ranked)}
    full = set()
    while True:
        left = sum(size.values()) - sum(most_epochs * size[s] for s in full)
        free = sum(weight[s] for s in ranked if s not in full)
        level = left / free if free else level
        now = {s for s in ranked if most_epochs * size[s] <= weight[s] * level}
        if now == full or not free:
            break
        full = now
    out = []
    for k, s in enumerate(ranked):
        target = min(most_epochs * size[s], weight[s] * level)
        slope = -0.6 + 1.2 * k / max(len(ranked) - 1, 1)
        whole, place = int(target / size[s]), 0
        for i in sorted((i for i in rows if rows[i][1] == s), key=lambda i: md5(str(i))):
            copies = whole + (place + words[i] / 2 < (target / size[s] - whole) * size[s])
            for copy in range(copies):
                done = min(1.0, (place + copy * size[s] + words[i] / 2) / target)
                root = ((1 - slope) ** 2 + 4 * slope * done) ** 0.5
                at = done if abs(slope) < 1e-9 else (root - (1 - slope)) / (2 * slope)
                out.append((at, i, rows[i][0]))
            place += words[i]
    return sorted(out)


def brute_shards(stream, shards=24):
    """(doc_id, size, text_crc32, shard, place, virtual slot) of every row."""
    sizes = [len(text.encode()) + 8 for _, _, text in stream]
    held, times = Counter(), Counter()
    for (_, _, text), size in zip(stream, sizes):
        held[text] += size
        times[text] += 1
    slots = []
    for _, i, text in stream:
        hot = times[text] > 1 and held[text] > sum(sizes) / (16 * shards)
        slots.append(int(md5(f"{i}|{md5(text)}" if hot else md5(text))[:8], 16) % sharding.SLOTS)
    load, rows = Counter(), Counter()
    for slot, size in zip(slots, sizes):
        load[slot] += size
        rows[slot] += 1
    shard_of = sharding.spread([(s, load[s], rows[s]) for s in load], shards)
    filled, out = Counter(), []
    for (_, i, text), size, slot in zip(stream, sizes, slots):
        shard = shard_of[slot]
        out.append((i, size, zlib.crc32(text.encode()), shard, filled[shard], slot))
        filled[shard] += 1
    return out


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    common = {"en": "the of and house water through night", "de": "der die und haus wasser durch nacht"}
    made = [a + b + c for a in "bdfgklmnprst" for b in ("a", "e", "i", "o") for c in ("ll", "nt", "rk", "st")]
    pools = {lang: words.split() * 4 + made for lang, words in common.items()}
    items = [[rng.choice(made) for _ in range(24)] for _ in range(3)]
    rows = {}
    for i in range(240):
        lang = ("en", "de")[i % 2]
        text = [rng.choice(pools[lang]) for _ in range(rng.randint(40, 90))]
        if i % 11 == 10:  # a near copy of an earlier document
            text = rows[i - 4][0].split() + ["end"]
        elif i % 17 == 16:  # a passage of the benchmark
            text[20:20] = items[i % 3]
        rows[i] = (" ".join(text), lang, rng.choice("aaaaaabbc"))
    junk = {300: ("12 !!", None, "a"), 301: ("", "en", "b"), 302: (None, "en", "a")}
    documents = [(i, *row, len(row[0] or "")) for i, row in {**rows, **junk}.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents, schema).write.parquet(f"{tmp_path}/documents.parquet")
    bench = [(k, " ".join(item)) for k, item in enumerate(items)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    first = brute_components([(i, row[0]) for i, row in rows.items()])
    one = {i: row for i, row in rows.items() if first[i][1] == i}
    clean = {
        i: (text, source) for i, (text, _, source) in one.items()
        if all(brute_distance(item, text.split()) > len(item) // 4 for item in items)
    }
    stream = brute_stream(clean)
    assert len(clean) < len(one) < len(rows) and max(Counter(i for _, i, _ in stream).values()) > 1

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.virtual_slot) for r in got) == sorted(
        brute_shards(stream)
    )
