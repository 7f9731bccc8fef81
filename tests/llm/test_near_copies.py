"""A large group of near copies of which most pairs fall just short of a link."""

import random

from test_text_operators import brute_components, frame

from shortfall.llm import jaccard


def near_copies(count, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 3, 4, 5, 6])):
            text[rng.randrange(len(text))] = f"n{rng.randrange(100_000)}"
        out.append(" ".join(text))
    return out


def test_near_copies_that_fall_short_are_not_compared_pair_by_pair(spark, monkeypatch):
    compared = []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    verified = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", counted)
    rows = list(enumerate(near_copies(240, 5) + near_copies(160, 6) + near_copies(20, 7)))
    got = jaccard.jaccard_components(spark, frame(spark, rows)).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({component for _, component in want.values()}) > 40
    # few of the pairs that the last round had to compare
    assert compared[-1] < 1000, compared


def test_near_copies_of_one_small_step(spark):
    """Chains of links and members no text of which is the common one."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        text = [*base[: rng.randrange(30, 60)], *[f"x{rng.randrange(6)}" for _ in range(rng.randrange(8))]]
        rows.append((i, " ".join(text)))
    got = jaccard.jaccard_components(spark, frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
