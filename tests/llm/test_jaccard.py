import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tiffin.llm import jaccard
from tiffin.llm.components import components


def brute(rows, n, num, den):
    """component per doc_id, by all pairs that share a shingle."""
    sets = []
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((doc, set() if not w else {tuple(w)} if len(w) < n else
                     {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}))
    where = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(i)
    shared = Counter((i, j) for m in where.values() for i in m for j in m if i < j)
    boss = {d: d for d, _ in sets}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x
    for (i, j), k in shared.items():
        (a, s), (b, t) = sets[i], sets[j]
        if a is not None and b is not None and den * k >= num * (len(s) + len(t) - k):
            x, y = find(a), find(b)
            boss[max(x, y)] = min(x, y)
    return sorted((d is None, d or 0, len(s), 0 if d is None else find(d)) for d, s in sets)


def run(df, n, num, den):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0)
                  for r in jaccard.join(df, n, num, den).collect())


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (2, 1, 2)])
def test_components_equal_all_pairs(spark, n, num, den):
    rng = random.Random(n)
    base = [[str(rng.randrange(40)) for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    rows = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = str(rng.randrange(200))
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, n, num, den) == brute(rows, n, num, den)


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert run(odd, 3, 90, 100) == brute(rows, 3, 90, 100)
    assert jaccard.join(nothing, 3, 90, 100).collect() == []


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(900, 901), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def test_counters_are_small_for_small_tasks_and_exact(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(40))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16).persist()
    surveyed = jaccard.survey(docs, 3).persist()
    sent = surveyed.where("block is not null").selectExpr("sum(length(counters)) as bytes").first()
    sets = jaccard.shingle_sets([t for _, t in rows], 3)
    assert sent.bytes <= 6 * sum(map(len, sets))
    want = sum(np.bincount((s >> np.uint64(44)).astype(np.int64), minlength=jaccard.BUCKETS)
               for s in sets)
    assert (jaccard.rarity(surveyed) == want).all()
    for k in (0, 5, jaccard.BLOCK):
        block = np.arange(jaccard.BLOCK) * (np.arange(jaccard.BLOCK) < k)
        assert (jaccard.unpacked(jaccard.packed(block)) == block).all()
