import random
import re

import numpy as np

from tiffin.llm import fmindex

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(texts, items, width):
    phrases = [(i, w[a:a + width]) for i, t in items if (w := words(t))
               for a in range(max(1, len(w) - width + 1))]
    out = []
    for t in texts:
        w, found = words(t), set()
        hit = [0] * len(w)
        for i, p in phrases:
            for a in range(len(w) - len(p) + 1):
                if w[a:a + len(p)] == p:
                    found.add(i)
                    hit[a:a + len(p)] = [1] * len(p)
        out.append((len(w), sum(hit), sorted(found)))
    return out


def test_shard_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        width, kinds = rng.choice([1, 2, 3, 5]), ["a", "B", "é", "c1", "d"][:rng.choice([2, 3, 5])]

        def text(n):
            return " ".join(rng.choice(kinds) for _ in range(rng.randrange(n)))
        texts = [rng.choice([text(30), None, "", text(5)]) for _ in range(6)]
        items = [(str(i), text(8)) for i in range(4)]
        phrases = fmindex.phrases_of(items, width)
        bound, marked, found = fmindex.shard_hits(texts, phrases)
        assert [(int(bound[i + 1] - bound[i]), int(marked[bound[i]:bound[i + 1]].sum()),
                 sorted(phrases.ids[x] for x in found[i])) for i in range(6)] \
            == brute(texts, items, width)


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = np.concatenate([[0], rng.integers(0, 4, rng.integers(1, 40)), [0]])
        zeros = int((s == 0).sum())
        unique = np.where(s == 0, np.cumsum(s == 0) - zeros - 1, s)
        assert fmindex.suffix_array(s).tolist() == sorted(
            range(len(s)), key=lambda i: unique[i:].tolist())
        tree = fmindex.WaveletMatrix(s, 3)
        for v in set(s.tolist()):
            for e in range(len(s) + 1):
                assert tree.rank(np.array([v]), np.array([e]))[0] == (s[:e] == v).sum()
        assert tree.access(np.arange(len(s))).tolist() == s.tolist()


def test_blocks_of_phrases_add_up(spark, odd, nothing, monkeypatch):
    bench = spark.createDataFrame(
        [(1, "A b c d"), (2, "cat sat on the mat the cat"), (None, "i j"), (3, None), (4, ""),
         (1, "text of doc")], "item_id long, text string")
    one = sorted(map(str, fmindex.verdicts(odd, bench).collect()))
    monkeypatch.setattr(fmindex, "BLOCK_CHARS", 9)
    assert sorted(map(str, fmindex.verdicts(odd, bench).collect())) == one
    rows = odd.select("doc_id", "text").collect()
    want = brute([r.text for r in rows], [("" if i is None else str(i), t)
                                          for i, t in bench.collect()], 13)
    got = fmindex.verdicts(odd, bench).collect()
    key = lambda x: (x[0], x[1], x[2])
    assert sorted(key((r.n_words, r.n_hit, r.n_items)) for r in got) == sorted(
        (n, h, len(f)) for n, h, f in want)
    assert fmindex.verdicts(nothing, bench).collect() == []
    none = fmindex.verdicts(odd, bench.limit(0)).collect()
    assert {r.n_hit for r in none} == {0} and not any(r.contaminated for r in none)
