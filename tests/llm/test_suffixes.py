import hashlib
import random

import pytest

from tiffin.llm import suffixes


def brute(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            s = body[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def run(df, length):
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
            for r in suffixes.digests(df, length).collect()]


def texts(seed):
    rng = random.Random(seed)
    blocks = ["".join(rng.choice("abcdé\0 ") for _ in range(rng.randrange(20, 260)))
              for _ in range(12)] + ["a" * 400, "ab" * 150, "\0" * 150]
    return [(i, "".join(rng.choice(blocks)[rng.randrange(30):] for _ in range(rng.randrange(6))))
            for i in range(120)] + [(None, blocks[0] * 2), (999, None), (1000, "")]


@pytest.mark.parametrize("length, chunk", [(100, 50_000), (40, 50_000), (100, 7)])
def test_equals_brute_force(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)  # 7: the path of anchors at very many places
    rows = texts(length)
    want = brute(rows, length)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for doc, got in run(df, length):
        assert got == want[doc], doc


def test_odd_rows(odd, nothing):
    one_text = odd.where("not (doc_id = 2 and lang = 'en')").where("doc_id is not null")
    want = brute([(r.doc_id, r.text) for r in one_text.collect()], 100)
    got = run(one_text, 100)
    assert len(got) == one_text.count()  # repeated rows stay, with equal results
    assert all(g == want[d] for d, g in got)
    assert len(run(odd, 100)) == odd.count()
    assert run(nothing, 100) == []
