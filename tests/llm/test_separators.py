import base64

import public_tokenizers as P
import pytest
import tiktoken

from tiffin.llm import separators

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def key(rows):
    return sorted((i is None, i or 0, n) for i, n in rows)


@pytest.mark.parametrize("block", [2, 6, 4096, 1 << 20])
def test_counts_equal_the_encoder(spark, odd, nothing, encoder, block):
    short = odd.where("coalesce(length(text), 0) < 500") if block < 4096 else odd
    extra = spark.createDataFrame([(-5, "x"), (2**63 - 1, ""), (-2**63, "y z")],
                                  "doc_id long, text string")
    docs = short.select("doc_id", "text").unionByName(extra).repartition(3)
    want = key((r.doc_id, len(encoder.encode_ordinary(r.text or ""))) for r in docs.collect())
    got = separators.token_counts(docs, RANKS, P.PATTERN, block)
    assert key((r.doc_id, r.n_tokens) for r in got.collect()) == want
    assert separators.token_counts(nothing.select("doc_id", "text"), RANKS, P.PATTERN,
                                   block).collect() == []
