import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tiffin.llm import bpe, common

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library():
    rng, ref, enc = random.Random(1), reference(), bpe.Encoder(PATH)
    texts = ["", "a", "aaaaaaa", " <|endoftext|>  x<|endoftext|>", "é  x\x1c\x1d y\x85z", "'re'LL",
             "a" * 5000, "".join(rng.choice("abcdeth") for _ in range(6000)), "\n\n  x \t\n"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x3000),
                                      rng.randrange(32)])) for _ in range(60)) for _ in range(500)]
    flat, bounds = enc.encode(texts)
    for i, t in enumerate(texts):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == ref.encode(
            t, add_special_tokens=False).ids


def test_bounded_memory_forgets_words(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    enc, ref = bpe.Encoder(PATH), reference()
    for text in ("one two three four", "five <|endoftext|> six", "one two"):
        flat, _ = enc.encode([text])
        assert flat.tolist() == ref.encode(text, add_special_tokens=False).ids


def test_query_on_odd_rows(odd, nothing):
    ref = reference()
    got = bpe.digests(odd, PATH).collect()
    assert len(got) == odd.count()
    want = sorted((r.doc_id is None, r.doc_id or 0, *digest(ref, r.text or ""))
                  for r in odd.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in got) == want
    assert bpe.digests(nothing, PATH).collect() == []


def digest(ref, text):
    ids = ref.encode(text, add_special_tokens=False).ids
    back = ref.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_clashing_columns_are_replaced(odd):
    coded = bpe.encode(odd, PATH)
    assert [c.lower() for c in coded.columns].count("ids") == 1
    assert dict(coded.dtypes)["ids"] == "array<int>"


def test_decoding_alone(spark, odd):
    rows = spark.createDataFrame([([64, 50256],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(rows, PATH).collect()] == ["a<|endoftext|>", "", ""]


class _Captured:
    """Stands in for a table of texts and gives back the function that tasks would run."""
    columns = ["text"]
    schema = T.StructType([T.StructField("text", T.StringType())])

    def drop(self, *names):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_a_task_holds_little_beside_its_texts():
    """A batch of texts is encoded in small slices, and nothing is kept when the task ends."""
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 8, 60_000)]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 400)) for _ in range(900)]
    run = bpe.encode(_Captured(), PATH, decoded="decoded")
    batch = pa.RecordBatch.from_pydict({"text": texts})
    common.powers(common.BASE, 1_000)
    tracemalloc.start()
    rows = ok = 0
    for out in run(iter([batch])):
        rows += out.num_rows
        ok += sum(a == b for a, b in zip(*(out.column(c).to_pylist() for c in ("text", "decoded")),
                                         strict=True))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == ok == len(texts)
    assert most < 45e6
    assert not common._POWERS
