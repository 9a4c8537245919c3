import hashlib
import random

from tiffin.llm import chat

CHATS = "conv_id long, turn long, role string, text string"


def test_round_trip_of_any_text():
    rng = random.Random(1)
    for _ in range(5000):
        turns = [("".join(rng.choice("ab:\\#< \n") for _ in range(rng.randrange(5))),
                  "".join(rng.choice("ab\\#</turn>: \n") for _ in range(rng.randrange(9))))
                 for _ in range(rng.randrange(4))]
        output, spans, rewrites = chat.locate(turns, chat.render)
        assert rewrites == -1 and chat.parse(output) == turns
        assert [chat.unescape(output[s[2]:s[3]]) for s in spans] == [t for _, t in turns]
        assert [s[0] for s in spans] + [len(output)] == [0] + [s[1] for s in spans]


def test_templates_that_rewrite_history():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert chat.locate(turns, lambda t: f"[{len(t)}]" + chat.render(t))[2] == 0

    def drops_thoughts(t):  # an assistant's text changes once another turn follows
        return "".join(f"<{r}>{'...' if r == 'assistant' and i < len(t) - 1 else x}"
                       for i, (r, x) in enumerate(t))
    assert chat.locate(turns, drops_thoughts)[1:] == ([], 2)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None),
            (None, 0, None, "x"), (2, None, "assistant", "late"), (2, 0, "assistant", "b"),
            (3, 0, "user", "")]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, CHATS)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 2, 3: 1}
    assert got[2].loss_sha256 == hashlib.sha256(b"lateb").hexdigest() and got[2].loss_chars == 5
    assert chat.digests(spark.createDataFrame([], CHATS)).collect() == []


def test_long_texts_and_clashing_names(spark):
    from pyspark.sql import functions as F
    long = "say \\# <it> again. " * 20_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long)]
    plain = spark.createDataFrame(rows, CHATS)
    clash = plain
    for name in ("turns", "formatted", "OUTPUT", "spans", "n_turns", "loss_chars", "rewrites", "h"):
        clash = clash.withColumn(name, F.lit("clash"))
    want, = chat.digests(plain).collect()
    got, = chat.digests(clash).collect()
    assert got.asDict() == want.asDict()
    assert got.n_turns == 3 and got.loss_chars == 2 * len(long)
    assert got.loss_sha256 == hashlib.sha256((long * 2).encode()).hexdigest()
