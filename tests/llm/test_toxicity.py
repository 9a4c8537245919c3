import numpy as np

from tiffin.llm import toxicity


def restorer(words):
    text = " ".join(words * 50)
    counts = toxicity._trigrams([text], toxicity._symbol_table())
    code = np.flatnonzero(counts)
    return toxicity.Restorer(toxicity.log_model([(int(c), int(counts[c])) for c in code]))


def test_disguised_words_are_restored():
    r = restorer(["idiot", "stupid", "pathetic", "hello", "world", "book", "the"])
    for raw, word in {"1d10t": "idiot", "$tup1d": "stupid", "i.d.i.o.t": "idiot",
                      "idiooooot": "idiot", "p@the7ic": "pathetic", "hello,": "hello",
                      "the%%%": "the", "book": "book", "1234": "", "---": ""}.items():
        assert r.restore(raw) == word, raw
    words = toxicity.Features(r).words("you i d i o t there")
    assert "idiot" in words


def test_letters_set_apart_in_any_way():
    r = restorer(["idiot", "ass", "hello", "unbelievablystupidperson"])
    features = toxicity.Features(r)
    for text, word in {"i  d  i  o  t": "idiot", "i\td\ti\to\tt": "idiot", "i\nd\ni\no\nt": "idiot",
                       "you a s s there": "ass", "1 d 1 0 t": "idiot",
                       " ".join("unbelievablystupidperson"): "unbelievablystupidperson"}.items():
        assert word in features.words(text), text
    assert "ass" not in features.words("a mass of grass")


def test_viterbi_equals_all_paths():
    r = restorer(["idiot", "lost", "tool"])

    def every(word, i, state, score, made):
        if i == len(word):
            yield score + r.model[state[0]][state[1]][0], made
            return
        for letter, code, cost in r._choices(word, i):
            if code < 0:
                yield from every(word, i + 1, state, score + cost, made)
            else:
                yield from every(word, i + 1, (state[1], code),
                                 score + cost + r.model[state[0]][state[1]][code], made + letter)
    for word in ("1d10t", "l0$t", "t00ll", "!d-i.0"):
        assert r.viterbi(word) == max(every(word, 0, (0, 0), 0.0, ""))[1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = toxicity.verdicts(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.05


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (6, 0), (None, 1), (7, None), (8, 5)],
                                   "doc_id long, toxic int")
    got = toxicity.verdicts(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.verdicts(nothing, labels).collect() == []
    none = toxicity.verdicts(odd, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
