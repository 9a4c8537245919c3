import re
from collections import Counter

from tiffin.llm import divergence

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen, hit = Counter(tuple(words[a:a + 8]) for a in range(len(words) - 7)), [0] * len(words)
    for a in range(len(words) - 7):
        if seen[tuple(words[a:a + 8])] > 1:
            hit[a:a + 8] = [1] * 8
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), sum(hit))


def test_measures(spark, odd, sample, nothing):
    extra = spark.createDataFrame(
        [(-4, "a b c d e f g h " * 5 + "x\n\n \nq\nq\nq \nz", "de"), (-5, "a " * 9, "fr"),
         (-6, "one\n\none\x0b two #*$", "es")], "doc_id long, text string, lang string")
    docs = extra
    for more in (odd, sample):
        docs = docs.unionByName(more.select("doc_id", "text", "lang"))
    got = divergence.verdicts(docs).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in got) == sorted(brute(r.text) for r in docs.collect())
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert divergence.verdicts(nothing).collect() == []


def test_junk_goes_and_prose_stays(sample):
    rows = divergence.verdicts(sample).join(sample, "doc_id").collect()
    junk = [r for r in rows if not r.base_failed and r.n_symbols > 2 * r.n_words]
    plain = [r for r in rows if not r.base_failed and r.n_symbols == 0 and r.n_repeat_words == 0
             and r.text.upper() != r.text]
    assert junk and not any(r.kept for r in junk)
    assert sum(r.kept for r in plain) >= 0.99 * len(plain)
