import random
import re

from tiffin.llm import pii

RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and not all(int(p) <= 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_the_rules():
    rng = random.Random(2)
    for _ in range(30_000):
        text = "".join(rng.choice("a@.1 +-(5)b\né") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == brute(text)
    for text in ("1" * 20_000, "a" * 20_000 + "@", "+1" + " " * 20_000, "@" * 20_000,
                 "1." * 9_000 + "x"):
        pii.base_spans(text)  # linear time


def test_model_keeps_base_spans_and_adds(spark, sample):
    model = pii.train(sample)
    text = "card 4111 1111 1111 1111, mail a.b@mail.example.com or 10.0.0.1 or (538) 555-0390."
    base, spans = pii.find_spans(text, model)
    assert base == brute(text) and set(base) <= set(spans)
    assert pii.find_spans("In 2024 there were 365 days and 12 months.", model) == ([], [])


def test_best_labelling_equals_all_labellings():
    rng = random.Random(4)
    text = "+1 (5) 55-0 a@b.c 1.2.3.4"
    region = pii.Region(text, 0, len(text))
    names = sorted({f for row in region.segments for _, fs in row for f in fs})
    model = pii.SemiMarkov({(k, f): rng.uniform(-1, 1) for k in pii.KINDS for f in names})

    def every(j):
        if j < 0:
            yield 0.0, ()
            return
        for s, rest in every(j - 1):
            yield s, rest
        for i, fs in region.segments[j]:
            for kind, w in zip(pii.KINDS, model.scores(fs)):
                for s, rest in every(i - 1):
                    yield s + w, (*rest, (region.tokens[i][0], region.tokens[j][1], kind))
    best = max(every(len(region.tokens) - 1))
    assert tuple(d[:3] for d in model.decode(region)) == best[1]


def test_odd_rows(odd, nothing, sample):
    got = pii.digests(odd).collect()
    assert len(got) == odd.count()
    masked = pii.mask(odd, pii.train(sample))
    assert masked.columns == odd.columns
    texts = {r.doc_id: r.text for r in masked.collect() if r.doc_id in (3, 4, 8)}
    assert texts[3] is None and texts[4] == "" and texts[8].endswith("mail <email>")
    assert pii.digests(nothing).collect() == []
