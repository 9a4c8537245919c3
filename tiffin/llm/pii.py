"""Personal data: fixed base rules, and more spans from a semi-Markov conditional random field.

The base rules give emails, IPv4 addresses, payment cards and phone numbers with a leading plus. The
random field looks at the regions of a text that hold digits or an at sign. It scores candidate
segments as a whole (shape, digit count, check digit, separators, neighbours), and a dynamic program
over segments of at most ``MAX_TOKENS`` tokens chooses boundaries and types together. A segment that
the best labelling holds and whose marginal probability reaches ``MIN_PROBABILITY`` is added when it
touches no base span, so base spans always stay. Typical additions: phone numbers without the plus.

No table marks personal data, so the field is fitted by maximum likelihood to base spans of a sample
of at most ``SAMPLE_DOCS`` documents (the smallest hashes of their text, whatever the size of the
corpus), each region also in variants with the plus or the country code taken away. NULL and empty
texts have no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import add_columns, hashed_part

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 2_000
SAMPLE_SHARE = 16  # texts looked at per text wanted, as not all have a trigger
SAMPLE_REGIONS = 1_500
MAX_TOKENS = 12
MIN_PROBABILITY = 0.95

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A digit run cannot start a match later than at its first digit, hence the look-behind.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
TRIGGER = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s|.", re.S)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _ip_ok(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 4 and int(p or 0) < 256 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start and then kind; leftmost and non-overlapping per kind."""
    out: list[Span] = []
    at, floor = text.find("@"), 0
    while at >= 0:
        if m := DOMAIN.match(text, at):
            start = at
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end(), "email"))
                floor = m.end()
        at = text.find("@", max(at + 1, floor))
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if _ip_ok(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(DIGITS.findall(m.group()))
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(DIGITS.findall(m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or an at sign, joined over single blanks, with brackets."""
    out: list[tuple[int, int]] = []
    end = -1
    for m in TRIGGER.finditer(text):
        if m.start() < end:
            continue
        start = max(text.rfind(" ", 0, m.start()), text.rfind("\n", 0, m.start()),
                    text.rfind("\t", 0, m.start())) + 1 if end < 0 else m.start()
        if end >= 0:  # do not look back past the last region
            while start > end and not text[start - 1].isspace():
                start -= 1
        end = m.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        if out and start == out[-1][1] + 1 and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


@lru_cache(maxsize=200_000)
def features(shape: str, digits: int, check: bool, octets: bool, left: str, right: str
             ) -> tuple[str, ...]:
    """Names of the features of one whole segment."""
    coarse = re.sub(r"(.)\1+", r"\1", shape)
    return ("bias", f"digits={min(digits, 20)}", f"coarse={coarse[:24]}",
            f"luhn={check}&{14 <= digits <= 19}", f"octets={octets}", f"first={shape[0]}",
            f"last={shape[-1]}", f"left={left}", f"right={right}",
            f"at={coarse.count('@')}&dot={'.' in coarse.rpartition('@')[2]}",
            f"shape={shape if len(shape) < 32 else 'long'}")


def _class(c: str) -> str:
    return "d" if c.isdigit() else "a" if c.isalpha() else c if c in "+@().-_%" else \
        "s" if c.isspace() else "o"


class Region:
    """Tokens of a stretch of text and its candidate segments with their features."""

    def __init__(self, text: str, start: int, end: int):
        self.start = start
        self.tokens = [(m.start() + start, m.end() + start)
                       for m in TOKEN.finditer(text[start:end])]
        self.segments: list[list[tuple[int, tuple[str, ...]]]] = []  # by last token
        n = len(self.tokens)
        for j in range(n):
            row = []
            last = text[self.tokens[j][1] - 1]
            if last.isalnum():
                for i in range(j, max(-1, j - MAX_TOKENS), -1):
                    a, b = self.tokens[i][0], self.tokens[j][1]
                    if b - a > 80:
                        break
                    first = text[a]
                    if first.isspace() or not (first.isalnum() or first in "+(_%"):
                        continue
                    span = text[a:b]
                    digits = sum(c.isdigit() for c in span)
                    if digits < 4 and "@" not in span:
                        continue
                    raw = "".join(c for c in span if c in "0123456789")
                    row.append((i, features(
                        "".join(map(_class, span)), digits,
                        14 <= len(raw) <= 19 and luhn(raw),
                        bool(IP.fullmatch(span)) and _ip_ok(span),
                        _class(text[a - 1]) if a else "^",
                        _class(text[b]) if b < len(text) else "$")))
            self.segments.append(row)


class SemiMarkov:
    """Weights per (type, feature); an outside token weighs nothing."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}
        self.memo: dict[tuple[str, ...], tuple[float, ...]] = {}

    def scores(self, names: tuple[str, ...]) -> tuple[float, ...]:
        if names not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[names] = tuple(sum(self.weights.get((k, f), 0.0) for f in names)
                                     for k in KINDS)
        return self.memo[names]

    def _sums(self, region: Region) -> tuple[list[float], list[float]]:
        """Log sums over the labellings of the tokens before, and from, each place."""
        n = len(region.tokens)
        ahead: list[list[tuple[int, tuple[float, ...]]]] = [[] for _ in range(n)]
        fore = [0.0] + [-math.inf] * n
        for j in range(n):
            terms = [fore[j]]
            for i, names in region.segments[j]:
                s = self.scores(names)
                ahead[i].append((j, s))
                terms += [fore[i] + x for x in s]
            fore[j + 1] = _logsum(terms)
        back = [-math.inf] * n + [0.0]
        for i in range(n - 1, -1, -1):
            back[i] = _logsum([back[i + 1]] + [x + back[j + 1] for j, s in ahead[i] for x in s])
        return fore, back

    def fit(self, examples: list[tuple[Region, set]], rounds: int = 12, rate: float = 0.3,
            decay: float = 1e-4) -> SemiMarkov:
        """Stochastic gradient ascent on the conditional likelihood of the gold segments."""
        for turn in range(rounds):
            step = rate / (1 + turn)
            for region, gold in examples:
                fore, back = self._sums(region)
                for j, row in enumerate(region.segments):
                    for i, names in row:
                        for kind, s in zip(KINDS, self.scores(names), strict=True):
                            p = math.exp(min(0.0, fore[i] + s + back[j + 1] - fore[-1]))
                            gap = ((region.tokens[i][0], region.tokens[j][1], kind) in gold) - p
                            if abs(gap) > 1e-4:
                                for f in names:
                                    w = self.weights.get((kind, f), 0.0)
                                    self.weights[kind, f] = w + step * (gap - decay * w)
                self.memo.clear()
        return self

    def decode(self, region: Region) -> list[tuple[int, int, str, float]]:
        """Segments of the best labelling, with their marginal probabilities."""
        n = len(region.tokens)
        best: list[tuple[float, tuple | None]] = [(0.0, None)]
        for j in range(n):
            top: tuple[float, tuple | None] = (best[j][0], None)
            for i, names in region.segments[j]:
                for kind, s in zip(KINDS, self.scores(names), strict=True):
                    if best[i][0] + s > top[0]:
                        top = (best[i][0] + s, (i, kind, s))
            best.append(top)
        out, j = [], n
        fore = back = None
        while j:
            chosen = best[j][1]
            if chosen is None:
                j -= 1
                continue
            i, kind, s = chosen
            if fore is None:
                fore, back = self._sums(region)
            p = math.exp(min(0.0, fore[i] + s + back[j] - fore[-1]))
            out.append((region.tokens[i][0], region.tokens[j - 1][1], kind, p))
            j = i
        return out[::-1]


def _logsum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms)) if top > -math.inf else top


def find_spans(text: str | None, model: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and those the model adds."""
    text = text or ""
    base = base_spans(text)
    added = []
    for start, end in regions(text):
        inside = [s for s in base if s[0] < end and s[1] > start] if base else []
        if len(inside) == 1 and inside[0][0] <= start and inside[0][1] >= end:
            continue
        region = Region(text, start, end)
        if any(region.segments):
            added += [(a, b, k) for a, b, k, p in model.decode(region) if p >= MIN_PROBABILITY
                      and not any(s[0] < b and s[1] > a for s in inside)]
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def _examples(texts: list[str]) -> list[tuple[Region, set]]:
    """Regions with their base spans as the truth, and variants of phone numbers."""
    out = []
    for text in texts:
        spans = base_spans(text)
        for start, end in regions(text):
            gold = {s for s in spans if s[0] >= start and s[1] <= end}
            # Overlapping kinds: the longest span is the truth.
            gold = {s for s in gold if not any(o != s and o[0] <= s[0] and o[1] >= s[1]
                                               and o[1] - o[0] > s[1] - s[0] for o in gold)}
            out.append((Region(text, start, end), gold))
            for a, b, kind in gold:
                if kind == "phone":
                    for cut in (1, (re.match(r"\+[0-9]{1,3}[ .-]", text[a:b])
                                    or re.match(r"\+", text[a:b])).end()):
                        tail = text[a + cut:b]
                        line = f"{text[max(0, start - 1):start]}{tail}{text[b:b + 1]}"
                        lead = start - max(0, start - 1)
                        out.append((Region(line, lead, lead + len(tail)),
                                    {(lead, lead + len(tail), "phone")}))
    return [(r, g) for r, g in out if any(r.segments)]


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS) -> SemiMarkov:
    """Fit the field to regions of at most ``sample`` documents; only the regions reach the driver.

    The sample is drawn among texts with an at sign or a run of digits, by the hash of the text.
    """
    h = F.xxhash64("text")
    some = docs.select(F.col(text).alias("text")).where(
        hashed_part(h, SAMPLE_SHARE * sample, docs.count()))
    # One stretch per document around its first trigger is enough to learn from.
    place = F.greatest(F.regexp_instr("text", F.lit(r"[0-9]{3}|@")) - 60, F.lit(1))
    rows = (some.where(F.col("text").rlike(r"[0-9]{3}|@"))
            .select(h.alias("h"), F.substring("text", place, F.lit(160)).alias("part"))
            .orderBy("h", "part").limit(sample))
    texts = [r.part for r in rows.collect()]
    examples = _examples(texts)
    return SemiMarkov().fit(examples[:SAMPLE_REGIONS])


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("kind", T.StringType())])


def _spans_array(rows: list[list[Span]]) -> pa.Array:
    flat = [{"start": a, "end": b, "kind": k} for r in rows for a, b, k in r]
    bounds = [0]
    for r in rows:
        bounds.append(bounds[-1] + len(r))
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, kind),
                                    type=pa.list_(pa.field("element", kind)))


def tag(df: DataFrame, model: SemiMarkov, text: str = "text", base: str = "base_spans",
        spans: str = "spans") -> DataFrame:
    """Add the base spans and all spans of each text, as arrays of (start, end, kind)."""
    weights = dict(model.weights)

    def make():
        field = SemiMarkov(weights)

        def fn(texts: list) -> list[pa.Array]:
            found = [find_spans(t, field) for t in texts]
            return [_spans_array([f[0] for f in found]), _spans_array([f[1] for f in found])]
        return fn
    kind = T.ArrayType(SPAN)
    return add_columns(df, text, [T.StructField(base, kind), T.StructField(spans, kind)], make)


def mask(df: DataFrame, model: SemiMarkov, text: str = "text") -> DataFrame:
    """Replace each span of ``text`` by its kind in angle brackets; overlapping spans become one.

    NULL stays NULL. Other columns are kept.
    """
    weights = dict(model.weights)

    def make():
        field = SemiMarkov(weights)

        def one(t: str | None) -> str | None:
            if not t:
                return t
            out, end = [], 0
            for a, b, kind in find_spans(t, field)[1]:
                if a >= end:
                    out += [t[end:a], f"<{kind}>"]
                end = max(end, b)
            return "".join(out) + t[end:]
        return lambda texts: [pa.array([one(t) for t in texts], pa.string())]
    order = df.columns
    return add_columns(df, text, [T.StructField(text, T.StringType())], make).select(*order)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans per kind, the digest of the base spans, and all spans."""
    rows = docs.select("doc_id", "text")
    tagged = tag(rows, train(rows)).drop("text")

    def listed(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return tagged.select("doc_id", *counts, F.sha2(listed("base_spans"), 256).alias("base_sha256"),
                         listed("spans").alias("spans"))
