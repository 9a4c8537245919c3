"""Toxicity: words restored by a noisy channel, then scored by a linear model.

A character trigram model is counted over all texts. A word that holds a digit or sign between its
letters, or a letter three times in a row, or letters set apart by blanks, becomes a lattice: each
character offers the letters it may stand for, and signs and repeated letters may be left out. The
Viterbi path under the trigram model is the restored word. Features of a text are its distinct
restored words and their first letters; a logistic model fitted on a bounded sample of labelled rows
scores them.

Only the text enters the score. NULL and empty texts have no features and get the model's base rate.
With labels of one class or none every score is the same prior, a quarter without any. A document labelled twice counts as toxic if
any of its labels says so.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import add_columns, hashed_part, slices, tidy
from tiffin.session import materialise

SAMPLE_ROWS = 20_000  # labelled rows used for fitting, the smallest hashes of doc_id
CHI_SQUARE = 16.0     # a feature must differ this clearly between the classes
MIN_DOCUMENTS = 3
ROWS_PER_TASK = 250   # of the sample, whose features a task holds
CACHED_WORDS = 150_000

# What a sign may stand for in disguised words.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
              "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c",
              "€": "e", "£": "l", "¡": "i"}
SWAP, LEAVE_SIGN, LEAVE_LOOKALIKE, LEAVE_REPEAT = -1.0, -0.3, -6.0, -1.5

SYMBOLS = 61  # 0: no letter, 1-26: a-z, 27-59: other Latin-1 letters, 60: any other letter
TRIPLE = re.compile(r"(\w)\1\1")
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")  # letters set apart by any white space
LETTERS = re.compile(r"[^\W\d_]")
EDGE = "".join(chr(c) for c in range(33, 127)
               if not chr(c).isalnum() and chr(c) not in LOOKALIKES) + "…“”„«»‘’¿"


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x80, 0x10000):
        if chr(c).isalpha():
            table[c] = 60
    table[0x10000:] = 0
    for i, c in enumerate(range(0xDF, 0x100)):
        table[c] = 27 + i if chr(c).isalpha() else 0
    for i in range(26):
        table[97 + i] = 1 + i
    return table


def _trigrams(texts: list, table: np.ndarray) -> np.ndarray:
    joined = " ".join(t for t in texts if t).lower()
    code = table[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    code = np.concatenate([np.zeros(2, np.int32), code.astype(np.int32), np.zeros(1, np.int32)])
    a, b, c = code[:-2], code[1:-1], code[2:]
    a = np.where(b == 0, 0, a)
    counts = np.bincount((a * SYMBOLS + b) * SYMBOLS + c, minlength=SYMBOLS**3)
    counts[0] = 0
    return counts


def count_trigrams(df: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): trigram counts of all texts; at most ``SYMBOLS`` ** 3 rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _symbol_table(), np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            column = batch.column(0)
            for lo, hi in slices(column):
                total += _trigrams(column.slice(lo, hi - lo).to_pylist(), table)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])],
                                         names=["code", "n"])
    return (df.select(text).mapInArrow(tidy(run), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


def log_model(rows: list) -> np.ndarray:
    """Log probabilities of a letter after two letters, smoothed by shorter contexts."""
    n = np.zeros(SYMBOLS**3)
    for code, count in rows:
        n[code] = count
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = n.sum(0)
    single = (pair.sum(0) + 1) / (pair.sum() + SYMBOLS)
    p2 = (pair + 5 * single) / (pair.sum(1, keepdims=True) + 5)
    p3 = (n + 5 * p2[None]) / (n.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Restorer:
    """Decodes disguised words; remembers a bounded number of them."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        table = _symbol_table()
        self.table = table
        self.options = {c: [(o, int(table[ord(o)]), SWAP) for o in s]
                        + [("", -1, LEAVE_LOOKALIKE)] for c, s in LOOKALIKES.items()}

    def _choices(self, word: str, i: int) -> list[tuple[str, int, float]]:
        c = word[i]
        if c in self.options:
            return self.options[c]
        code = int(self.table[ord(c)])
        if not code:
            return [("", -1, LEAVE_SIGN)]
        out = [(c, code, 0.0)]
        if i and word[i - 1] == c:
            out.append(("", -1, LEAVE_REPEAT))
        return out

    def viterbi(self, word: str) -> str:
        """The likeliest word behind ``word``; states are the last two letters."""
        model = self.model
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(word)):
            later: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for letter, code, cost in self._choices(word, i):
                for (a, b), (score, path) in states.items():
                    if code < 0:
                        key, value, way = (a, b), score + cost, path
                    else:
                        key, value = (b, code), score + cost + model[a][b][code]
                        way = (path, letter)
                    old = later.get(key)
                    if old is None or value > old[0]:
                        later[key] = (value, way)
            states = later
        _, way = max(((s + model[a][b][0], w) for (a, b), (s, w) in states.items()),
                     key=lambda x: x[0])
        out = []
        while way is not None:
            way, letter = way
            out.append(letter)
        return "".join(reversed(out))

    def restore(self, word: str) -> str:
        """A lower-case word without disguise; empty if it holds no letter."""
        core = word.strip(EDGE)
        # A run of one sign at the edge is decoration, a single one may stand for a letter.
        while len(core) > 1 and core[-1] == core[-2] and not core[-1].isalnum():
            core = core.rstrip(core[-1]).strip(EDGE)
        while len(core) > 1 and core[0] == core[1] and not core[0].isalnum():
            core = core.lstrip(core[0]).strip(EDGE)
        if core.isalpha():
            return self.viterbi(core) if TRIPLE.search(core) else core
        return self.viterbi(core) if LETTERS.search(core) else ""


def word_features(word: str) -> list[str]:
    return ["=" + word, "^" + word[:3], "^" + word[:4]] if len(word) > 3 else ["=" + word]


class Features:
    """Feature counts of a text: in how many of its distinct restored words each one occurs."""

    def __init__(self, restorer: Restorer):
        self.restorer = restorer
        self.known: dict[str, str] = {}

    def words(self, text: str | None) -> set[str]:
        text = (text or "").lower()
        raw = set(text.split())
        joined = ["".join(m.group().split()) for m in SPACED.finditer(text)]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, restore = self.known, self.restorer.restore
        out = set()
        for w in raw:
            r = known.get(w)
            if r is None:
                r = known[w] = restore(w)
            out.add(r)
        for run in joined:  # neighbours may have been joined too, so look at the parts
            whole = restore(run)
            out.add(whole)
            out.update(whole[i:j] for i in range(len(whole))
                       for j in range(i + 3, min(len(whole), i + 16) + 1))
        out.discard("")
        return out


def fit(sample: DataFrame, model: np.ndarray) -> tuple[dict[str, float], float]:
    """Weights and bias from rows (text, toxic 0/1) of bounded number."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, seen = Features(Restorer(model)), [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                seen[toxic].update({f for w in features.words(text) for f in word_features(w)}
                                   | {""})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[0][f] for f in names], pa.int64()),
             pa.array([seen[1][f] for f in names], pa.int64())], names=["feature", "n0", "n1"])
    rows = sample.select("text", "toxic")
    counts = rows.mapInArrow(tidy(count), "feature string, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    totals = rows.agg(F.sum(1 - F.col("toxic")).alias("n0"), F.sum("toxic").alias("n1")).first()
    n0, n1 = totals.n0 or 0, totals.n1 or 0
    if not n0 or not n1:
        return {}, math.log((n1 + 0.5) / (n0 + 1.5))
    k = F.col("n0") + F.col("n1")
    gap = F.col("n1").cast("double") * n0 - F.col("n0").cast("double") * n1
    chi = gap * gap * (n0 + n1) / (k * (n0 + n1 - k) * F.lit(float(n0)) * F.lit(float(n1)))
    chosen = sorted(r.feature for r in counts.where(
        (F.col("feature") != "") & (k >= MIN_DOCUMENTS) & (k < n0 + n1) & (chi >= CHI_SQUARE))
        .select("feature").collect())
    number = {f: i for i, f in enumerate(chosen)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(Restorer(model))
        for batch in batches:
            found = [Counter(number[f] for w in features.words(t) for f in word_features(w)
                             if f in number) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(c) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32())),
                 batch.column(1)], names=["at", "n", "toxic"])
    data = rows.mapInArrow(tidy(vectors), "at array<int>, n array<int>, toxic int").collect()
    data = sorted(data, key=lambda r: (r.toxic, r.at, r.n))
    return logistic([(r.at, r.n, r.toxic) for r in data], chosen)


def logistic(rows: list[tuple], names: list[str], steps: int = 400) -> tuple[dict, float]:
    """Ridge logistic regression by Adam over the whole sample."""
    y = np.array([r[2] for r in rows], np.float64)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    col = np.array([i for r in rows for i in r[0]], np.int64)
    val = np.log1p(np.array([n for r in rows for n in r[1]], np.float64))
    w = np.zeros(len(names) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = math.log(y.mean() / (1 - y.mean()))
    for t in range(1, steps + 1):
        z = np.bincount(row, val * w[col], len(rows)) + w[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(col, val * gap[row], len(names)), gap.sum()) / len(rows)
        grad[:-1] += 1e-5 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {f: float(x) for f, x in zip(names, w, strict=False) if abs(x) > 1e-6}, float(w[-1])


def score(df: DataFrame, model: np.ndarray, weights: dict[str, float], bias: float,
          text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1."""
    def make():
        features = Features(Restorer(model))

        def one(t: str | None) -> float:
            found: Counter = Counter()
            for w in features.words(t):
                for f in word_features(w):
                    if f in weights:
                        found[f] += 1
            z = bias + sum(math.log1p(n) * weights[f] for f, n in sorted(found.items()))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        return lambda texts: [pa.array([one(t) for t in texts], pa.float64())]
    return add_columns(df, text, [T.StructField(out, T.DoubleType())], make)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def classify(docs: DataFrame, corpus: DataFrame, labels: DataFrame,
             sample: int = SAMPLE_ROWS, out: str = "score") -> DataFrame:
    """Add the score to ``docs``; the character model is counted and the classifier fitted on
    ``corpus`` (doc_id, text) and ``labels`` (doc_id, toxic), without the held-out fifth."""
    model = log_model([(r.code, r.n) for r in count_trigrams(corpus).collect()])
    h = F.xxhash64("doc_id")
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
                           & ~held_out(F.col("doc_id")) & hashed_part(h, 3 * sample,
                                                                      labels.count()))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # The sample has at most `sample` rows of two numbers, which bounds the broadcast.
    rows = materialise(corpus.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
                       .select("text", "toxic").repartition(1 + sample // ROWS_PER_TASK),
                       "toxic-sample")
    return score(docs, model, *fit(rows, model), out=out)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select("doc_id", "text")
    out = classify(rows, rows, labels.select("doc_id", "toxic"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
