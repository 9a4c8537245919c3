"""Benchmark decontamination: an FM-index per training shard, searched for the test phrases.

A shard is a few megabytes of documents inside a task. Its words become numbers of the phrases'
vocabulary; a run of other words, and the end of a document, is one separator, unequal to any other.
The shard's suffix array gives the Burrows-Wheeler transform, a wavelet matrix over it answers rank
queries, backward search finds the suffix range of all phrases at once, and occurrences are located
by walking back to sampled suffix positions. Marked words are merged into removal spans.

Phrases are windows of consecutive words of a benchmark item; an item of fewer words, but not none,
is one phrase. They are collected to the driver in blocks of bounded size; each block is one pass
over the documents in the same plan, and its hits are added to those of the blocks before.

Defined results: NULL and empty texts have no words and no hits. An item whose id is NULL marks words
and is listed with an empty id. Items that share an id are one item.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import WORD_BYTES, Words, fresh, slices, tidy

BLOCK_CHARS = 4_000_000  # characters of benchmark text per block of phrases
SAMPLE_RATE = 8


class WaveletMatrix:
    """Rank queries over a sequence of numbers below 2 ** bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        now = values
        for bit in range(bits - 1, -1, -1):
            one = (now >> bit) & 1
            ones = np.zeros(len(now) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((bit, ones, len(now) - int(ones[-1])))
            mask = one.astype(bool)
            now = np.concatenate([now[~mask], now[mask]])
        self.first = np.zeros(1 << bits, np.int64)  # where the last level holds each value
        if len(now):
            edges = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))
            self.first[now[edges]] = edges

    def rank(self, value: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each ``value`` occurs before place ``end``; values must occur."""
        at = end
        for bit, ones, zeros in self.levels:
            up = ones[at]
            at = np.where((value >> bit) & 1, zeros + up, at - up)
        return at - self.first[value]

    def access(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), np.int64)
        for bit, ones, zeros in self.levels:
            up = ones[at]
            one = ones[at + 1] - up
            value |= one.astype(np.int64) << bit
            at = np.where(one, zeros + up, at - up)
        return value


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; every 0 is a separator unequal to the others, ordered by place.

    Prefix doubling, in which only suffixes that are not yet told apart are sorted again.
    """
    n = len(symbols)
    zero = symbols == 0
    rank = np.where(zero, np.cumsum(zero) - 1, symbols.astype(np.int64) + int(zero.sum()))
    order = np.argsort(rank, kind="stable")
    key = rank[order]
    fresh_key = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(fresh_key, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    alone = fresh_key & np.append(fresh_key[1:], True)
    slots = np.flatnonzero(~alone)
    step = 1
    while len(slots):
        who = order[slots]
        after = who + step
        tail = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[who] * (n + 1) + tail
        turn = np.argsort(key)
        who, key = who[turn], key[turn]
        order[slots] = who
        fresh_key = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(fresh_key, slots, 0))
        rank[who] = head
        alone = fresh_key & np.append(fresh_key[1:], True)
        slots = slots[~alone]
        step *= 2
    return order


class FmIndex:
    """Counts and places of phrases in a sequence that starts and ends with a separator (0)."""

    def __init__(self, symbols: np.ndarray, size: int, rate: int = SAMPLE_RATE):
        order = suffix_array(symbols)
        self.n = len(symbols)
        last = symbols[order - 1]  # the place before the first is the closing separator
        self.tree = WaveletMatrix(last, max(1, int(size).bit_length()))
        occurs = np.bincount(symbols, minlength=size + 1)
        self.occurs = occurs
        self.before = np.concatenate([[0], np.cumsum(occurs)[:-1]])
        # A place is sampled at fixed distances, and wherever a walk would meet a separator.
        self.sampled = (order % rate == 0) | (last == 0)
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each phrase (rows of symbols, aligned to the right)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        width = phrases.shape[1] if len(phrases) else 0
        for back in range(width):
            live = live[lengths[live] > back]
            symbol = phrases[live, width - 1 - back]
            there = self.occurs[symbol] > 0
            low[live[~there]] = high[live[~there]] = 0
            live, symbol = live[there], symbol[there]
            base = self.before[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = base + self.tree.rank(symbol, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes, by steps back to a sampled one."""
        at, moved = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[at])
        while len(todo):
            symbol = self.tree.access(at[todo])
            at[todo] = self.before[symbol] + self.tree.rank(symbol, at[todo])
            moved[todo] += 1
            todo = todo[~self.sampled[at[todo]]]
        return self.samples[self.sample_rank[at]] + moved


@dataclass
class Phrases:
    """Phrases of a block of items as numbers of their own vocabulary."""

    vocabulary: np.ndarray  # sorted word hashes; number = place + 1
    rows: np.ndarray        # phrases, aligned to the right
    lengths: np.ndarray
    owner_bounds: np.ndarray  # items of each phrase
    owners: np.ndarray
    ids: list[str]


def phrases_of(items: list[tuple[str, str]], width: int) -> Phrases:
    words = Words([text for _, text in items], WORD_BYTES)
    ids = sorted({i for i, _ in items})
    number = {i: k for k, i in enumerate(ids)}
    vocabulary, symbol = np.unique(words.hash, return_inverse=True)
    symbol = symbol.reshape(-1) + 1
    found: dict[bytes, set[int]] = {}
    for k, (item, _) in enumerate(items):
        lo, hi = int(words.bound[k]), int(words.bound[k + 1])
        for i in range(lo, max(lo + 1, hi - width + 1)) if hi > lo else ():
            part = symbol[i:min(hi, i + width)]
            row = np.concatenate([np.zeros(width - len(part), np.int64), part])
            found.setdefault(row.tobytes(), set()).add(number[item])
    rows = np.frombuffer(b"".join(found), np.int64).reshape(-1, width)
    owners = [sorted(o) for o in found.values()]
    return Phrases(vocabulary, rows, (rows > 0).sum(1),
                   np.cumsum([0] + [len(o) for o in owners]),
                   np.array([x for o in owners for x in o], np.int64), ids)


def shard_hits(texts: list, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """Word bounds of the texts, a mark per word, and the numbers of the items found per text."""
    words = Words(texts, WORD_BYTES)
    n = len(words.hash)
    items: list[set] = [set() for _ in texts]
    marked = np.zeros(n, bool)
    if not n or not len(phrases.rows):
        return words.bound, marked, items
    at = np.searchsorted(phrases.vocabulary, words.hash)
    at[at == len(phrases.vocabulary)] = 0
    symbol = np.where(phrases.vocabulary[at] == words.hash, at + 1, 0)
    # One separator for a run of other words, and one between documents.
    origin = np.arange(n)
    cuts = words.bound[1:-1]
    symbol = np.insert(symbol, cuts, 0)
    origin = np.insert(origin, cuts, -1)
    keep = (symbol != 0) | np.concatenate([[True], symbol[:-1] != 0])
    symbol = np.concatenate([[0], symbol[keep], [0]])
    origin = np.concatenate([[-1], origin[keep], [-1]])
    index = FmIndex(symbol, len(phrases.vocabulary))
    low, high = index.search(phrases.rows, phrases.lengths)
    hit = np.flatnonzero(low < high)
    if len(hit):
        counts = (high - low)[hit]
        which = np.repeat(hit, counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place = origin[index.locate(np.repeat(low[hit], counts) + offset)]
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + phrases.lengths[which], -1)
        marked = np.cumsum(edge[:-1]) > 0
        doc = np.searchsorted(words.bound, place, side="right") - 1
        for d, w in set(zip(doc.tolist(), which.tolist(), strict=True)):
            items[d].update(phrases.owners[phrases.owner_bounds[w]:phrases.owner_bounds[w + 1]]
                            .tolist())
    return words.bound, marked, items


FOUND = [T.StructField("n_words", T.LongType()),
         T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                          T.StructField("end", T.LongType())]))),
         T.StructField("items", T.ArrayType(T.StringType()))]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def mark(docs: DataFrame, phrases: Phrases, text: str = "text") -> DataFrame:
    """Add n_words, spans (word places, end exclusive, merged) and items; spans and items of an
    earlier block, if the columns are there already, are kept and added to."""
    earlier = {"n_words", "spans", "items"} <= set(docs.columns)
    rest = fresh(docs, *[f.name for f in FOUND])
    order = rest.columns + (["spans", "items"] if earlier else [])
    out = T.StructType(rest.schema.fields + FOUND)
    text_at, kept = rest.columns.index(text), len(rest.columns)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(text_at)):
                part = batch.slice(lo, hi - lo)
                bound, marked, found = shard_hits(part.column(text_at).to_pylist(), phrases)
                spans, items = [], []
                for k in range(hi - lo):
                    own = marked[bound[k]:bound[k + 1]]
                    pairs: list[tuple[int, int]] = []
                    if own.any():
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
                        pairs = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                    names = {phrases.ids[i] for i in found[k]}
                    if earlier:
                        pairs = _merged(pairs + [(s["start"], s["end"]) for s in
                                                 part.column(kept)[k].as_py() or ()])
                        names |= set(part.column(kept + 1)[k].as_py() or ())
                    spans.append([{"start": a, "end": b} for a, b in pairs])
                    items.append(sorted(names))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(kept)]
                    + [pa.array(np.diff(bound), pa.int64()), pa.array(spans, span),
                       pa.array(items, pa.list_(pa.string()))], names=out.names)
    return docs.select(*order).mapInArrow(tidy(run), out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13,
                  text: str = "text") -> DataFrame:
    """Add n_words, spans and items for all items of ``benchmark`` (item_id, text)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = 1 + chars // BLOCK_CHARS
    out = docs
    for k in range(blocks):
        # A block holds whole items by hash: about BLOCK_CHARS characters, whatever the table.
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) \
            if blocks > 1 else items
        out = mark(out, phrases_of([(r.item, r.text) for r in part.collect()], width), text)
    return out


def hit_words() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, words, hit words, items and the contamination rule: a twentieth of the words."""
    return (decontaminate(docs.select("doc_id", "text"), benchmark)
            .select("doc_id", "n_words", hit_words().alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (20 * F.col("n_hit") >= F.col("n_words"))))
