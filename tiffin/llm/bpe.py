"""Byte-level BPE: encoding by batched numpy merge rounds, and decoding.

The distinct words of a batch lie in one flat array of symbols. In each round every adjacent pair is
looked up by binary search over the sorted pair keys of the vocabulary, each word takes its pair of
lowest rank, all its places of that pair are merged from left to right, and words without a pair
leave. Because a pair that holds a merged symbol always ranks after the merge that made it, this
gives the same result as merging one place at a time.

NULL text counts as empty and gives no ids. A special token's string in a text becomes its id.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import add_columns

# The published splitting rule of this tokenizer family (fixed value), with the white space of the
# Unicode property, which is what the tokenizer's own pattern engine means by it.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LONG_WORD = 2_000      # symbols; longer words are merged with a heap instead of in rounds
CACHED_WORDS = 150_000  # words remembered by a task before it starts afresh
SLICE = 500_000         # bytes encoded at once, as a piece of text takes some fifteen times its bytes
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file, back to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary file: sorted pair keys with ranks and results, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for word, i in vocab.items():
            self.token[i] = bytes(alphabet[c] for c in word)
        for word, i in self.special.items():
            self.token[i] = word.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.first[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys = (left << 32 | right)[order]
        self.ranks, self.made = order.astype(np.int64), made[order]
        self.split = regex.compile(PATTERN)
        self.specials = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the sorted keys, or -1."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = np.array(self._merge_long(w), np.int32)
        length = np.array([len(words[i]) for i in short], np.int64)
        symbol = self.first[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        owner = np.repeat(np.arange(len(short)), length)
        done_owner, done_symbol = [], []
        while len(symbol):
            at = np.full(len(symbol), -1, np.int64)
            same = owner[1:] == owner[:-1]
            at[:-1][same] = self.find(symbol[:-1][same], symbol[1:][same])
            rank = np.where(at >= 0, self.ranks[at], NONE)
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.repeat(best, sizes)
            alive = least != NONE
            if not alive.all():
                done_owner.append(owner[~alive])
                done_symbol.append(symbol[~alive])
                symbol, owner, rank, least, at = (x[alive] for x in
                                                  (symbol, owner, rank, least, at))
                if not len(symbol):
                    break
            hit = rank == least
            # Places of one pair can only overlap in a run such as "aaa": every second one merges.
            where = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(where) != 1])
            offset = np.arange(len(where)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            where = where[offset % 2 == 0]
            symbol[where] = self.made[at[where]]
            keep = np.ones(len(symbol), bool)
            keep[where + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        if short:
            owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
            order = np.argsort(owner, kind="stable")
            symbol = symbol[order].astype(np.int32)
            cuts = np.cumsum(np.bincount(owner, minlength=len(short)))
            begin = 0
            for i, end in zip(short, cuts.tolist(), strict=True):
                out[i] = symbol[begin:end]
                begin = end
        return out

    def _merge_long(self, word: bytes) -> list[int]:
        """The same merges for one very long word, with a heap of pairs and a linked list."""
        symbol = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known: dict[tuple[int, int], tuple[int, int] | None] = {}

        def look(a: int, b: int):
            if (a, b) not in known:
                at = int(self.find(np.array([a], np.int64), np.array([b], np.int64))[0])
                known[a, b] = None if at < 0 else (int(self.ranks[at]), int(self.made[at]))
            return known[a, b]

        heap = [(p[0], i, symbol[i], symbol[i + 1]) for i in range(n - 1)
                if (p := look(symbol[i], symbol[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j] = look(a, b)[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := look(symbol[x], symbol[y])):
                    heapq.heappush(heap, (p[0], x, symbol[x], symbol[y]))
        return [s for s in symbol if s >= 0]

    def words(self, text: str) -> list[str]:
        return self.split.findall(text)


class Encoder:
    """Encodes texts, remembering the ids of a bounded number of words."""

    def __init__(self, path: str):
        self.bpe = Bpe(path)
        self.known: dict[str, bytes] = {}
        self._reset()

    def _reset(self) -> None:
        # A special token reaches the table as a word of its own, marked so that no plain word can
        # equal it.
        self.known = {"\0" + s: np.array([i], "<i4").tobytes()
                      for s, i in self.bpe.special.items()}

    def pieces(self, text: str) -> list[str]:
        bpe = self.bpe
        if not any(s in text for s in bpe.special):
            return bpe.split.findall(text)
        out: list[str] = []
        for i, part in enumerate(bpe.specials.split(text)):
            out += ["\0" + part] if i % 2 else bpe.split.findall(part)
        return out

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the bounds of each text."""
        pieces = [self.pieces(t) if t else [] for t in texts]
        if len(self.known) > CACHED_WORDS:
            self._reset()
        new = list({w for p in pieces for w in p if w not in self.known})
        coded = self.bpe.encode_words([w.encode("utf-8", "surrogatepass") for w in new])
        self.known.update(zip(new, (c.tobytes() for c in coded), strict=True))
        parts = [b"".join(map(self.known.__getitem__, p)) for p in pieces]
        bounds = np.cumsum([0] + [len(p) // 4 for p in parts])
        return np.frombuffer(b"".join(parts), "<i4"), bounds


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Add the token ids of ``text`` under the vocabulary file ``path``; never NULL.

    ``decoded`` names a column for the text that these ids decode to, made in the same task.
    """
    def make():
        encoder = Encoder(path)

        def fn(texts: list) -> list[pa.Array]:
            flat, bounds = encoder.encode(texts)
            out = [pa.ListArray.from_arrays(
                pa.array(bounds.astype(np.int32)), pa.array(flat),
                type=pa.list_(pa.field("element", pa.int32(), False)))]
            if decoded:
                out.append(_decoded(encoder.bpe.token, np.split(flat, bounds[1:-1])))
            return out
        return fn
    fields = [T.StructField(ids, IDS.dataType, False)]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType(), False))
    return add_columns(df, text, fields, make, SLICE)


def _decoded(token: list[bytes], rows: list) -> pa.Array:
    return pa.array([b"".join(map(token.__getitem__, () if r is None else r))
                     .decode("utf-8", "replace") for r in rows], pa.string())


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of token ids, special tokens included; bytes that are not UTF-8 become U+FFFD.

    NULL ids give an empty text. An id outside the vocabulary is an error.
    """
    def make():
        token = Bpe(path).token
        return lambda rows: [_decoded(token, rows)]
    return add_columns(df, ids, [T.StructField(text, T.StringType(), False)], make)


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    return encode(df.select("doc_id", "text"), path, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
