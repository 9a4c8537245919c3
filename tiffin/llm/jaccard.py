"""Similarity join of documents on word n-grams, with rare-first prefix filtering.

Every document is the set of its distinct n-grams of words, as 64-bit hashes. Two documents link when
``den * intersection >= num * union``. All documents order their n-grams the same way, rare ones
first, so linked documents share an n-gram in a short prefix; documents are joined on prefix n-grams
under length and positional filters, pairs go once through a suffix filter (sizes of the parts that
hash ranges cut the sets into) and once through the exact comparison.

How rare an n-gram is comes from counts per hash bucket over all documents. Any common order is
exact; the counts only decide how much the prefixes prune.

Large groups never become all their pairs. Documents with equal sets are one vertex. Vertices that
share a smallest hash are first compared with one member of their group only, and what links is one
component; the prefix join then looks at pairs of different components alone. No link between
components is lost, whatever the first step finds.

Defined results: a document without words links with nothing. A document with fewer words than n has
one n-gram, all its words. Rows that share a doc_id are one vertex with the links of all its texts.
A NULL doc_id links with nothing and has a NULL component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import NOT_SPACE, Words, mix, slices, tidy
from tiffin.llm.components import components
from tiffin.operators import skew
from tiffin.session import materialise

BUCKETS = 1 << 20      # counters of the rarity sketch: 4 MB whatever the input
BLOCK = 1 << 14        # counters per row while the sketches of tasks are added up
PLACED = np.dtype([("at", "<u2"), ("count", "<u4")])
SEEN_BITS = 1 << 25    # bits of the candidate bitmap: 4 MB whatever the input
PARTS = 32             # hash ranges of the suffix filter
STARS = 4              # smallest hashes per document in the first step
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                        0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
EMPTY = np.zeros(0, np.uint64)


def shingle_sets(texts: list, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words = Words(texts, NOT_SPACE)
    h, bound = words.hash, words.bound
    size = max(0, len(h) - n + 1)
    gram = np.zeros(size, np.uint64)
    for k in range(n):
        gram += h[k:k + size] * MULTIPLIERS[k]
    gram = mix(gram)
    out = []
    for lo, hi in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if hi - lo >= n:
            out.append(np.unique(gram[lo:hi - n + 1]))
        elif hi > lo:
            few = hi - lo
            out.append(mix((h[lo:hi] * MULTIPLIERS[:few]).sum(keepdims=True, dtype=np.uint64)
                           + np.uint64(few)))
        else:
            out.append(EMPTY)
    return out


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    bounds = np.cumsum([0] + [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, kind))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.RecordBatch]]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        for lo, hi in slices(column):
            part = batch.slice(lo, hi - lo)
            yield column.slice(lo, hi - lo).to_pylist(), part


def packed(counts: np.ndarray) -> bytes:
    """A block of counters, ``PLACED`` pairs where these are fewer bytes than all of its numbers."""
    at = np.flatnonzero(counts)
    if len(at) * PLACED.itemsize >= BLOCK * 4:
        return counts.astype(np.uint32).tobytes()
    pairs = np.empty(len(at), PLACED)
    pairs["at"], pairs["count"] = at, counts[at]
    return pairs.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if len(raw) == BLOCK * 4:
        return np.frombuffer(raw, np.uint32).astype(np.int64)
    pairs, out = np.frombuffer(raw, PLACED), np.zeros(BLOCK, np.int64)
    out[pairs["at"]] = pairs["count"]
    return out


def survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass: per document its set size and digest, and per task its part of the rarity sketch.

    Rows with ``block`` NULL are documents; the others hold counters, at most 6 bytes per n-gram of the
    task and 4 MB, so that many small tasks don't send as many whole sketches.
    """
    def run(batches):
        total = np.zeros(BUCKETS, np.uint32)
        for texts, part in _pieces(batches):
            sets = shingle_sets(texts, n)
            every = np.concatenate(sets) if sets else EMPTY
            total += np.bincount((every >> np.uint64(44)).astype(np.int64),
                                 minlength=BUCKETS).astype(np.uint32)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digest, pa.binary()), pa.nulls(len(sets), pa.int32()),
                 pa.nulls(len(sets), pa.binary())],
                names=["doc_id", "n", "digest", "block", "counters"])
        rows = [i for i in range(0, BUCKETS, BLOCK) if total[i:i + BLOCK].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
             pa.nulls(len(rows), pa.binary()), pa.array([i // BLOCK for i in rows], pa.int32()),
             pa.array([packed(total[i:i + BLOCK]) for i in rows], pa.binary())],
            names=["doc_id", "n", "digest", "block", "counters"])
    return docs.mapInArrow(
        tidy(run), "doc_id long, n long, digest binary, block int, counters binary")


def rarity(surveyed: DataFrame) -> np.ndarray:
    """The counters of all tasks added up: ``BUCKETS`` numbers."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                counts = unpacked(raw)
                sums[block] = sums[block] + counts if block in sums else counts
        for block, counts in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                names=["block", "counters"])
    rows = (surveyed.where("block is not null").select("block", "counters")
            .repartition("block").mapInArrow(tidy(run), "block int, counters binary").collect())
    out = np.zeros(BUCKETS, np.int64)
    for block, raw in rows:
        out[block * BLOCK:(block + 1) * BLOCK] += np.frombuffer(raw, np.int64)
    return out


def prefixes(docs: DataFrame, n: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """Per document with words: set size, prefix in rare-first order, parts, smallest hashes."""
    counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)

    def run(batches):
        for texts, part in _pieces(batches):
            ids = part.column(0).to_pylist()
            rows = [(i, s) for i, s in zip(ids, shingle_sets(texts, n), strict=True)
                    if len(s) and i is not None]
            prefix, weight, parts, mins = [], [], [], []
            for _, s in rows:
                count = counts[(s >> np.uint64(44)).astype(np.int64)]
                take = len(s) - -(-num * len(s) // den) + 1
                order = np.argsort(count, kind="stable")[:take]  # ties by hash: s is sorted
                prefix.append(_long(s[order]))
                weight.append(int(count[order].sum()))
                parts.append(np.bincount((s >> np.uint64(37)).astype(np.int64) & (PARTS - 1),
                                         minlength=PARTS))
                mins.append(_long(s[:STARS]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()),
                 pa.array([len(s) for _, s in rows], pa.int64()), pa.array(weight, pa.int64()),
                 _lists(prefix, pa.int64()), _lists(parts, pa.int32()), _lists(mins, pa.int64())],
                names=["doc_id", "n", "weight", "prefix", "parts", "mins"])
    return docs.mapInArrow(tidy(run), "doc_id long, n long, weight long, prefix array<long>, "
                                "parts array<int>, mins array<long>")


def _spot() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SEEN_BITS)) + 1


def seen_table(ids: DataFrame) -> DataFrame:
    """(k, bits): bitmap of hashed ids, ``SEEN_BITS`` bits in rows of 4 KB however many ids."""
    return (ids.select(_spot().alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("k"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits")))


def seen_bits(ids: DataFrame) -> np.ndarray:
    out = np.zeros(SEEN_BITS // 8, np.uint8)
    for k, bits in seen_table(ids).collect():
        start = (k - 1) * 4096
        out[start:start + 4096] = np.frombuffer(bits, np.uint8)[:len(out) - start]
    return out


def maybe_seen(docs: DataFrame, ids: DataFrame, out: str) -> DataFrame:
    """Add whether the bitmap of ``ids`` leaves it open that a row's doc_id is among them; never
    NULL. The bitmap has ``SEEN_BITS`` / 8 bytes at most, which bounds the broadcast."""
    table = materialise(seen_table(ids), "bitmap")
    rows = docs.withColumn("_h", _spot())
    byte = F.expr("conv(hex(substring(bits, cast(bitmap_bit_position(_h) div 8 as int) + 1, 1)),"
                  " 16, 10)").cast("long")
    bit = F.floor(byte / F.pow(F.lit(2.0), F.expr("bitmap_bit_position(_h) % 8"))) % 2
    joined = rows.join(F.broadcast(table), F.expr("bitmap_bucket_number(_h)") == F.col("k"), "left")
    return joined.select(*docs.columns, F.coalesce(bit == 1, F.lit(False)).alias(out))


def verify(docs: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose exact sets reach the threshold.

    Sets are made again from the texts, of documents that a bitmap does not rule out as members of a
    pair, so that texts are never shuffled.
    """
    pairs = materialise(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    seen = seen_bits(ids)
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(SEEN_BITS)).alias("spot")

    def make_sets(batches):
        for batch in batches:
            spot = batch.column(2).to_numpy(zero_copy_only=False)
            hit = (seen[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1
            chosen = batch.filter(pa.array(hit.astype(bool)))
            for texts, part in _pieces([chosen]):
                sets = [s.tobytes() for s in shingle_sets(texts, n)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())],
                                                 names=["doc_id", "grams"])
    sets = materialise(
        docs.where("doc_id is not null").select("doc_id", "text", spot)
        .mapInArrow(tidy(make_sets), "doc_id long, grams binary"), "sets")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, big = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(big, small)
                at[at == len(big)] = 0
                shared = int((big[at] == small).sum()) if len(big) else 0
                keep.append(shared > 0 and den * shared >= num * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .mapInArrow(tidy(compare), "a long, b long"))


def star_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Each document with the fullest member of its groups by smallest hash."""
    keyed = rows.select("doc_id", "n", "weight", F.posexplode("mins").alias("slot", "key"))
    led = skew.attach(keyed, ["key"], salts=16,
                      lead=("max", F.struct("weight", "doc_id", "n")))
    return (led.where((F.col("lead.doc_id") != F.col("doc_id"))
                      & (num * F.greatest("n", "lead.n") <= den * F.least("n", "lead.n")))
            .select(F.greatest("doc_id", "lead.doc_id").alias("a"),
                    F.least("doc_id", "lead.doc_id").alias("b")).distinct())


def prefix_pairs(rows: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs of different components: shared prefix n-gram, length and position, then
    the suffix filter once per pair."""
    of = rows.join(known, rows.doc_id == known.id, "left").select(
        "doc_id", "n", F.coalesce("component", "doc_id").alias("part"), "prefix")
    probe = of.select("doc_id", "n", "part", F.posexplode("prefix").alias("pos", "gram"))
    both = num + den
    ceiling = F.expr(f"({2 * num} * n + {both - 1}) div {both}")
    index = probe.where(F.col("pos") <= F.col("n") - ceiling)
    index = index.select(*[F.col(c).alias(f"i_{c}") for c in index.columns])
    reach = F.least(F.col("n") - F.col("pos"), F.col("i_n") - F.col("i_pos"))
    pairs = probe.join(index, (F.col("gram") == F.col("i_gram"))
                       & (F.col("part") != F.col("i_part"))
                       & ((F.col("i_n") < F.col("n"))
                          | ((F.col("i_n") == F.col("n"))
                             & (F.col("i_doc_id") < F.col("doc_id"))))
                       & (den * F.col("i_n") >= num * F.col("n"))
                       & (both * reach >= num * (F.col("n") + F.col("i_n"))))
    once = pairs.select(F.col("doc_id").alias("a"), F.col("i_doc_id").alias("b")).distinct()
    cut = rows.select("doc_id", "n", "parts")
    a = cut.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    b = cut.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))
    apart = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.abs(x - y)), F.lit(0),
                        lambda s, x: s + x)
    total = F.col("na") + F.col("nb")
    return (once.join(a, "a").join(b, "b")
            .where(both * (total - apart) >= 2 * num * total).select("a", "b"))


def join(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    surveyed = materialise(survey(docs, n), "survey")
    whole = surveyed.where("block is null").select("doc_id", "n", "digest")
    classed = materialise(skew.attach(whole, ["digest"], rep=("min", F.col("doc_id")))
                          .drop("digest"), "classes")
    first = classed.where("n > 0 and doc_id = rep").select("doc_id").distinct()
    rows = materialise(prefixes(docs, n, num, den, rarity(surveyed))
                       .join(first, "doc_id", "left_semi"), "prefixes")
    stars = materialise(verify(docs, star_pairs(rows, num, den), n, num, den), "stars")
    more = verify(docs, prefix_pairs(rows, components(stars), num, den), n, num, den)
    known = components(stars.unionByName(more).unionByName(
        classed.where("n > 0 and doc_id <> rep").select(F.col("doc_id").alias("a"),
                                                        F.col("rep").alias("b"))))
    # Copies of one text are links to the smallest of them, so every document looks itself up.
    return classed.join(known, classed.doc_id == known.id, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))
