"""Exact substring removal: each byte covered by a ``length``-byte string that also starts earlier.

A suffix array of a whole corpus is no single machine's work. The corpus is cut so that all places
of a repeated string meet in one task, and only what may be repeated is sorted at all:

1. Anchors. In every window that spans one ``length``-byte string, the smallest hash of ``GRAM``
   bytes is an anchor. The choice depends on the window's bytes alone, so equal strings have equal
   anchors at equal distances.
2. Anchors seen in one text only, and once there, are dropped. Equal texts count as one: the later
   ones are removed whole.
3. Around each other anchor travels the stretch of text that strings through it can reach. A task
   holds all stretches of its anchors and builds two sparse suffix arrays over them: the suffixes
   from the anchors, and the reversed prefixes before them. Longest common prefixes of neighbours
   cut both orders into runs; for each offset of the anchor in the string, the places in the same
   run of both share the whole string. Read in text order, a place with a previous smaller one in
   its run has an earlier match (its longest previous factor is at least ``length``), so it goes,
   and the first stays.

An anchor at very many places is judged in chunks first, and only the places that no chunk removes
are judged together.

Order is by doc_id, then place; NULL ids come first, and different texts of one id are ordered by a
hash of the text. Repeated rows (same id and text) are one document and get the same result. NULL
and empty texts have nothing to remove. All texts count as UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import BASE, BASE_INVERSE, fresh, mix, powers, slices, tidy
from tiffin.operators import skew
from tiffin.session import materialise

GRAM = 32           # bytes of an anchor
CHUNK = 50_000      # places of one anchor judged together at first
PER_TASK = 60_000   # stretches of text per task
SLICE = 1_000_000
NO_ID = -(1 << 63)


def slide(values: np.ndarray, width: int, fold) -> np.ndarray:
    """``fold`` over each run of ``width`` values, by doubling; shorter by width - 1."""
    done = 1
    now = values
    while done * 2 <= width:
        now = fold(now[:-done], now[done:])
        done *= 2
    rest = width - done
    return fold(now[:-rest], now[rest:]) if rest else now


def anchors(raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of every anchor of the texts."""
    none = np.zeros(0, np.int64)
    chosen = [i for i, r in enumerate(raw) if len(r) >= length]
    if not chosen:
        return none, none, none.astype(np.uint64)
    joined = np.frombuffer(b"".join(raw[i] for i in chosen), np.uint8)
    sizes = np.array([len(raw[i]) for i in chosen], np.int64)
    ends = np.cumsum(sizes)
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(joined)),
              out=total[1:])
    gram = mix((total[GRAM:] - total[:-GRAM]) * powers(BASE_INVERSE, len(joined))[:len(joined)
                                                                               - GRAM + 1])
    short = (gram >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    width = length - GRAM + 1
    low = slide(short, width, np.minimum)  # one per string of `length` bytes
    # Strings that would cross the end of a text do not count.
    for e in ends[:-1].tolist():
        low[max(0, e - length + 1):e] = 0
    padded = np.zeros(len(low) + 2 * (width - 1), np.uint32)
    padded[width - 1:width - 1 + len(low)] = low
    place = np.flatnonzero(short <= slide(padded, width, np.maximum))
    text = np.searchsorted(ends, place, side="right")
    return (np.array(chosen, np.int64)[text], place - (ends - sizes)[text], gram[place])


def _raw(texts: list) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(gram, tag): each distinct anchor of a text; the tag's low bit tells that it repeats in it."""
    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE):
                raw = _raw(batch.column(1).slice(lo, hi - lo).to_pylist())
                tag = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                text, _, gram = anchors(raw, length)
                order = np.lexsort((gram, text))
                text, gram = text[order], gram[order]
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])]) \
                    if len(text) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[first].view(np.int64)),
                     pa.array((tag[text[first]] & ~1) | (count > 1))], names=["gram", "tag"])
    return docs.select("tag", "text").mapInArrow(tidy(run), "gram long, tag long")


def repeated(rows: DataFrame, partitions: int) -> DataFrame:
    """(tag, gram, part) of anchors in two texts, or twice in one. Streams over sorted rows; ``part``
    counts chunks of an anchor's places."""
    def run(batches):
        kept = None  # the last row: its successor is not known yet
        index = 0    # its number among the rows of its anchor

        def judge(gram, tag, before, last):
            text, many = tag >> 1, (tag & 1).astype(bool)
            other = (gram[1:] == gram[:-1]) & (text[1:] != text[:-1])
            hit = many.copy()
            hit[1:] |= other
            hit[:-1] |= other
            head = np.concatenate([[True], gram[1:] != gram[:-1]])
            where = np.arange(len(gram))
            number = where - np.maximum.accumulate(np.where(head, where, 0))
            number[gram == gram[0]] += before
            out = hit if last else hit & (where < len(gram) - 1)
            return (text[out] << 1, gram[out], number[out] // CHUNK), int(number[-1])

        def batch_of(parts):
            return pa.RecordBatch.from_arrays(
                [pa.array(parts[0]), pa.array(parts[1]), pa.array(parts[2], pa.int64())],
                names=["tag", "gram", "part"])
        was = False  # the kept row already has a predecessor of another text
        for batch in batches:
            gram = batch.column(0).to_numpy(zero_copy_only=False)
            tag = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(gram):
                continue
            if kept is not None:
                gram = np.concatenate([[kept[0]], gram])
                tag = np.concatenate([[kept[1] | was], tag])
            # A row that differs from its predecessor is repeated whatever follows.
            was = len(gram) > 1 and bool(gram[-1] == gram[-2] and tag[-1] >> 1 != tag[-2] >> 1)
            parts, number = judge(gram, tag, index, False)
            kept, index = (gram[-1], tag[-1]), number
            was = was or (len(gram) == 1 and bool(tag[-1] & 1))
            yield batch_of(parts)
        if kept is not None:
            yield batch_of(judge(np.array([kept[0]]), np.array([kept[1] | was]), index, True)[0])
    return (rows.repartition(partitions, "gram").sortWithinPartitions("gram", "tag")
            .mapInArrow(tidy(run), "tag long, gram long, part long"))


STRETCH = ("doc_id long, tag long, place long, gram long, part long, before int, bytes binary, "
           "low long, high long")


def stretches(docs: DataFrame, length: int) -> DataFrame:
    """The bytes around each repeated anchor; ``docs`` has grams (array of gram, part).

    Of equal stretches within one text only the first travels: all strings through the others start
    earlier in this text already. What they remove comes as rows without bytes, one per merged run,
    so a text of one line over and over is no hot key.
    """
    reach = length - GRAM

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(2), SLICE):
                part = batch.slice(lo, hi - lo)
                raw = _raw(part.column(2).to_pylist())
                text, place, gram = anchors(raw, length)
                bounds = np.searchsorted(text, np.arange(len(raw) + 1))
                cols: list[list] = [[], [], [], [], [], [], [], [], []]
                for i, wanted in enumerate(part.column(3)):
                    a, b = bounds[i], bounds[i + 1]
                    if a == b:
                        continue
                    own = wanted.values
                    known = own.field("gram").to_numpy(zero_copy_only=False)
                    chunk = own.field("part").to_numpy(zero_copy_only=False)
                    order = np.argsort(known)
                    known, chunk = known[order], chunk[order]
                    here = gram[a:b].view(np.int64)
                    at = np.searchsorted(known, here)
                    at[at == len(known)] = 0
                    hit = np.flatnonzero(known[at] == here)
                    doc_id, tag = part.column(0)[i].as_py(), part.column(1)[i].as_py()
                    body = raw[i]
                    seen: set = set()
                    gone: list[list[int]] = []
                    for p, g, c in zip(place[a:b][hit].tolist(), here[hit].tolist(),
                                       chunk[at[hit]].tolist(), strict=True):
                        before = min(p, reach)
                        piece = body[p - before:p + length]
                        if (before, piece) not in seen:
                            seen.add((before, piece))
                            row = (doc_id, tag, p, g, c, before, piece, -1, -1)
                            for col, v in zip(cols, row, strict=True):
                                col.append(v)
                        elif len(piece) >= length:
                            low, end = p - before, min(p + length, len(body))
                            if gone and low <= gone[-1][1]:
                                gone[-1][1] = end
                            else:
                                gone.append([low, end])
                    for low, end in gone:
                        row = (doc_id, tag, low, tag ^ low, 0, 0, None, low, end - length)
                        for col, v in zip(cols, row, strict=True):
                            col.append(v)
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=["doc_id", "tag", "place", "gram", "part", "before", "bytes", "low",
                           "high"])
    return docs.select("doc_id", "tag", "text", "grams").mapInArrow(tidy(run), STRETCH)


def _sorted_runs(keys: np.ndarray, body: np.ndarray, size: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows of ``body`` within equal keys, and the common prefix of each row
    with the one before it (-1 at a new key)."""
    n, width = body.shape
    by_size = np.argsort(size, kind="stable")  # of rows that padding makes equal, shorter ones first
    table = np.empty((n, width + 8), np.uint8)
    table[:, :8] = keys[by_size].astype(">u8").view(np.uint8).reshape(n, 8)
    table[:, 8:] = body[by_size]
    order = by_size[np.argsort(table.view(f"S{width + 8}").reshape(-1), kind="stable")]
    body, size, keys = body[order], size[order], keys[order]
    common = np.full(n, -1, np.int64)
    if n > 1:
        differ = body[1:] != body[:-1]
        first = np.where(differ.any(1), differ.argmax(1), width)
        first = np.minimum(first, np.minimum(size[1:], size[:-1]))
        common[1:] = np.where(keys[1:] == keys[:-1], first, -1)
    return order, common


def judge(doc: np.ndarray, tag: np.ndarray, place: np.ndarray, gram: np.ndarray,
          before: np.ndarray, bodies: list[bytes], length: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start with an earlier match per stretch (-1: none), and whether some start
    has none."""
    n, reach = len(doc), length - GRAM
    size = np.array([len(b) for b in bodies], np.int64)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.cumsum(size) - size
    anchor = begin + before
    right = size - before
    col = np.arange(length)
    at = anchor[:, None] + col
    ahead = np.where(col < right[:, None], flat[np.minimum(at, len(flat) - 1)], 0)
    col = np.arange(1, reach + 1)
    at = anchor[:, None] - col
    behind = np.where(col <= before[:, None], flat[np.maximum(at, 0)], 0)
    keys = gram.view(np.uint64)
    order_r, common_r = _sorted_runs(keys, ahead.astype(np.uint8), right)
    order_l, common_l = _sorted_runs(keys, behind.astype(np.uint8), before)
    in_text = np.lexsort((place, tag, doc))
    low = np.full(n, -1, np.int64)
    high = np.full(n, -1, np.int64)
    single = np.zeros(n, bool)
    run_r, run_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for r in range(reach + 1):  # the anchor stands r bytes after the start of the string
        run_r[order_r] = np.cumsum(common_r < length - r)
        run_l[order_l] = np.cumsum(common_l < r)
        who = in_text[(before[in_text] >= r) & (right[in_text] >= length - r)]
        key = run_r[who] * (n + 1) + run_l[who]
        order = np.argsort(key, kind="stable")
        key = key[order]
        later = np.zeros(len(who), bool)
        later[order[1:]] = key[1:] == key[:-1]  # a smaller place stands before it in its run
        start = place[who] - r
        gone = who[later]
        low[gone] = start[later]  # r grows, so starts fall
        fresh_high = high[gone] < 0
        high[gone[fresh_high]] = start[later][fresh_high]
        single[who[~later]] = True
    return low, high, single


def removals(rows: DataFrame, keys: list[str], partitions: int, length: int, again: bool
             ) -> DataFrame:
    """Judge stretches; every row comes back with low, high, and ``alone`` where a start is left.
    Bytes come back only with ``again``, for rows that must be judged once more. Rows without bytes
    have been judged and pass through."""
    names = ["doc_id", "tag", "low", "high", "alone"]
    if again:
        names += ["place", "gram", "part", "before", "chunks", "bytes"]

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        every = pa.Table.from_batches(parts).combine_chunks()
        whole = every.filter(every.column("bytes").is_valid())
        known = every.filter(every.column("bytes").is_null())
        if known.num_rows:
            blank = {"alone": pa.array(np.zeros(known.num_rows, bool))}
            yield pa.RecordBatch.from_arrays(
                [blank[n] if n in blank else known.column(n).combine_chunks() for n in names],
                names=names)
        if not whole.num_rows:
            return
        col = {c: whole.column(c).to_numpy() for c in ("doc_id", "tag", "place", "gram", "part",
                                                       "before", "chunks")}
        group = mix(col["gram"].view(np.uint64) ^ mix(col["part"].view(np.uint64))) \
            if "part" in keys else col["gram"].view(np.uint64)
        body = whole.column("bytes").to_pylist()
        low, high, single = judge(col["doc_id"], col["tag"], col["place"], group.view(np.int64),
                                  col["before"].astype(np.int64), body, length)
        once = single & (col["chunks"] > 1)
        keep = (low >= 0) | once
        out = [pa.array(col["doc_id"][keep]), pa.array(col["tag"][keep]), pa.array(low[keep]),
               pa.array(high[keep]), pa.array(once[keep])]
        if again:
            out += [pa.array(col[c][keep]) for c in ("place", "gram", "part", "before", "chunks")]
            out.append(pa.array([b if o else None for b, o, k in
                                 zip(body, once, keep, strict=True) if k], pa.binary()))
        yield pa.RecordBatch.from_arrays(out, names=names)
    schema = "doc_id long, tag long, low long, high long, alone boolean"
    if again:
        schema += ", place long, gram long, part long, before int, chunks long, bytes binary"
    return rows.repartition(partitions, *keys).mapInArrow(tidy(run), schema)


REMOVED = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                    T.StructField("end", T.LongType())]))


def cut(docs: DataFrame) -> DataFrame:
    """Merge ``marks`` into ``removed`` (byte spans) and add ``kept``, the other bytes."""
    rest = fresh(docs, "marks", "removed", "kept")
    schema = T.StructType(rest.schema.fields + [T.StructField("removed", REMOVED),
                                                T.StructField("kept", T.BinaryType())])
    names = schema.names
    text_at, width = rest.columns.index("text"), len(rest.columns)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(text_at)):
                part = batch.slice(lo, hi - lo)
                raw = _raw(part.column(text_at).to_pylist())
                removed, kept = [], []
                for body, marks in zip(raw, part.column(width), strict=True):
                    spans: list[list[int]] = []
                    if marks.is_valid:
                        own = marks.values
                        a = own.field("start").to_numpy(zero_copy_only=False)
                        b = own.field("end").to_numpy(zero_copy_only=False)
                        for i in np.argsort(a, kind="stable").tolist():
                            if spans and a[i] <= spans[-1][1]:
                                spans[-1][1] = max(spans[-1][1], int(b[i]))
                            else:
                                spans.append([int(a[i]), int(b[i])])
                    removed.append([{"start": s, "end": e} for s, e in spans])
                    pieces, at = [], 0
                    for s, e in spans:
                        pieces.append(body[at:s])
                        at = e
                    kept.append(b"".join(pieces) + body[at:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(width)]
                    + [pa.array(removed, span), pa.array(kept, pa.binary())], names=names)
    return docs.select(*rest.columns, "marks").mapInArrow(tidy(run), schema)


def deduplicate(docs: DataFrame, length: int = 100) -> DataFrame:
    """Add ``removed`` and ``kept`` to docs (doc_id, text)."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes are needed")
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.shiftleft(F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 1), 1)
                       .alias("tag"), "text")
    texts = body.select("doc_id", "tag", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("sum"),
                        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    copies = materialise(skew.attach(texts, ["sum"], first=("min", F.col("doc_id")))
                         .drop("sum"), "copies")
    grams = materialise(repeated(anchor_rows(body, length), shuffles), "anchors")
    counts = grams.agg(F.count("*").alias("n"), F.max("part").alias("part")).first()
    partitions = max(shuffles, 1 + (counts.n or 0) // PER_TASK)
    if counts.part:  # an anchor with more places than one chunk
        sizes = grams.groupBy("gram").agg((F.max("part") + 1).alias("chunks")).where("chunks > 1")
        sizes = materialise(sizes, "chunks")
    firsts = copies.where((F.col("doc_id") == F.col("first")) & (F.col("n") >= length)) \
        .select("tag", "doc_id").distinct()
    wanted = (grams.groupBy("tag").agg(F.collect_set(F.struct("gram", "part")).alias("grams"))
              .join(firsts, "tag"))
    around = stretches(body.join(wanted, ["doc_id", "tag"]), length)
    around = (around.join(sizes, "gram", "left").fillna(1, ["chunks"]) if counts.part
              else around.withColumn("chunks", F.lit(1).cast("long")))
    if counts.part:
        found = materialise(removals(around, ["gram", "part"], partitions, length, True), "judged")
        more = removals(found.where("alone").select(
            "doc_id", "tag", "place", "gram", "part", "before", "bytes", "chunks", "low", "high"),
            ["gram"], partitions, length, False)
        spans = found.select("doc_id", "tag", "low", "high").unionByName(
            more.select("doc_id", "tag", "low", "high"))
    else:
        spans = removals(around, ["gram"], partitions, length, False)
    marks = spans.where("low >= 0").select(
        "doc_id", "tag", F.struct(F.col("low").alias("start"),
                                  (F.col("high") + length).alias("end")).alias("mark"))
    later = copies.where((F.col("doc_id") > F.col("first")) & (F.col("n") >= length)).select(
        "doc_id", "tag", F.struct(F.lit(0).cast("long").alias("start"),
                                  F.col("n").alias("end")).alias("mark"))
    marks = marks.unionByName(later).groupBy("doc_id", "tag").agg(
        F.collect_list("mark").alias("marks"))
    out = cut(body.join(marks, ["doc_id", "tag"], "left"))
    return out.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "text",
                      "removed", "kept")


def digests(docs: DataFrame, length: int = 100) -> DataFrame:
    out = deduplicate(docs.select("doc_id", "text"), length)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", (F.octet_length("kept") + gone).cast("long").alias("n_bytes"),
                      gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
