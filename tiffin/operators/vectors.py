"""Exact nearest vectors by cosine: blocks of queries meet blocks of the corpus.

A block is one row: ids and a matrix of unit vectors. Each corpus block is sent once to each query
block, so the shuffle is the corpus times the number of query blocks, and a task holds one block of
either side and the k best so far; no pair is written out and nothing passes through the driver but
two counts. A query block's corpus blocks are dealt over slots, so that few queries use all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 16_384   # queries per block, on average: 8 MB at 64 dimensions
CORPUS_BLOCK = 8_192   # corpus rows per block at most
TILE = 128             # queries scored at once against a block: 8 MB a matrix
DIGITS = 10 ** 12      # exact copies must tie although a matrix product may differ in the last bits
NO_DIRECTION = -2 * DIGITS  # below any cosine: a zero or NULL vector comes last, without a score

BLOCK = pa.schema([("block", pa.int64()), ("sub", pa.int64()), ("ids", pa.list_(pa.string())),
                   ("width", pa.int32()), ("units", pa.binary())])
BLOCK_DDL = "block long, sub long, ids array<string>, width int, units binary"
BEST = pa.schema([("query_id", pa.string()), ("review_id", pa.string()), ("score", pa.int64())])
BEST_DDL = "query_id string, review_id string, score long"


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """A view per row, not a list of Python numbers, which takes eight times the room."""
    size = column.value_lengths().fill_null(0).to_numpy()
    ends = np.cumsum(size)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return [flat[e - n:e] if ok else None for ok, n, e in
            zip(column.is_valid().to_pylist(), size.tolist(), ends.tolist(), strict=True)]


def _block(block: int, sub: int, ids: list, vectors: list) -> pa.RecordBatch:
    """Rows in order of their ids, as unit vectors; one without direction is NaN."""
    width = max((len(v) for v in vectors if v is not None), default=0)
    if any(v is not None and len(v) != width for v in vectors):
        raise ValueError("vectors of different dimensions")
    order = np.argsort(np.array(ids, dtype=object), kind="stable")
    rows = np.array([vectors[i] if vectors[i] is not None else [0.0] * width for i in order],
                    dtype=np.float64).reshape(len(ids), width)
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    rows[norm[:, 0] == 0] = np.nan  # a NaN in a vector makes its norm one as well
    rows /= norm
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip((block, sub, [ids[i] for i in order], width,
                                           rows.tobytes()), BLOCK.types, strict=True)],
        schema=BLOCK)


def _pack_corpus(slots: int, size: int):
    """Blocks of the rows as they stand in a task; ``block`` is the slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, vectors = TaskContext.get().partitionId(), [], []
        for batch in batches:
            ids += batch.column("review_id").to_pylist()
            vectors += _vectors(batch.column("vector"))
            while len(ids) >= size:
                yield _block(number % slots, 0, ids[:size], vectors[:size])
                number, ids, vectors = number + 1, ids[size:], vectors[size:]
        if ids:
            yield _block(number % slots, 0, ids, vectors)
    return run


def _pack_queries(size: int):
    """Blocks of rows sorted by ``block``; one that is too large by chance is cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sub, ids, vectors = None, 0, [], []
        for batch in batches:
            for b, i, v in zip(*(c.to_pylist() for c in batch.columns[:2]),
                               _vectors(batch.column(2)), strict=True):
                if ids and (b != block or len(ids) >= size):
                    yield _block(block, sub, ids, vectors)
                    sub, ids, vectors = (sub + 1 if b == block else 0), [], []
                block = b
                ids.append(i)
                vectors.append(v)
        if ids:
            yield _block(block, sub, ids, vectors)
    return run


def _keys(queries: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Cosines as whole numbers; a side of NULL vectors only has no dimension."""
    if not queries.shape[1] or not corpus.shape[1]:
        return np.full((len(queries), len(corpus)), NO_DIRECTION, np.int64)
    score = queries @ corpus.T
    score *= DIGITS
    np.rint(score, out=score)
    score[np.isnan(score)] = NO_DIRECTION
    return score.astype(np.int64)


class _Best:
    """The k best corpus rows of each query of a block so far, by tiles of queries, so that a task
    holds a few matrices of a tile and a corpus block, whatever the size of the query block."""

    def __init__(self, ids: list[str], units: np.ndarray, k: int):
        self.ids, self.units, self.k = ids, units, k
        rows = [len(ids[lo:lo + TILE]) for lo in range(0, len(ids), TILE)]
        self.best = [(np.empty((n, 0), np.int64), np.empty((n, 0), object)) for n in rows]

    def add(self, ids: list[str], units: np.ndarray) -> None:
        k, names = min(self.k, len(ids)), np.array(ids, dtype=object)
        # Ids of a block ascend, so among equal scores the earlier place wins.
        place = np.arange(len(ids) - 1, -1, -1)
        for tile, held in enumerate(self.best):
            key = _keys(self.units[tile * TILE:(tile + 1) * TILE], units)
            key *= len(ids)
            key += place
            top = np.argpartition(key, len(ids) - k, axis=1)[:, len(ids) - k:]
            raw = np.take_along_axis(key, top, axis=1) // len(ids)
            score, found = (np.concatenate(p, axis=1) for p in
                            zip(held, (raw, names[top]), strict=True))
            keep = min(self.k, score.shape[1])
            row = np.repeat(np.arange(len(score)), score.shape[1])
            _, rank = np.unique(found.ravel(), return_inverse=True)
            order = np.lexsort((rank, -score.ravel(), row)).reshape(score.shape)[:, :keep]
            self.best[tile] = score.ravel()[order], found.ravel()[order]

    def batch(self) -> pa.RecordBatch:
        score, found = (np.concatenate(p) for p in zip(*self.best, strict=True))
        n = score.shape[1]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(self.ids, dtype=object), n), pa.string()),
            pa.array(found.ravel(), pa.string()), pa.array(score.ravel())], schema=BEST)


def _search(k: int):
    """Joined blocks, those of one query block and slot next to each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept = None, {}
        for batch in batches:
            for r in range(len(batch)):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                key = row["block"].as_py(), row["slot"].as_py()
                if key != at:
                    yield from (b.batch() for b in kept.values())
                    at, kept = key, {}
                sub, width = row["sub"].as_py(), row["width"].as_py()
                c_width, c_ids = row["c_width"].as_py(), row["c_ids"].as_py()
                if width and c_width and c_width != width:
                    raise ValueError(f"vectors of {width} and {c_width} dimensions")
                if sub not in kept:
                    ids = row["ids"].as_py()
                    kept[sub] = _Best(ids, np.frombuffer(row["units"].as_buffer()).reshape(
                        len(ids), width).copy(), k)
                kept[sub].add(c_ids, np.frombuffer(row["c_units"].as_buffer()).reshape(
                    len(c_ids), c_width))
        yield from (b.batch() for b in kept.values())
    return run


def top_k(corpus: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK,
          corpus_block: int = CORPUS_BLOCK) -> DataFrame:
    """The k most similar corpus rows per query row; both have ``review_id`` and ``vector``.

    Ties go to the smaller id. Vectors of another dimension are an error; a zero or NULL vector has
    no score and comes last.
    """
    spark = corpus.sparkSession
    blocks = max(1, -(-queries.count() // query_block))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(1, min(-(-wanted // blocks), -(-corpus.count() // corpus_block)))
    asked = (queries.select(F.pmod(F.xxhash64("review_id"), F.lit(blocks)).alias("block"),
                            "review_id", "vector")
             .repartition("block").sortWithinPartitions("block")
             .mapInArrow(_pack_queries(2 * query_block), BLOCK_DDL)
             .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))))
    held = corpus.select("review_id", "vector").mapInArrow(
        _pack_corpus(slots, corpus_block), BLOCK_DDL).select(
        F.col("block").alias("c_slot"), F.col("ids").alias("c_ids"), F.col("width").alias("c_width"),
        F.col("units").alias("c_units"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c_block"))
    # Sort-merge keeps the blocks of a key together and neither side in memory as a whole.
    met = asked.hint("merge").join(held, (F.col("block") == F.col("c_block"))
                                   & (F.col("slot") == F.col("c_slot")))
    some = met.select("block", "slot", "sub", "ids", "width", "units", "c_ids", "c_width",
                      "c_units").mapInArrow(_search(k), BEST_DDL)
    # At most k rows per query and slot.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("_s"), "review_id",
                                                   "score")))
    best = some.groupBy("query_id").agg(F.slice(ordered, 1, k).alias("_top"))
    return best.select("query_id", F.posexplode("_top").alias("_p", "_r")).select(
        "query_id", (F.col("_p") + 1).alias("position"), "_r.review_id",
        F.when(F.col("_r.score") > NO_DIRECTION, F.round(F.col("_r.score") / DIGITS, 6))
        .alias("score"))
