"""Token counts of documents in flat, unindexed token files.

A file is nothing but 16-bit little-endian ids; a document ends at an end-of-document id. Files are
read as blocks of fixed size, each scanned for that id with one vector comparison. What lies between
two of them in a block is a whole document. What lies before the first or after the last is a part;
an exclusive prefix sum of "this block has a separator" over the blocks of a file numbers the
documents that parts belong to, so a document over any number of blocks is stitched by one small
aggregate.

Files written here carry the document's id in front of its tokens, as ``ID_DIGITS`` reserved ids
beyond the vocabulary, so that counts can be told apart without an index. NULL and empty texts have
no tokens; a NULL doc_id is written as such and read back as NULL.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tiffin.llm.common import slices, tidy
from tiffin.session import scratch

END_OF_DOCUMENT = 50256
NO_ID = 50303
FIRST_DIGIT, BASE_BITS, ID_DIGITS = 50304, 13, 5  # five digits of 13 bits hold 64 bits
BLOCK_BYTES = 1 << 20


def _header(doc_id: int | None) -> np.ndarray:
    if doc_id is None:
        return np.full(ID_DIGITS, NO_ID, "<u2")
    value = doc_id & (2**64 - 1)
    return np.array([FIRST_DIGIT + (value >> BASE_BITS * k & (2**BASE_BITS - 1))
                     for k in range(ID_DIGITS)], "<u2")


def write_token_files(docs: DataFrame, ranks: str, pattern: str, path: str) -> None:
    """Tokenise docs (doc_id, text) with a rank file and write flat files to a new folder.

    Spark's text writer puts out each row's bytes as they are, and the separator after it.
    """
    def run(batches):
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=table,
                                    special_tokens={})
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                rows = [_header(i).tobytes()
                        + np.array(encoder.encode_ordinary(t or ""), "<u2").tobytes()
                        for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                        strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
    end = END_OF_DOCUMENT.to_bytes(2, "little").decode("iso-8859-1")
    (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "value binary")
     .select(F.col("value").cast("string"))
     .write.option("encoding", "iso-8859-1").option("lineSep", end).text(path))


def read_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, bytes) of all files in a folder."""
    if block_bytes % 2:
        raise ValueError("a block holds whole ids")
    whole = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    cuts = F.transform(F.sequence(F.lit(0), F.expr(f"(octet_length(content) - 1) div {block_bytes}")),
                       lambda i: F.substring("content", i * block_bytes + 1, F.lit(block_bytes)))
    return whole.select(F.col("path").alias("file"), F.posexplode(cuts).alias("block", "bytes"))


def scan_blocks(blocks: DataFrame, end: int = END_OF_DOCUMENT) -> DataFrame:
    """(file, block, kind, n, digits): documents inside blocks (kind 0), and the part before the
    first separator (1), after the last (2), or a block without one (3). ``n`` counts all ids."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[k].as_buffer(), "<u2")
                at = np.flatnonzero(ids == end)
                edge = np.concatenate([[-1], at, [len(ids)]])
                size = np.diff(edge) - 1
                kind = np.zeros(len(size), np.int8)
                kind[0], kind[-1] = (1, 2) if len(at) else (3, 3)
                starts = edge[:-1] + 1
                # Header ids of each piece: those of its first five that are beyond the vocabulary.
                place = starts[:, None] + np.arange(ID_DIGITS)
                near = ids[np.minimum(place, len(ids) - 1)].astype(np.int64)
                inside = np.arange(ID_DIGITS) < size[:, None]
                digit = np.where(inside & (near >= NO_ID), near - NO_ID, -1)
                number = (digit >= 0).sum(1)
                flat = digit[digit >= 0]
                bounds = np.concatenate([[0], np.cumsum(number)])
                n = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * n, pa.string()),
                     pa.array(np.full(n, batch.column(1)[k].as_py()), pa.int32()),
                     pa.array(kind), pa.array(size, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                              pa.array(flat, pa.int64()))],
                    names=["file", "block", "kind", "n", "digits"])
    return blocks.mapInArrow(
        tidy(run), "file string, block int, kind byte, n long, digits array<long>")


def stitch(pieces: DataFrame) -> DataFrame:
    """(digits, n) of every document, parts put together; both still with the header's ids."""
    whole = pieces.where("kind = 0").select("digits", "n")
    parts = pieces.where("kind <> 0")
    # Exclusive prefix sum over a file's blocks; a block has two parts at most.
    before = W.partitionBy("file").orderBy("block").rangeBetween(W.unboundedPreceding, -1)
    ended = F.coalesce(F.sum((F.col("kind") == 1).cast("long")).over(before), F.lit(0))
    numbered = parts.select("file", "block", "kind", "n", "digits",
                            (ended + (F.col("kind") == 2).cast("long")).alias("document"))
    joined = numbered.groupBy("file", "document").agg(
        F.array_sort(F.collect_list(F.when(F.size("digits") > 0, F.struct("block", "digits"))))
        .alias("heads"), F.sum("n").alias("n"))
    return whole.unionByName(joined.where("n > 0").select(
        F.flatten(F.transform("heads", lambda h: h["digits"])).alias("digits"), "n"))


def counts(pieces: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) of the documents of scanned blocks."""
    digits = stitch(pieces)
    value = F.lit(0).cast("long")
    for k in range(ID_DIGITS):
        # The last digit's upper bit falls off the 64, as it does in two's complement.
        value = value.bitwiseOR(F.shiftleft(F.get("digits", F.lit(k)) - 1, BASE_BITS * k))
    return digits.select(F.when(F.get("digits", F.lit(0)) > 0, value).alias("doc_id"),
                         (F.col("n") - ID_DIGITS).alias("n_tokens"))


def token_counts(docs: DataFrame, ranks: str, pattern: str,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the token files of docs (doc_id, text) to the shared folder, and count by scanning."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_token_files(docs, ranks, pattern, path)
    return counts(scan_blocks(read_blocks(spark, path, block_bytes)))
