"""Text landing zones: defect-preserving export, tolerant read, ingest metadata and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESCUED = "_bronze_rescued"
METADATA = ["_bronze_ingested_at", "_bronze_source_file", "_bronze_batch_id"]

# NULL has a mark of its own, from the private use area, so that empty text stays empty.
NULL_MARK = "\ue000"

# Readers and writers trim by default, which would erase untrimmed text. Every value is quoted, a
# quote is doubled and a backslash is a letter, so text with line breaks comes back as it was.
EXACT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
         "quote": '"', "escape": '"', "lineSep": "\n", "nullValue": NULL_MARK, "emptyValue": ""}
MAX_ROWS_PER_FILE = 100_000
TOLERANT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}


def string_schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in [*columns, RESCUED])


def export(df: DataFrame, path: str, kind: str = "csv", gzip: bool = False) -> None:
    """Every column as text, damage kept, in as many files as there are partitions.

    A text that equals the mark of NULL cannot be told from it in CSV and stops the export. A CSV
    file with line breaks inside values is read by one task, so files are kept small:
    ``MAX_ROWS_PER_FILE`` rows at most.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if kind == "csv":
        text = text.select(*[F.when(F.col(c) == NULL_MARK, F.raise_error(F.lit(
            f"{c} holds the mark of NULL"))).otherwise(F.col(c)).alias(c) for c in df.columns])
    writer = text.write.mode("overwrite").option("maxRecordsPerFile", str(MAX_ROWS_PER_FILE))
    if gzip:
        writer = writer.option("compression", "gzip")
    if kind == "csv":
        writer = writer.options(header="true", quoteAll="true", **EXACT)
    writer.format(kind).save(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All strings, nothing inferred; a line that does not fit is kept in the rescue column."""
    return (spark.read.options(header="true", multiLine="true", **EXACT, **TOLERANT)
            .schema(string_schema(columns)).csv(path))


def with_metadata(df: DataFrame, batch_id: str) -> DataFrame:
    return (df.withColumn("_bronze_ingested_at", F.current_timestamp())
            .withColumn("_bronze_source_file", F.col("_metadata.file_path"))
            .withColumn("_bronze_batch_id", F.lit(batch_id)))


def shard(df: DataFrame, key: Column, n_shards: int, index: int) -> DataFrame:
    """A deterministic slice of the table by the hash of a key."""
    return df.filter(F.pmod(F.xxhash64(key), F.lit(n_shards)) == index)


def write_shard(df: DataFrame, root: str, index: int, kind: str = "json") -> str:
    path = f"{root}/shard={index:04d}"
    export(df, path, kind)
    return path


def write_shards(df: DataFrame, index: Column, root: str) -> None:
    """All shards in one pass, as JSON."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], index.alias("shard"))
    text.write.partitionBy("shard").json(root)


def stream(spark: SparkSession, path: str, columns: list[str], kind: str,
           max_files: int = 8) -> DataFrame:
    """A file stream with a frozen schema, bounded batches and nested folders.

    CSV lines that do not fit go to the rescue column. JSON drops unknown keys without a trace, so
    JSON is read as text, parsed with the frozen schema, and lines with other keys are kept.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", str(max_files)) \
        .option("recursiveFileLookup", "true")
    if kind == "csv":
        return (reader.options(header="true", enforceSchema="true", multiLine="true", **EXACT,
                               **TOLERANT)
                .schema(string_schema(columns)).format("csv").load(path))
    lines = reader.format("text").load(path)
    parsed = F.from_json("value", ", ".join(f"`{c}` string" for c in columns))
    extra = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(c) for c in columns]))
    unfit = F.col("_row").isNull() | F.coalesce(F.size(extra) > 0, F.lit(True))
    return lines.withColumn("_row", parsed).select(
        *[F.col(f"_row.{c}").alias(c) for c in columns],
        F.when(unfit, F.col("value")).alias(RESCUED))
