"""Training-data pipeline: toxicity, near duplicates, decontamination, personal data, token ids.

Each stage gets what its predecessor kept and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage as Parquet in the shared folder and reads it
again, so a lost executor repeats one stage at most. Columns beyond doc_id and text are carried
along; where ``n_chars`` is there, masking sets it anew. NULL and empty texts, which are like
nothing, pass all filters; an empty table gives an empty one; columns named like those of an operator
are kept as they are. A very long text is one row of a task.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import bpe, fmindex, jaccard, pii, toxicity
from tiffin.llm.common import table
from tiffin.operators.slices import contiguous_ids
from tiffin.session import materialise

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MAX_TOXICITY = 0.5       # documents that score this or more go
SHINGLE_WORDS, SIMILAR, OF = 5, 80, 100
PHRASE_WORDS = 13


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit; the classifier learns from ``labels``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.classify(docs, docs.select("doc_id", "text"), labels, out="_toxicity")
    return scored.where(F.col("_toxicity") < MAX_TOXICITY).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group.

    Only the ids that go are joined with the texts. Rows without a doc_id are in no group and stay.
    Where rows share a doc_id, each of its texts is judged by itself.
    """
    found = materialise(jaccard.join(docs.select("doc_id", "text"), SHINGLE_WORDS, SIMILAR, OF),
                        "near-duplicates")
    repeated = (found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1"))
    if not repeated.isEmpty():
        return _drop_by_text(docs)
    gone = materialise(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    # A bitmap clears most documents without a join; only texts it does not clear are shuffled.
    asked = jaccard.maybe_seen(docs, gone, "_maybe_gone")
    return asked.where("not _maybe_gone").select(*docs.columns).unionByName(
        asked.where("_maybe_gone").join(gone, "doc_id", "left_anti").select(*docs.columns))


def _drop_by_text(docs: DataFrame) -> DataFrame:
    """The same where doc_ids repeat: a document is a doc_id with a text, in order of both. Of whole
    rows repeated one stays, unless the text has no words, which makes it like no other."""
    rows = materialise(docs.where("doc_id is not null").withColumn(
        "_digest", F.sha2(F.coalesce("text", F.lit("")), 256)), "rows")
    known = contiguous_ids(rows.select("doc_id", "_digest").distinct(), ["doc_id", "_digest"],
                           "_number")
    known = materialise(known.select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_d"),
                                     "_number"), "numbers")
    texts = rows.groupBy("doc_id", "_digest").agg(F.min("text").alias("text")).join(
        known, (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_d")))
    found = materialise(jaccard.join(texts.select(F.col("_number").alias("doc_id"), "text"),
                                     SHINGLE_WORDS, SIMILAR, OF), "near-duplicates-by-text")
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept"),
                                                        (F.col("n_shingles") > 0).alias("_words"))
    kept = rows.join(known, (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_d"))) \
        .join(stays, F.col("_number") == F.col("_kept"))
    row = F.struct(*docs.columns)
    one = (kept.where("_words").groupBy("_number").agg(F.min_by(row, F.xxhash64(row)).alias("row"))
           .select("row.*"))
    return docs.where("doc_id is null").unionByName(one).unionByName(
        kept.where("not _words").select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark passages."""
    benchmark = table(spark, sf_dir, "benchmark")
    marked = fmindex.decontaminate(docs, benchmark, PHRASE_WORDS)
    hit = fmindex.hit_words()
    return marked.where((hit == 0) | (20 * hit < F.col("n_words"))).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    masked = pii.mask(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the proof that they decode to it."""
    coded = bpe.encode(docs, VOCABULARY, decoded="decoded")
    return coded.select(*[c for c in docs.columns if c not in ("text", "ids")], "ids",
                        F.size("ids").cast("long").alias("n_tokens"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("bpe", to_token_ids),
]

# The classifier and the random field are fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
