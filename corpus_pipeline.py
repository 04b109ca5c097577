"""Documents to token ids in five stages; each works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe_codec, language_id, line_dedup, mixing, ngram_join
from geoloom.llm.queries import vocabulary
from geoloom.storage import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least calibrated probability of the predicted language.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; null texts, texts without letters and doubtful ones go."""
    model = language_id.train(docs.where(language_id.remainder("doc_id", 3) != 1))
    found = language_id.identify(docs.select(COLUMNS), model)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut; a document of which no word is left goes, others keep their columns."""
    cut = line_dedup.dedup_lines(docs.select(COLUMNS))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(mixing.WORD)
    return cut.where(left).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each class stays, by id and then by a hash of its text; null ids come last.

    Rows equal in id and text are copies: one of them stays, with the least of their other columns. Different texts of
    one id are different documents. A text without words has no class but itself.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("mark")).alias("key")
    keyed = docs.select(key, *COLUMNS)
    classes = ngram_join.ngram_jaccard_classes(keyed, id_col="key")
    first = classes.where("key = component_id").select("key").distinct()
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")
    return keyed.join(first, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"), rest).select("key.doc_id", "text", "rest.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes its words, to the nearest whole number (a half upwards).

    The mix takes some documents in part, four of a shard at most, and these alone are rounded.
    """
    mixed = mixing.mix(docs, keep=COLUMNS)
    times = F.when(F.col("taken") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return mixed.where(times > 0).withColumn("time", F.explode(F.sequence(F.lit(1), times))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to; null texts count as empty."""
    return bpe_codec.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", join_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: Language ID is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
