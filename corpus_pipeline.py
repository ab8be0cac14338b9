"""From raw documents to token ids: each stage is one operator, its rows are stored and read again by the next.

All stages take any nulls: a null text counts as empty, a null source is a source of its own, rows with a null doc_id are
documents like others. Repeated rows count one by one until near duplicates keep one of them. An empty table passes
through all stages empty. Columns other than those of `documents` are kept as they are up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.bpe import transcode
from hazeline.llm.jaccard import one_of_each_group
from hazeline.llm.language import UNKNOWN, identify, learn
from hazeline.llm.mixing import mixed
from hazeline.llm.passages import passages
from hazeline.llm.q_bpe import VOCABULARY
from hazeline.llm.substrings import whole_characters, without_repeats
from hazeline.session import written

#: A text nearer to a profile than this has a language; below, it shares next to no n-gram with any.
LEAST_SCORE = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter (null and empty texts too) or come near no language; a missing language is
    filled in."""
    profiles = written(learn(docs), "lang-profiles")
    rows = identify(docs, profiles).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return rows.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of similar ones; a null id is the last choice."""
    return one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of more than 50 words, or of 400 bytes, that stand anywhere else; a document that consists of
    such keeps an empty text."""
    rows = without_repeats(docs, also=passages(docs.select("text")))
    text = F.when(F.size("spans") > 0, whole_characters("kept")).otherwise(F.col("text"))
    return rows.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice. An empty text goes the way of
    its point and adds no words."""
    return mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, n_decoded): ids as little-endian 32-bit integers, and the characters they decode to."""
    rows = transcode(docs.select(F.struct("doc_id", "source").alias("row"), "text"), VOCABULARY, key="row")
    return rows.select(
        "row.doc_id", "row.source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.char_length("decoded").cast("long").alias("n_decoded"))


STAGES = [
    ("language", known_language),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: None: profiles, suffix order and byte pairs are beyond SQL. The tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
