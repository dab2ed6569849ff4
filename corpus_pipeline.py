"""Corpus pipeline: quality rules, near duplicates, repeated passages, source mix, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor
kept; ``run`` writes each result as Parquet in the shared folder and reads it back as the
next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import mixing, ngram_join, packing, quality, substring
from obslake.llm.common import staged, table

#: Columns of documents that the stages read by name.
READ = ("doc_id", "text", "source", "lang", "n_chars")


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that a stage reads by name as they are and all others under numbers, so that
    a column of any name comes through a stage; ``toDF`` with the old names puts them back."""
    return docs.toDF(*[c if c in READ else f"other {i}" for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood threshold."""
    trusted = quality.trusted_documents(table(spark, sf_dir, "labels"))
    plain = apart(docs)
    return quality.quality_rules(plain, trusted).where("kept").select(*[f"`{c}`" for c in plain.columns]).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of each group of documents linked by shingle similarity."""
    return ngram_join.representatives(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier document has; a document that
    loses all its words goes, one that loses none keeps its text as it is."""
    plain = apart(docs)
    stripped = substring.without_repeats(plain)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kept = stripped.where("n_words = 0 OR n_removed < n_words").withColumn("text", text)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*[f"`{c}`" for c in plain.columns]).toDF(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: a row for each run of words that it takes
    once, and one more for each run that it takes twice. A document without a word has none."""
    return mixing.mixed_documents(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 ids."""
    pieces = packing.token_pieces(docs)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("source mix", source_mix),
    ("packing", pack_sequences),
]

#: No SQL: the stages hash n-grams, search indexes and pack token ids. Tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
