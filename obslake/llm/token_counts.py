"""Token counts as delta-maintained rollups.

The store holds one committed folder per batch with the batch's signed sums by source,
language and tokenizer version. Inserts count +1, deletes -1, and a revision is the old
count with -1 and the new one with +1; all sums are additive, so the totals are the sum
over committed batches. A batch is committed by one rename and only once: running it again
changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import words
from obslake.llm.warc_zip import open_store

GROUP = ["source", "lang", "tokenizer_version"]
MEASURES = ["docs", "tokens", "chars"]
TOTALS_SCHEMA = "source string, lang string, tokenizer_version string, docs long, tokens long, chars long"


def word_tokens(text: Column) -> Column:
    """Version ``words-v1``: runs of non-space characters."""
    return F.size(words(text)).cast("long")


def piece_tokens(text: Column) -> Column:
    """Version ``pieces-v1``: runs of ASCII letters or digits, and every other single character but space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Za-z0-9]+|[^A-Za-z0-9\\x20\\x09-\\x0D]")).cast("long")


def run_tokens(text: Column) -> Column:
    """Version ``pieces-v2``: like pieces-v1, but letters outside ASCII belong to the runs."""
    return F.regexp_count(
        F.coalesce(text, F.lit("")),
        F.lit("[A-Za-z0-9\\x{80}-\\x{10FFFF}]+|[^A-Za-z0-9\\x20\\x09-\\x0D\\x{80}-\\x{10FFFF}]"),
    ).cast("long")


TOKENIZERS = {"words-v1": word_tokens, "pieces-v1": piece_tokens, "pieces-v2": run_tokens}


def counted(docs: DataFrame, versions: list[str], text: str = "text") -> DataFrame:
    """``docs`` without its text: source, lang, chars and one ``tokens_<i>`` column a version,
    with ``digest`` (null for a null text). Null text counts 0 tokens and characters."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("chars"),
        F.sha2(F.col(text), 256).alias("digest"),
        *[TOKENIZERS[v](F.col(text)).alias(f"tokens_{i}") for i, v in enumerate(versions)],
    )


def signed(counts: DataFrame, versions: list[str], version: str, sign: int, tokens: Column | None = None) -> DataFrame:
    """Signed rows of ``counts`` (from ``counted``) for one tokenizer version."""
    tokens = F.col(f"tokens_{versions.index(version)}") if tokens is None else tokens
    return counts.select(
        "source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(sign).cast("long").alias("sign"),
        tokens.alias("tokens"), "chars",
    )


def changes(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def batch_sums(signed_rows: DataFrame) -> DataFrame:
    """A batch's additive sums by group; groups in which nothing changes are left out."""
    return (
        signed_rows.groupBy(*GROUP)
        .agg(
            F.sum("sign").alias("docs"),
            F.sum(F.col("sign") * F.col("tokens")).alias("tokens"),
            F.sum(F.col("sign") * F.col("chars")).alias("chars"),
        )
        .where("docs <> 0 OR tokens <> 0 OR chars <> 0")
    )


def commit(spark: SparkSession, store: str, batch_id: str, signed_rows: DataFrame) -> bool:
    """Adds a batch to the store; False when the batch had been committed before.

    The sums are written to a folder of their own and renamed to ``batch=<batch_id>``: a
    reader sees the whole batch or nothing, and of two writers of one batch one wins.
    Needs a store whose folder rename is atomic.
    """
    fs, root = open_store(store)
    final = f"{root}/batch={batch_id}"
    if _exists(fs, final):
        return False
    attempt = f"_attempt-{uuid.uuid4().hex}"
    batch_sums(signed_rows).coalesce(1).write.parquet(f"{store.rstrip('/')}/{attempt}")
    try:
        fs.move(f"{root}/{attempt}", final)
    except OSError:
        if not _exists(fs, final):
            raise
        return False
    return True


def _exists(fs, path: str) -> bool:
    from pyarrow.fs import FileType

    return fs.get_file_info(path).type != FileType.NotFound


def committed(store: str) -> list[str]:
    """Ids of the committed batches."""
    from pyarrow.fs import FileSelector

    fs, root = open_store(store)
    found = fs.get_file_info(FileSelector(root, allow_not_found=True))
    return sorted(x.base_name.removeprefix("batch=") for x in found if x.base_name.startswith("batch="))


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Current totals by source, language and tokenizer version, over all committed batches.

    Groups that are back at nothing are left out; null sources and languages are groups of
    their own. An empty store gives an empty table.
    """
    paths = [f"{store.rstrip('/')}/batch={b}" for b in committed(store)]
    if not paths:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    summed = spark.read.schema(TOTALS_SCHEMA).parquet(*paths).groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return summed.where("docs <> 0 OR tokens <> 0 OR chars <> 0")


def copies_removed(counts: DataFrame, versions: list[str], live: list[str]) -> DataFrame:
    """Signed rows that delete all but one document (smallest doc_id) of equal texts.

    Every document is taken out and the kept one of each text put back in: both sides are
    sums with map-side combine, so a text with millions of copies is no hot group. Null texts
    are no copies.
    """
    known = counts.where("digest IS NOT NULL")
    payload = ["source", "lang", "chars", *[f"tokens_{i}" for i in range(len(versions))]]
    # Null doc_ids come last; equal ids are told apart by the rest of the row.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *payload)
    kept = known.groupBy("digest").agg(F.min(order).alias("k")).select("k.*")
    return changes(
        *[signed(known, versions, v, -1) for v in live],
        *[signed(kept, versions, v, +1) for v in live],
    )
