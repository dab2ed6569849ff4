"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import (
    langid,
    licences,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    spelling,
    substring,
    token_counts,
    topk,
    warc_zip,
)
from obslake.llm.common import staged, table, words
from obslake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after four signed batches.

    All documents are inserted under two tokenizer versions, the second is revised to its next
    version, the copies of equal texts are deleted, and the revision is delivered once more.
    """
    versions = ["words-v1", "pieces-v1", "pieces-v2"]
    counts = staged(token_counts.counted(table(spark, sf_dir, "documents"), versions), "token-counts")
    store = scratch_path(spark, "llm-token-rollup")

    def rows(version: str, sign: int) -> DataFrame:
        return token_counts.signed(counts, versions, version, sign)

    revision = token_counts.changes(rows("pieces-v1", -1), rows("pieces-v2", +1))
    token_counts.commit(spark, store, "0-load", token_counts.changes(rows("words-v1", +1), rows("pieces-v1", +1)))
    token_counts.commit(spark, store, "1-revise-pieces", revision)
    token_counts.commit(spark, store, "2-delete-copies", token_counts.copies_removed(counts, versions, ["words-v1", "pieces-v2"]))
    token_counts.commit(spark, store, "1-revise-pieces", revision)
    return token_counts.totals(spark, store)


ORACLES["op1_token_rollup"] = """
WITH kept AS (
    SELECT source, lang, text FROM documents WHERE text IS NULL
    UNION ALL
    SELECT source, lang, text FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) AS n FROM documents WHERE text IS NOT NULL)
    WHERE n = 1),
counted AS (
    SELECT source, lang, 'words-v1' AS tokenizer_version, coalesce(length(text), 0) AS chars,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM kept
    UNION ALL
    SELECT source, lang, 'pieces-v2', coalesce(length(text), 0),
           len(regexp_extract_all(coalesce(text, ''),
               '[A-Za-z0-9\\x{80}-\\x{10FFFF}]+|[^A-Za-z0-9\\x20\\x09-\\x0D\\x{80}-\\x{10FFFF}]')) FROM kept)
SELECT source, lang, tokenizer_version, CAST(count(*) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens,
       CAST(sum(chars) AS BIGINT) AS chars
FROM counted GROUP BY ALL
"""


@register
def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 ids."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@register
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return ngram_join.components(table(spark, sf_dir, "documents")).drop("row_key", "component")


@register
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every query vector (id divisible by 50)."""
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLES["op4_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.c, x.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.c) = len(x.c) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.learn(docs.where("NOT held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model)


@register
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, repeated rows each for themselves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (
        mixing.mix(docs)
        .withColumn("taken", mixing.taken_words())
        # A row with words has its own place on its source's line. Rows without words have one row each
        # in the mix and may share a place, so as many rows come back as were counted.
        .groupBy("doc_id", "source", "size", "source_size", "target", "order_key", "line_from")
        .agg(F.sum("taken").alias("taken"), F.count("slots").alias("blocks"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_row", F.expr("explode(sequence(1L, if(size = 0, _rows, 1L)))"))
        .select("doc_id", "size", "source_size", "target", "taken", "source", "blocks")
    )


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, score and verdict of every document."""
    trusted = quality.trusted_documents(table(spark, sf_dir, "labels"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.quality_rules(docs, trusted).drop("text")
    return judged.select(*[c for c in judged.columns if c != "score"], "score")


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and the digest of the words that stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stripped = substring.without_repeats(docs)
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest of every document and the licence that its entire text is, if any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan_licences(docs, licences.known_digests(spark)).select(
        "doc_id", "canonical_digest", "licence_id"
    )


ORACLES["op9_licence_scan"] = licences.scan_sql()


@register
def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP archives, and read back from them."""
    folder = warc_zip.archive_folder(spark)
    archives = warc_zip.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc_zip.read_records(archives, folder).drop("payload", "url")
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.select(*first, *[c for c in records.columns if c not in first])


@register
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the changed runs of letters, its near words, form and root."""
    return spelling.variants(spelling.changed_word_counts(table(spark, sf_dir, "documents")))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` whose checksum of doc_id ends in 0 with their words periodic from one word on.

    With g the checksum without its last digit and n words, word i from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8) rounded down. Other texts, and those of a null
    doc_id, stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string"))
    # The split words are bound to one name, so that they are split once a text.
    bound = F.transform(F.array(words(F.col("text"))), lambda w: F.struct(w.alias("w"), F.floor(checksum / 10).alias("g")))
    begun = F.transform(bound, lambda x: F.struct(x.w, x.g, F.expr("0").alias("zero"), (x.g % F.greatest(F.size(x.w), F.lit(1))).alias("a")))

    def periodic(x):
        n = F.size(x.w).cast("long")
        period = F.floor((n - x.a) / (x.g % 8 + 3)) + 1
        return F.transform(x.w, lambda word, i: F.when(i < x.a, word).otherwise(F.get(x.w, (x.a + (i - x.a) % period).cast("int"))))

    planted = F.array_join(F.get(F.transform(begun, periodic), F.lit(0)), " ")
    return docs.withColumn("text", F.when(checksum % 10 == 0, planted).otherwise(F.col("text")))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, the longest one, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(with_planted_period(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("s"), (-r.period).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    best = found.withColumn("_best", longest)
    start, length, period = -F.col("_best.s"), F.col("_best.length"), -F.col("_best.p")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
        "n_words",
    )


@register
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by kind, with the digest of the kinds that need no checksum."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(name: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s.kind == name)).cast("long").alias(f"n_{name}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = F.filter("secrets", lambda s: s.kind.isin(*secret_scan.BASE_NAMES))
    return found.select(
        "doc_id",
        *[of(name) for name in secret_scan.BASE_NAMES],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's result over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
