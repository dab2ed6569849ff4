"""Quality rules: base rules and a hashed n-gram log-likelihood ratio (built-in functions only).

The ratio compares two multinomials over hashed word n-grams (one and two words): the
trusted target (documents labelled good) and the raw corpus. A document's score is the
mean log-ratio of its n-grams; the verdict is a fixed threshold on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

#: Buckets of the hashed n-grams: the size of both multinomials, whatever the corpus.
BUCKETS = 1 << 14
#: Share of the raw distribution mixed into the target (bounds a log-ratio from below).
RAW_SHARE = 0.05
#: Pseudo-count of a bucket in both multinomials, as a multiple of the trusted n-grams a bucket has on
#: average: n-grams too rare to tell anything count for little, alike in a corpus of any size.
PRIOR_SHARE = 2.0
#: Least mean log-ratio (nats per n-gram) of a kept document.
THRESHOLD = -0.042


def with_base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the
    working column ``_hashes`` (one 64-bit hash a word). Null text counts as no text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = docs.withColumn("_words", words(F.col(text)))
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_hashes": word_hashes(),
            "_lines": lines,
        }
    ).drop("_words")
    df = df.withColumn("_windows", F.expr(_neighbours(3)))
    # Only a text with equal windows is looked at further: whole hash and position of every window;
    # sorted, equal windows are neighbours.
    df = df.withColumn(
        "_placed",
        F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN sort_array(transform(_windows, "
            "(x, i) -> struct(x AS h, cast(i AS bigint) AS p))) END"
        ),
    )
    df = df.withColumn(
        "_repeated",
        F.expr(
            "sort_array(transform(filter(_placed, (x, i) -> "
            "x.h = get(_placed, i - 1).h OR x.h = get(_placed, i + 1).h), x -> x.p))"
        ),
    )
    covered = F.expr(
        "coalesce(aggregate(transform(_repeated, (p, i) -> least(3L, coalesce(get(_repeated, i + 1) - p, 3L))), "
        "0L, (a, x) -> a + x), 0L)"
    )
    without_symbols = body
    for symbol in SYMBOLS:
        without_symbols = F.replace(without_symbols, F.lit(symbol), F.lit(""))
    df = df.withColumns(
        {
            "n_symbols": (F.length(body) - F.length(without_symbols)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered,
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_lines", "_windows", "_placed", "_repeated")


def word_hashes(words_column: str = "_words") -> Column:
    return F.transform(words_column, lambda x: F.xxhash64(x))


def _neighbours(n: int) -> str:
    """SQL: one hash for every ``n`` neighbouring words of ``_hashes``."""
    rest = ", ".join(f"get(_hashes, i + {k})" for k in range(1, n))
    return (
        f"CASE WHEN size(_hashes) >= {n} THEN slice(transform(_hashes, (x, i) -> xxhash64(x, {rest})), 1, "
        f"size(_hashes) - {n - 1}) ELSE cast(array() as array<bigint>) END"
    )


def hashed_ngrams() -> Column:
    """Hash of every word and of every pair of neighbouring words, from ``_hashes``."""
    return F.concat(F.col("_hashes"), F.expr(_neighbours(2)))


def ngram_counts(docs: DataFrame, trusted: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-gram counts over all of ``docs`` and over its trusted documents.

    ``trusted`` holds doc_id of the trusted documents (repeats count once). Counting is a
    map-side combine into at most ``buckets`` rows per task.
    """
    flag = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("_target", F.lit(1))
    return (
        docs.select("doc_id", F.col(text).alias("_text"))
        # Always by a shuffle: the trusted ids grow with the corpus, and a broadcast that small inputs
        # get would only hide what large ones cost.
        .join(flag.hint("merge"), "doc_id", "left")
        .select("_target", words(F.col("_text")).alias("_words"))
        .select("_target", word_hashes().alias("_hashes"))
        .select("_target", hashed_ngrams().alias("_ngrams"))
        # Outer: a plain explode adds a filter on the array's size, which the optimizer pushes down
        # with the array's whole expression inlined, once more for every element.
        .select("_target", F.explode_outer("_ngrams").alias("_ngram"))
        .where("_ngram IS NOT NULL")
        .groupBy(F.expr(f"cast(pmod(_ngram, {buckets}L) as int)").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_target").alias("target"))
    )


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, raw_share: float = RAW_SHARE) -> list[float]:
    """Log-ratio of each bucket, ``log((1 - s) * (target + p) / (expected + p) + s)``, where
    ``expected`` is the bucket's raw share of all trusted n-grams and ``p`` is PRIOR_SHARE times
    the trusted n-grams a bucket; 0 for a bucket that no n-gram has, and everywhere when there
    is no trusted n-gram. A corpus and the same corpus several times over have equal ratios. The
    driver gets ``buckets`` numbers at most, whatever the corpus."""
    import math

    rows = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}
    raw_total = sum(r for r, _ in rows.values())
    target_total = sum(t for _, t in rows.values())
    ratios = [0.0] * buckets
    prior = PRIOR_SHARE * target_total / buckets
    if target_total:
        for bucket, (raw, target) in rows.items():
            expected = raw * target_total / raw_total
            ratios[bucket] = math.log((1 - raw_share) * (target + prior) / (expected + prior) + raw_share)
    return ratios


def ratio_score(ratios: list[float]) -> Column:
    """Mean log-ratio of the n-grams in ``_ngrams`` (0 for a document without words)."""
    # One literal: the split and the cast are folded into an array when the query is planned.
    table = f"cast(split('{','.join(map(repr, ratios))}', ',') as array<double>)"
    summed = F.expr(f"aggregate(_ngrams, 0D, (a, x) -> a + get({table}, cast(pmod(x, {len(ratios)}L) as int)))")
    return F.when(F.size("_ngrams") > 0, summed / F.size("_ngrams")).otherwise(F.lit(0.0))


def quality_rules(
    docs: DataFrame, trusted: DataFrame, text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with the base rules' columns, ``score`` and ``kept``.

    Every row of ``docs`` comes back once, whatever its nulls: a null or empty text fails
    the base rules (under 50 words). A null doc_id is never trusted. Repeated rows get equal
    verdicts, and equal texts equal verdicts. Columns of ``docs`` with the names of results
    are replaced, those named like its steps (``_words``, ``_hashes``,
    ``_lines``, ``_windows``, ``_placed``, ``_repeated``, ``_ngrams``) dropped. Two reads of ``docs``: one counts the n-grams, one scores.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    ratios = log_ratios(ngram_counts(docs, trusted, text, buckets), buckets)
    df = with_base_rules(docs.drop(*own), text).withColumn("_ngrams", hashed_ngrams())
    df = df.withColumn("score", ratio_score(ratios)).drop("_ngrams", "_hashes")
    # The id is never negative; as an expression that the optimizer may not move, it keeps a filter on
    # the result from being pushed down with all of these expressions inlined in each other.
    unmoved = F.monotonically_increasing_id() >= 0
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold) & unmoved)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """doc_id of the documents labelled good and not toxic."""
    return labels.where("quality = 1 AND toxic = 0").select("doc_id")
