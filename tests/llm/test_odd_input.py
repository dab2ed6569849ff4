"""Odd tables through the pipeline's stages and the operators: names that clash, nulls, no rows, repeated
rows, hashes that many rows have, words and texts longer than what is handled at a time."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obslake.llm import hashing, langid, licences, ngram_join, packing, quality, repeats, substring, token_counts, warc_zip
from tests.conftest import SF_SMALL
from tests.llm.test_operators import DOCS, brute_components, brute_substring, prose
from tests.llm.test_operators import rows as odd_rows

#: Names that steps of the operators and stages use for columns of their own.
NAMES = (
    "row_key", "_row_key", "_id", "_key", "id", "key", "c0", "c1", "component", "n_words", "n_removed", "kept_text",
    "windows", "kept", "score", "base_failed", "_words", "_hashed", "_ngrams", "size", "block", "slots", "_spans", "bucket",
    "ids", "length", "start", "digest", "canonical_digest", "licence_id", "lang_pred", "held_out", "payload", "refers_to",
)
STAGES = [(n, f) for n, f in corpus_pipeline.STAGES if f is not corpus_pipeline.pack_sequences]


def table_of(spark, folder, data, schema=DOCS, extra=()):
    df = spark.createDataFrame(data, schema)
    df = df.withColumns({n: F.concat(F.lit(f"{n}:"), F.col(schema.split()[0]).cast("string")) for n in extra})
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def counted(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name, stage", STAGES, ids=[n for n, _ in STAGES])
def test_stages_keep_columns_of_any_name(spark, tmp_path, name, stage):
    """A stage gives every extra column back with its values, and decides as without them."""
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    data = odd_rows() + [tuple(r) for r in given.collect()]
    plain = table_of(spark, tmp_path / "plain", data)
    named = table_of(spark, tmp_path / "named", data, extra=NAMES)
    got, want = stage(spark, named, SF_SMALL), stage(spark, plain, SF_SMALL)
    assert got.columns == named.columns and want.columns == plain.columns
    kept = got.select("doc_id", *NAMES).collect()
    assert kept
    for r in kept:
        assert all(r[n] == (None if r.doc_id is None else f"{n}:{r.doc_id}") for n in NAMES)
    if name != "source mix":  # its order is drawn from the whole row
        assert counted(got, plain.columns) == counted(want, plain.columns)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_and_null_tables(spark, tmp_path, name, stage):
    empty = table_of(spark, tmp_path / "empty", [])
    assert stage(spark, empty, SF_SMALL).count() == 0
    nulls = table_of(spark, tmp_path / "nulls", [(None, None, None, None, None)] * 3 + [(1, None, None, None, None), (2, "", None, "s", 0)])
    got = stage(spark, nulls, SF_SMALL).collect()
    if name in ("quality rules", "source mix"):  # too short; no word that the mix could take
        assert got == []
    elif name == "n-gram Jaccard join":  # repeated rows are one, even without a word
        assert Counter(r.doc_id for r in got) == {None: 1, 1: 1, 2: 1}
    elif name == "packing":  # the closing id alone
        assert Counter((r.doc_id, r.start, r.length) for r in got) == {(None, 0, 1): 3, (1, 0, 1): 1, (2, 0, 1): 1}
    else:
        assert Counter(r.doc_id for r in got) == {None: 3, 1: 1, 2: 1}


def test_operators_beside_columns_of_their_own_names(spark, tmp_path):
    plain = table_of(spark, tmp_path / "plain", odd_rows())
    named = table_of(spark, tmp_path / "named", odd_rows(), extra=NAMES)
    versions = ["words-v1", "pieces-v2"]
    for operator in (
        lambda d: token_counts.batch_sums(token_counts.signed(token_counts.counted(d, versions), versions, "words-v1", 1)),
        lambda d: packing.token_pieces(d),
        lambda d: ngram_join.components(d).drop("component"),
        lambda d: langid.identify(d, langid.learn(d.where("lang IS NOT NULL"))).select("doc_id", "lang_pred", "score"),
        lambda d: licences.scan_licences(d, licences.known_digests(spark)).select("doc_id", "canonical_digest", "licence_id"),
        lambda d: quality.quality_rules(d, spark.createDataFrame([(3,)], "doc_id long")).select("doc_id", "n_words", "kept", "score"),
    ):
        got, want = operator(named), operator(plain)
        assert counted(got, want.columns) == counted(want, want.columns)


def test_archives_of_clashing_null_and_repeated_pages(spark, tmp_path):
    schema = "page_id long, url string, html string"
    pages = [(1, "u", "a"), (2, None, "a"), (2, None, "a"), (3, "v", None), (4, "w", ""), (None, None, "b")]
    found = []
    for i, extra in enumerate([(), NAMES]):
        folder = str(tmp_path / f"archives{i}")
        archives = warc_zip.write_archives(table_of(spark, tmp_path / f"pages{i}", pages, schema, extra), folder)
        records = warc_zip.read_records(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        found.append(counted(records, records.columns))
    assert found[0] == found[1] and found[0].total() == len(pages)
    none = table_of(spark, tmp_path / "none", [], schema)
    folder = str(tmp_path / "no-archives")
    assert warc_zip.read_records(warc_zip.write_archives(none, folder), folder).count() == 0


def test_an_empty_batch_commits_and_changes_nothing(spark, tmp_path):
    counts = token_counts.counted(table_of(spark, tmp_path / "empty", []), ["words-v1"])
    store = str(tmp_path / "store")
    assert token_counts.commit(spark, store, "a", token_counts.signed(counts, ["words-v1"], "words-v1", 1))
    assert token_counts.committed(store) == ["a"] and token_counts.totals(spark, store).count() == 0


def test_hashes_of_several_rows_come_back_to_each(spark):
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 3000):
        value = rng.integers(0, max(size // 3, 1), size).astype(np.uint64)
        rows = np.arange(size) % 20_000
        distinct, own, members = repeats.once_each(value, rows)
        assert list(distinct) == sorted(set(value.tolist()))
        df = distinct.astype(np.uint32) + np.uint32(2)
        got_rows, got, got_df = repeats.each_row(distinct, own, df, members)
        assert sorted(zip(got_rows.tolist(), got.tolist(), strict=True)) == sorted(zip(rows.tolist(), value.tolist(), strict=True))
        assert (got_df == got + 2).all()
    # A value that all rows of a full block have.
    most = repeats.BLOCK_BYTES // (repeats.BLOCK_BYTES // repeats.BLOCK_ROWS) + 1
    assert repeats.SEVERAL + most < 1 << 16 and most < repeats.SEVERAL
    _, own, members = repeats.once_each(np.full(most, 9, np.uint64), np.arange(most))
    assert len(own) == 1 and len(repeats.each_row(np.full(1, 9, np.uint64), own, np.ones(1, np.uint32), members)[0]) == most


def test_a_passage_that_every_document_has(spark, tmp_path):
    """Blocks full of documents with one passage, many of them copies: counts and links stay whole."""
    rng = random.Random(11)
    passage, texts = prose(rng, 30), []
    for i in range(150):
        texts.append(f"{prose(rng, 25)} {passage}" if i % 3 else f"{passage} tail{i % 2}")
    pairs = list(enumerate(texts))
    docs = table_of(spark, tmp_path / "shared", pairs, "doc_id long, text string").coalesce(1)
    got = ngram_join.components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(pairs)
    got = substring.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substring(pairs)


def test_word_hashes_do_not_depend_on_stretches(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abé") for _ in range(rng.choice((1, 3, 9, 70, 400)))) for _ in range(300))
    data = np.frombuffer(text.encode(), np.uint8)
    start, end, _ = hashing.word_spans(data, np.array([0, len(data)]))
    whole = hashing.word_hashes(data, start, end)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(hashing, "STRETCH_BYTES", size)
        assert (hashing.word_hashes(data, start, end) == whole).all()
    assert len(set(whole.tolist())) == len(set(text.split()))


def test_texts_of_many_stretches(spark, tmp_path):
    """Texts of megabytes, one a single word, keep their copies and repeated windows."""
    rng = random.Random(8)
    long = prose(rng, 400_000, 10**6)
    passage = " ".join(long.split()[1000:1040])
    pairs = [(1, "x" * 3_000_000), (2, "x" * 3_000_000), (3, "x" * 2_999_999 + "y"), (4, long), (5, long + " end"), (6, passage)]
    docs = table_of(spark, tmp_path / "long", pairs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}
    removed = {r.doc_id: (r.n_words, r.n_removed) for r in substring.without_repeats(docs).collect()}
    assert removed == {1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (400_000, 0), 5: (400_001, 400_000), 6: (40, 40)}
