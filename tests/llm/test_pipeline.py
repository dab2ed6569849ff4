"""Every pipeline stage against a brute-force version on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_operators import base_rules, brute_components, brute_substring, words


@pytest.fixture(scope="module")
def results(spark):
    """Input and output rows of every stage."""
    from obslake.llm.common import staged, table

    docs, out = table(spark, SF_SMALL, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF_SMALL), "test-stage")
        if stage is not corpus_pipeline.pack_sequences:
            assert after.columns == columns
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_registered():
    assert "pipeline" in entry.queries()
    assert [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in entry.queries())] == list(range(1, 11))


def test_quality_stage(spark, results):
    before, after = results[0]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    passed = {r.doc_id for r in before if not base_rules(r.text)[-1]}
    assert kept <= passed
    good = {d for d in passed if d in labels and labels[d].quality == 1}
    bad = {d for d in passed if d in labels and labels[d].quality == 0}
    assert len(good - kept) <= 0.01 * len(good)
    assert len(bad & kept) <= 0.2 * len(bad)


def test_quality_stage_on_more_documents(spark):
    """The same bounds on a thousand documents, and no clean one goes."""
    folder = SF_SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, folder).select("doc_id").collect()}
    passed = {r.doc_id for r in docs.collect() if r.doc_id in labels and not base_rules(r.text)[-1]}
    clean = {d for d in passed if labels[d].quality == 1 and labels[d].toxic == 0}
    bad = {d for d in passed if labels[d].quality == 0}
    assert len(clean) > 200 and clean <= kept
    assert len(bad) > 20 and len(bad & kept) <= 0.2 * len(bad)


def test_near_duplicate_stage(results):
    before, after = results[1]
    want = {d for d, _, c in brute_components([(r.doc_id, r.text) for r in before]) if d == c}
    assert {r.doc_id for r in after} == want and len(after) == len(want)


def test_passage_stage(results):
    before, after = results[2]
    removed = {d: (n, text) for (d, total, n, text) in brute_substring([(r.doc_id, r.text) for r in before]) if n < total}
    assert {r.doc_id for r in after} == set(removed)
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        n, text = removed[r.doc_id]
        assert r.text == (text if n else texts[r.doc_id])
        assert r.n_chars == len(r.text)


def test_mix_stage(results):
    before, after = results[3]
    sizes, taken = {r.doc_id: len(words(r.text)) for r in before}, Counter()
    for r in after:
        taken[r.doc_id] += len(words(r.text))
    assert all(n <= 2 * sizes[d] for d, n in taken.items())
    assert taken.total() == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)


def test_pack_stage(results):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    before, after = results[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in before:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for start in range(0, len(ids), 1024):
            want[(r.doc_id, start, len(ids), zlib.crc32(ids[start : start + 1024].tobytes()))] += 1
    assert Counter((r.doc_id, r.start, r.doc_tokens, r.ids_crc32) for r in after) == want
    filled = Counter()
    for r in after:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    # Whole remainders of some hundred documents; larger tables pad less (0.3% over 1,000 documents).
    assert 1024 * len(filled) <= 1.05 * filled.total() + 1024
