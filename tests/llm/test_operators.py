"""The training-data operators against brute force on a small table of awkward rows."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import (
    langid,
    licences,
    mixing,
    ngram_join,
    packing,
    quality,
    queries,
    substring,
    token_counts,
    topk,
    warc_zip,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows():
    """Copies, near copies, shared passages, repeats, nulls, empty and very long texts."""
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(1, 160)) for _ in range(24)]
    passage = prose(rng, 60)
    texts = list(base)
    texts += [base[3]] * 4 + [base[5].upper()]
    near = prose(rng, 120)
    for _ in range(12):
        words = near.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 50)} {passage}\n{prose(rng, 40)}" for _ in range(6)]
    texts += ["", " \t\n", None, None, "one", "a b c", "A B C", "é ü ñ", "***", "l1\nl1\nl1\n l1 ", prose(rng, 6000, 9)]
    texts += ["w1 w2 w3 " * 40, "\x0bword\x0c" * 30, "x" * 30000]
    out = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", "é", None][i % 4], len(t) if t else 0) for i, t in enumerate(texts)]
    out += [out[2], out[2]]  # repeated rows
    out += [(None, base[4], "en", "s1", 1), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows(), DOCS).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "empty")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    w = words(text)
    grams = list(zip(w, w[1:], w[2:]))
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_rules(spark, docs, empty):
    trusted = spark.createDataFrame([(0,), (1,), (6,), (6,), (None,)], "doc_id long")
    got = quality.quality_rules(docs.withColumn("score", F.lit("clash")), trusted, buckets=64, threshold=-0.01).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows())
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rules(r.text)
        assert r.kept == (not r.base_failed and r.score >= -0.01)
    # The ratio from its definition, over the same hashed n-grams.
    grams = docs.select("doc_id", quality.words(F.col("text")).alias("_words")).select("doc_id", quality.word_hashes().alias("_hashes"))
    grams = grams.select("doc_id", quality.hashed_ngrams().alias("g")).collect()
    raw, target = Counter(), Counter()
    for r in grams:
        buckets = [x % 64 for x in r.g]
        raw.update(buckets)
        if r.doc_id in (0, 1, 6):
            target.update(buckets)
    share, prior = quality.RAW_SHARE, quality.PRIOR_SHARE * target.total() / 64
    expected = {b: n * target.total() / raw.total() for b, n in raw.items()}
    ratio = {b: math.log((1 - share) * (target[b] + prior) / (e + prior) + share) for b, e in expected.items()}
    scores = {r.doc_id: (sum(ratio[x % 64] for x in r.g) / len(r.g) if r.g else 0.0) for r in grams}
    for r in got:
        if r.doc_id is not None:
            assert r.score == pytest.approx(scores[r.doc_id], abs=1e-9)
    assert quality.quality_rules(empty, trusted).count() == 0
    assert {r.score for r in quality.quality_rules(docs, trusted.limit(0)).collect()} == {0.0}


def test_quality_ratios_do_not_depend_on_the_size_of_the_corpus(spark, docs):
    """Ten times every document (under other ids, trusted alike): the same ratios, so the same verdicts."""
    trusted = spark.createDataFrame([(0,), (1,), (6,)], "doc_id long")
    times = spark.range(10).withColumnRenamed("id", "k")
    more = docs.where("doc_id IS NOT NULL").join(times).withColumn("doc_id", F.expr("doc_id * 10 + k"))
    more_trusted = trusted.join(times).select(F.expr("doc_id * 10 + k").alias("doc_id"))
    once = quality.log_ratios(quality.ngram_counts(docs.where("doc_id IS NOT NULL"), trusted, buckets=256), 256)
    assert any(once) and once == pytest.approx(quality.log_ratios(quality.ngram_counts(more, more_trusted, buckets=256), 256))


def test_repeated_words_compare_whole_hashes(spark, monkeypatch):
    """Windows whose hashes differ in their upper bits only are different windows."""
    neighbours = quality._neighbours
    monkeypatch.setattr(quality, "_neighbours", lambda n: f"transform({neighbours(n)}, x -> shiftleft(x, 40))")
    text = " ".join([*(f"v{i}" for i in range(1000)), "v1 v2 v3"])
    got = quality.with_base_rules(spark.createDataFrame([(text,)], "text string")).first()
    assert got.n_repeat_words == base_rules(text)[4] == 6


def test_quality_filter_is_not_pushed_into_the_arrays(spark, docs):
    trusted = spark.createDataFrame([(0,)], "doc_id long")
    plan = quality.quality_rules(docs, trusted).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("monotonically_increasing_id")


def brute_components(pairs):
    sets = []
    for doc_id, text in pairs:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(pairs[i][0])
    least = {k: min([x for x in v if x is not None], default=None) for k, v in groups.items()}
    return Counter((pairs[i][0], len(sets[i]), least[find(i)] if len(groups[find(i)]) > 1 else pairs[i][0]) for i in range(len(sets)))


def test_ngram_join(docs, empty):
    got = ngram_join.components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components([r[:2] for r in rows()])
    assert ngram_join.components(empty).count() == 0
    stay = ngram_join.representatives(docs).collect()
    component = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert {r.doc_id for r in stay if r.doc_id is not None} == {d for d, c in component.items() if d == c}
    assert len({(r.doc_id, r.text) for r in stay}) == len(stay)


def test_ngram_join_links_through_no_common_hub(spark, tmp_path):
    """A chain: each text is close to the next, the ends share little."""
    text = [f"t{i}" for i in range(100)]
    chain = []
    for step in range(12):
        chain.append((100 - step, " ".join(text)))
        for k in range(2):
            text[(step * 8 + k) % 100] = f"n{step}_{k}"
    path = str(tmp_path / "chain")
    spark.createDataFrame(chain, "doc_id long, text string").write.parquet(path)
    got = ngram_join.components(spark.read.parquet(path)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(chain)


def test_ngram_join_of_copies_around_the_bound(spark, tmp_path):
    """Copies of one text that is not there itself, with one to six words changed: some pairs link,
    most do not, and all share most columns."""
    rng = random.Random(7)
    pairs = []
    for k in range(120):
        text = [f"w{i}" for i in range(rng.choice((90, 100, 110)))]
        for _ in range(k % 6 + 1):
            text[rng.randrange(len(text))] = rng.choice(("x", "y", f"own{k}"))
        pairs.append((k, " ".join(text)))
    path = str(tmp_path / "copies")
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(path)
    got = ngram_join.components(spark.read.parquet(path)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(pairs)
    assert 1 < len({r.component_id for r in got}) < len(pairs)


def brute_substring(pairs):
    rank = lambda d: math.inf if d is None else d
    first = {}
    for d, t in pairs:
        w = words(t)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, math.inf), rank(d))
    out = Counter()
    for d, t in pairs:
        w, gone = words(t), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < rank(d):
                gone.update(range(i, i + 13))
        out[(d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


def test_substring(docs, empty):
    got = substring.without_repeats(docs.withColumn("n_words", F.lit("clash"))).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substring([r[:2] for r in rows()])
    assert substring.without_repeats(empty).count() == 0


@pytest.mark.parametrize("most", [0, 1])
def test_substring_with_crowded_anchors(docs, monkeypatch, most):
    monkeypatch.setattr(substring, "HOT_SEGMENTS", most)
    got = substring.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substring([r[:2] for r in rows()])


def test_fm_index_counts_every_pattern():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 30, 40)
    symbols = rng.integers(0, 5, lengths.sum())
    index = substring.FmIndex(symbols, lengths)
    pieces = np.split(symbols, np.cumsum(lengths)[:-1])
    starts = np.concatenate([np.arange(a, a + max(0, n - 3)) for a, n in zip(np.cumsum(lengths) - lengths, lengths)])
    low, high = index.window_ranges(symbols, starts, 4)
    count = Counter(tuple(p[i : i + 4]) for p in pieces for i in range(len(p) - 3))
    for s, a, b in zip(starts, low, high):
        assert b - a == count[tuple(symbols[s : s + 4])]


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.packed_documents(docs).collect()
    want = Counter()
    for doc_id, text, *_ in rows():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for start in range(0, len(ids), 1024):
            want[(doc_id, start, len(ids), ids[start : start + 1024].tobytes())] += 1
    assert Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.packed_documents(empty).count() == 0


def test_packing_of_added_tokens_and_of_long_runs(spark, tmp_path):
    """Texts that the rank encoder spells out or refuses get the ids of ``tokenizers``, with and without a rank file."""
    import shutil

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    assert tokenizer.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    texts = ["a<|endoftext|>b", " <|endoftext|> \n<|endoftext|><|endoftext|>", "<|endoftext|", "a" + " " * 1_000_000 + "b", "\n" * 1_000_000]
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    alone = str(tmp_path / "alone.json")
    shutil.copy(path, alone)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for tokenizer_path, chosen in ((None, df), (alone, df.where("doc_id < 3"))):
        got = {}
        for r in sorted(packing.token_pieces(chosen, tokenizer_path).collect(), key=lambda r: (r.doc_id, r.start)):
            assert r.doc_tokens == len(want[r.doc_id])
            got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
        assert got == {i: want[i] for i in got} and len(got) == chosen.count()


def sequences_of(plan, histogram):
    used = np.zeros_like(histogram)
    for lengths, repeats in plan:
        assert sum(n * k for n, k in lengths.items()) <= 1024
        for n, k in lengths.items():
            used[n] += k * repeats
    assert (used == histogram).all()
    return sum(r for _, r in plan)


def test_packing_plan_uses_up_the_histogram_with_little_padding():
    histogram = np.bincount(np.random.default_rng(5).integers(1, 1025, 20_000), minlength=1025)
    tokens = int((histogram * np.arange(1025)).sum())
    assert sequences_of(packing.packing_plan(histogram), histogram) * 1024 < 1.02 * tokens


def test_packing_plan_of_a_length_that_a_third_of_all_pieces_have():
    """10,000 more pieces of 300 than there are partners for: three of them fill 900 of 1024, and
    whole pieces cannot do better. All are placed, in under a tenth of padding."""
    histogram = np.bincount(np.random.default_rng(5).integers(1, 1025, 20_000), minlength=1025)
    histogram[300] += 10_000
    tokens = int((histogram * np.arange(1025)).sum())
    assert sequences_of(packing.packing_plan(histogram), histogram) * 1024 < 1.1 * tokens


def test_mixing(docs, empty):
    got = mixing.mix(docs).withColumn("taken", mixing.taken_words()).collect()
    again = mixing.mix(docs.repartition(5)).withColumn("taken", mixing.taken_words()).collect()
    key = lambda r: (r.doc_id, r.text, r.block, r.block_from, r.block_to, tuple(r.slots or ()))
    assert Counter(map(key, got)) == Counter(map(key, again))
    sizes, taken, target = Counter(), Counter(), {}
    for _, text, _, source, _ in rows():
        sizes[source] += len(words(text))
    per_row = Counter()
    for r in got:
        taken[r.source] += r.taken
        per_row[(r.doc_id, r.text, r.source)] += r.taken
        target[r.source] = r.target
        assert r.source_size == sizes[r.source]
    copies = Counter((d, t, s) for d, t, _, s, _ in rows())
    for (d, t, s), n in per_row.items():
        assert n <= 2 * len(words(t)) * copies[(d, t, s)]
    assert sum(target.values()) == pytest.approx(1.5 * sizes.total())
    for source, want in target.items():
        assert want <= 2 * sizes[source] + 1e-9
        assert abs(taken[source] - want) <= 0.02 * want + 16
    mixed = mixing.mixed_documents(docs).collect()
    assert sum(len(words(r.text)) for r in mixed) == taken.total()
    assert all(r.n_chars == len(r.text) for r in mixed)
    assert mixing.mix(empty).count() == 0


def brute_mix(got):
    """Words that each row of the mix gets, the schedule played slot by slot over whole lines of words.

    ``got`` gives only the shuffled order of every source's documents."""
    lines, needs = {}, {}
    for r in got:
        lines.setdefault(r.source, {})[(r.line_from, r.size, r.order_key, r.doc_id, r.text)] = r.target
    order = sorted((s for s in lines if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in lines)
    line, blocks = {}, {}
    for s in order:
        line[s] = [row for row in sorted(lines[s], key=lambda r: r[:2]) for _ in range(row[1])]
        words_of = len(line[s])
        blocks[s] = min(words_of, max(-(-words_of // mixing.BLOCK_WORDS), mixing.LEAST_BLOCKS))
        needs[s] = next(iter(lines[s].values())) * blocks[s] / words_of if words_of else 0.0
    total, taken, used = sum(needs.values()), Counter(), Counter()
    for slot in range(round(total)):
        # The golden ratio times 2**64, as the fraction's integer.
        point, edge = ((slot + 1) * 11400714819323198485 % 2**64) / 2.0**64, 0.0
        for s in order:
            edge += needs[s]
            if point < edge / total or s == order[-1]:
                break
        k, used[s] = used[s], used[s] + 1
        if blocks[s] and k < 2 * blocks[s]:
            b, n = k % blocks[s], len(line[s])
            taken.update(line[s][b * n // blocks[s] : (b + 1) * n // blocks[s]])
    return taken


def test_mix_is_the_schedule_played_slot_by_slot(docs):
    got = mixing.mix(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).withColumn("taken", mixing.taken_words()).collect()
    have = Counter()
    for r in got:
        have[(r.line_from, r.size, r.order_key, r.doc_id, r.text)] += r.taken
    want = brute_mix(got)
    assert +have == want and want.total() > 0


def test_source_mix_query_keeps_repeated_rows(spark, tmp_path):
    """Wholly repeated rows, with and without words, come back one by one, none above twice its size."""
    table = [*rows(), *[rows()[0]] * 3, *[(900, "", "en", "s1", 0)] * 3, *[(901, None, None, None, None)] * 2]
    spark.createDataFrame(table, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op6_source_mix"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((d, s, len(words(t))) for d, t, _, s, _ in table)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    mixed = mixing.mix(spark.createDataFrame(table, DOCS).select("doc_id", "text", "source"))
    assert sum(r.taken for r in got) == mixed.agg(F.sum(mixing.taken_words())).first()[0]


def test_targets_are_shared_again():
    assert mixing.source_targets([("a", 100), ("b", 10), (None, 1000)]) == pytest.approx({"a": 200.0, "b": 20.0, None: 1445.0})
    assert mixing.source_targets([("a", 0)]) == {"a": 0.0}


def test_schedule_stays_close_to_the_weights(spark):
    needs = [70_000.0, 20_000.0, 10_000.0]
    slots = mixing.slot_counts(spark, needs).toPandas().sort_values("slot")
    assert list(slots["slot"]) == list(range(100_000))
    for no, need in enumerate(needs):
        own = slots[slots.source_no == no]
        assert list(own["rank"]) == list(range(len(own)))
        running = (slots.source_no == no).cumsum().to_numpy()
        assert np.abs(running - need / 1e5 * np.arange(1, 100_001)).max() < 12


def test_top_k(spark):
    rng = np.random.default_rng(11)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    vectors += [(i, vectors[7][1]) for i in range(300, 330)]  # ties
    vectors += [(400, None), (401, [1.0] * 7 + [None]), (402, [1.0] * 7 + [float("nan")]), (403, [float("inf")] * 8)]
    vectors += [(None, [1.0] * 8), (450, [0.5] * 3), (500, [-0.25] * 3), (550, [])]
    df = topk.quantised(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    table = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q, v in table.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in table.items() if i != q and len(x) == len(v))
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(scored[:5], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_repeated_query_ids(spark):
    """Repeated query rows are one query; rows of one id with other components have ranks of their own."""
    rng = np.random.default_rng(4)
    vectors = [(i, [int(x) for x in rng.integers(-50, 50, 6)]) for i in range(1, 60)]
    asked = [(100, vectors[3][1])] * 3 + [(200, vectors[5][1]), (200, vectors[9][1])]
    schema = "vec_id long, components array<bigint>"
    df = spark.createDataFrame(vectors, schema)
    got = topk.top_k(df, spark.createDataFrame(asked, schema).repartition(3), 5).collect()
    want = Counter()
    for q, v in {(q, tuple(v)) for q, v in asked}:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vectors)
        want.update((q, n, i, -s) for n, (s, i) in enumerate(scored[:5], 1))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_top_k_stops_early_with_the_exact_result():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-8, 8, (4000, 16))
    matrix[:20] *= 20
    index = topk.ImpactIndex(np.arange(4000), matrix)
    for q in (0, 5, 100):
        scores = matrix @ matrix[q]
        order = [i for i in np.lexsort((np.arange(4000), -scores)) if i != q][:5]
        assert index.search(matrix[q], q, 5) == [(int(scores[i]), int(i)) for i in order]


def test_language_id(spark, empty):
    alphabets = {"en": ["the", "and", "ing", "ion"], "de": ["sch", "und", "ung", "ver"], "fr": ["eau", "ère", "oi", "ç"]}
    rng = random.Random(1)
    table = [
        (i, " ".join("".join(rng.choices(alphabets[lang], k=3)) for _ in range(30)), lang)
        for i in range(300)
        for lang in [list(alphabets)[i % 3]]
    ]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 ...", "de"), (1003, "ç", None), (None, "schung", "de"), (1005, "漢字", None)]
    docs = spark.createDataFrame([*table, *odd], "doc_id long, text string, lang string").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.learn(docs.where("NOT held_out"))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for doc_id, _, lang in table:
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert got[doc_id].lang_pred == lang and 0 < got[doc_id].score <= 1
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003].lang_pred in alphabets and got[1005].lang_pred in alphabets and got[1005].score == 0
    assert not got[None].held_out and got[None].lang_pred == "de"
    blank = langid.learn(empty)
    assert {r.lang_pred for r in langid.identify(docs.select("doc_id", "text"), blank).collect()} == {"und"}


def brute_grams(text):
    """The four-letter windows of a text's lower-cased words, from their definition."""
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")
    line = "  " + " ".join(r for r in runs if r) + " "
    return [line[i : i + 4] for i in range(len(line) - 3)] if line.strip() else []


def brute_languages(table):
    """doc_id to (held_out, language, score, sums) with exact sets instead of the filter's planes."""
    known = {}
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1 for d, _, _ in table}
    for d, text, lang in table:
        if lang is not None and not held[d]:
            known.setdefault(lang, Counter()).update(brute_grams(text))
    planes = {
        lang: [{g for g, n in counts.items() if n >= share * counts.total()} for share in langid.SHARES]
        for lang, counts in sorted(known.items())
    }
    out = {}
    for d, text, _ in table:
        grams = brute_grams(text)
        sums = {lang: sum(g in plane for plane in sets for g in grams) / 3 for lang, sets in planes.items()}
        best = max(sums, key=sums.get)
        out[d] = (held[d], best, sums[best] / len(grams), sums) if grams else (held[d], "und", 0.0, sums)
    return out


def test_op5_against_exact_sets_on_given_documents(spark):
    from tests.conftest import SF_SMALL

    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    want = brute_languages([tuple(r) for r in given])
    assert len(langid.SHARES) == 3 and langid.SHARES[0] == 0
    got = queries.op5_language_id(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        held, lang, score, counts = want[r.doc_id]
        assert r.held_out == held and r.score == pytest.approx(score, abs=1e-3)
        assert r.lang_pred == lang or counts[r.lang_pred] == pytest.approx(counts[lang])


def test_every_ngram_is_in_the_filter(spark):
    """One rare n-gram among a hundred thousand others: its language is returned for it."""
    docs = spark.createDataFrame([("en", "alpha " * 100_000 + "zyxwv"), ("de", "beta gamma"), ("de", None)], "lang string, text string")
    model = langid.learn(docs)
    _, hashes, _ = langid.gram_hashes(["alpha zyxwv"])
    assert (model.languages_of(hashes)[:, 0] & (1 << model.languages.index("en"))).all()


def test_repeated_rows_and_more_than_64_languages(spark):
    docs = spark.createDataFrame([(f"l{i:03}", f"{chr(0x4E00 + i) * 6} common") for i in range(70)], "lang string, text string")
    model = langid.learn(docs.union(docs), slots=1 << 16)
    names, score = model.identify([chr(0x4E00 + i) * 6 for i in range(70)])
    assert names == [f"l{i:03}" for i in range(70)] and (score > 0.6).all()
    twice = docs.select(F.lit(1).alias("doc_id"), "text", F.lit("x").alias("score"))
    found = langid.identify(twice.union(twice), model).collect()
    assert Counter(found) == Counter({r: 2 for r in set(found)}) and len(found) == 140


@pytest.mark.parametrize("most", [1, 2, 3, 7, 64])
def test_long_texts_come_in_stretches(most):
    rng = random.Random(most)
    for text in ["", " ", "a", "é ", "  ab", "one two,three..  four", "".join(rng.choices("abΣİ .,1", k=300))]:
        _, want, letter = langid.gram_hashes([text])
        parts = list(langid.long_gram_hashes(text, most))
        assert any(has for _, has in parts) == letter[0]
        if letter[0]:
            assert np.concatenate([h for h, _ in parts]).tolist() == want.tolist()
    texts = ["short one", "x" * 100 + " ende", ""]
    rows, hashes, has = (np.concatenate(x) for x in zip(*[(r, h, np.flatnonzero(x)) for r, h, x in langid._parts(texts, most)], strict=True))
    whole_rows, whole, whole_has = langid.gram_hashes(texts)
    keep = np.isin(rows, np.flatnonzero(whole_has))
    kept = np.isin(whole_rows, np.flatnonzero(whole_has))
    assert Counter(zip(rows[keep], hashes[keep])) == Counter(zip(whole_rows[kept], whole[kept]))
    assert set(has) == set(np.flatnonzero(whole_has))


def test_bloom_filter_has_no_false_negative(spark):
    docs = spark.createDataFrame([("en", "alpha beta"), ("de", "alpha gamma")], "lang string, text string")
    model = langid.learn(docs)
    _, hashes, _ = langid.gram_hashes(["alpha"])
    both = (1 << model.languages.index("en")) | (1 << model.languages.index("de"))
    assert all(int(m) & both == both for m in model.languages_of(hashes)[:, 0])


def test_token_rollup(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    versions = ["words-v1", "pieces-v1"]
    counts = token_counts.counted(docs, versions)
    assert token_counts.totals(spark, store).count() == 0
    load = token_counts.changes(*[token_counts.signed(counts, versions, v, 1) for v in versions])
    assert token_counts.commit(spark, store, "a", load)
    before = {(r.source, r.lang, r.tokenizer_version): (r.docs, r.tokens) for r in token_counts.totals(spark, store).collect()}
    want = Counter()
    for _, text, lang, source, _ in rows():
        want[(source, lang)] += len(words(text))
    assert {k[:2]: v[1] for k, v in before.items() if k[2] == "words-v1"} == dict(want)
    assert not token_counts.commit(spark, store, "a", load)  # delivered again: no change
    assert token_counts.commit(spark, store, "b", token_counts.copies_removed(counts, versions, versions))
    kept = {}
    for d, t, lang, source, _ in sorted(rows(), key=lambda r: (r[0] is None, r[0])):
        kept.setdefault(t if t is not None else object(), (source, lang, t))
    want = Counter()
    for source, lang, t in kept.values():
        want[(source, lang)] += len(words(t))
    after = token_counts.totals(spark, store).where("tokenizer_version = 'words-v1'").collect()
    assert {(r.source, r.lang): r.tokens for r in after} == {k: v for k, v in want.items()}
    assert sum(r.docs for r in after) == len(kept)
    assert token_counts.commit(spark, store, "c", token_counts.signed(counts, versions, "pieces-v1", -1))
    assert token_counts.committed(store) == ["a", "b", "c"]


def test_licences(spark, docs, empty):
    known = licences.known_digests(spark)
    texts = [
        (1, "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + licences.MIT.replace("sublicense", "sublicence").upper()),
        (2, "  " + licences.ISC.replace(" ", "  \n") + "!!"),
        (3, licences.MIT + " and more"),
        (4, None),
        (5, ""),
        (6, "Licence licence licences"),
    ]
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()}
    assert [got[i].licence_id for i in range(1, 7)] == ["MIT", "ISC", None, None, None, None]
    assert got[4].canonical_digest is None and got[5].canonical_digest == hashlib.sha256(b"").hexdigest()
    assert got[6].canonical_digest == hashlib.sha256(b"license license licenses").hexdigest()
    assert licences.scan_licences(docs.withColumn("licence_id", F.lit(1)), known).count() == len(rows())
    assert licences.scan_licences(empty, known).count() == 0


def test_licence_titles_and_copyright_lines(spark):
    known = licences.known_digests(spark)
    texts = [
        (1, "The MIT License (MIT)\n\nCopyright (c) 2014 Somebody\n\n" + licences.MIT),
        (2, "BSD 3-Clause License\n\nCopyright The Project Authors. All rights reserved.\n\n" + licences.BSD_CLAUSES + licences.BSD_THIRD + licences.BSD_DISCLAIMER),
        (3, "# Copyright the contributors of X\n" + licences.BSD_CLAUSES + licences.BSD_DISCLAIMER.replace("HOLDERS AND", "\nHOLDERS AND").replace("THE COPYRIGHT", "THE\nCOPYRIGHT")),
        (4, "The ISC License\n" + licences.MIT),
        (5, "Copyright The Project Authors"),
    ]
    got = {r.doc_id: r.licence_id for r in licences.scan_licences(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()}
    assert got == {1: "MIT", 2: "BSD-3-Clause", 3: "BSD-2-Clause", 4: None, 5: None}


def test_licences_from_a_folder_of_whole_texts(spark, tmp_path):
    """Long texts, re-wrapped, with other case and marks, are found by digests of the files."""
    rng = random.Random(4)
    folder = tmp_path / "licences"
    folder.mkdir()
    whole = {}
    for name in ("Long-1.0", "Long+2.0", "Other 3"):
        whole[name] = "\n\n".join(" ".join(rng.choice(["copyright", "notice", "the", "Work", "licence", "You", "may,", "not;"]) for _ in range(3000)) for _ in range(5))
        (folder / f"{name}.txt").write_text(whole[name])
    (folder / "empty").write_text(" \n")
    system = "/usr/share/common-licenses/Apache-2.0"
    import os

    if os.path.exists(system):
        whole["Apache-2.0"] = open(system).read()
        (folder / "Apache-2.0").write_text(whole["Apache-2.0"])
    known = licences.digests_of(licences.licence_folder(spark, str(folder)))
    texts = [(i, t.upper().replace(" ", "   \t") + "\n--\n", name) for i, (name, t) in enumerate(sorted(whole.items()))]
    texts += [(98, texts[0][1][:-2000], None), (99, "", None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, want string")
    assert [(r.licence_id, r.want) for r in licences.scan_licences(df, known).collect() if r.licence_id != r.want] == []
    rows = spark.createDataFrame([(None, "a"), ("b", None), ("d", "same"), ("c", "Same!")], "licence_id string, text string")
    assert [r.licence_id for r in licences.digests_of(rows).collect()] == ["c"]


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_round_trip(spark, tmp_path, zip64):
    pages = [(1, "http://a/", "same"), (2, "u\r\nv", "same"), (5, None, "same"), (3, "c", "é\r\n\r\nx"), (4, "d", None), (6, "e", ""), (None, "n", "alone"), (7, "big", "y" * 300_000)]
    pages += [(7, "big", "y" * 300_000)]
    folder = str(tmp_path / "archives")
    archives = warc_zip.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), folder, zip64)
    got = warc_zip.read_records(archives, folder).collect()
    assert len(got) == len(pages) == sum(r.records for r in archives.collect())
    last = {}
    for page_id, _, html in pages:
        last[html or ""] = max(last.get(html or "", -1), -1 if page_id is None else page_id)
    bodies = {(p, h or "") for p, _, h in pages}
    for r in got:
        body = next(h for p, h in bodies if p == r.page_id)
        response = r.page_id is None or last[body] == r.page_id
        assert r.record_type == ("response" if response else "revisit")
        assert r.refers_to == (None if response else last[body])
        assert r.payload_bytes == len(body.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        assert (bytes(r.payload) if response else r.payload) == (body.encode() if response else None)
    # Another reader of ZIP files sees sound members.
    for r in archives.collect():
        with zipfile.ZipFile(r.path) as archive:
            assert archive.testzip() is None
            assert archive.namelist() == [warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER]
    none = warc_zip.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder, zip64)
    assert warc_zip.read_records(none, folder).count() == 0


def test_directory_with_comment_and_foreign_writer():
    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.comment = b"PK\x05 is not a signature" * 50
        archive.writestr("a", b"alpha")
        archive.writestr("dir/b", b"beta" * 100)
    source = Source(buffer.getvalue())
    members = warc_zip.zip_members(source)
    at, size = members["dir/b"]
    assert source.getvalue()[at : at + size] == b"beta" * 100 and members["a"][1] == 5
    with pytest.raises(ValueError):
        warc_zip.zip_members(Source(b"no archive"))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", b"alpha" * 100)
    with pytest.raises(ValueError):
        warc_zip.zip_members(Source(packed.getvalue()))
