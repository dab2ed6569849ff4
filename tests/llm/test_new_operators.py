"""Spelling variants, periodic runs and secret scans against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import mixing, periodic_runs, queries, secret_scan, spelling, substring, topk
from tests.conftest import SF_SMALL
from tests.llm.test_operators import DOCS, prose, words
from tests.llm.test_operators import rows as odd_rows

CLASHING = ("runs", "n_words", "secrets", "word", "half", "n", "shard", "_h", "kind")


def clashing(df, *but):
    """``df`` with extra columns named like columns of the operators."""
    return df.withColumns({name: F.lit("clash") for name in CLASHING if name not in but})


def written(spark, tmp_path, data, schema=DOCS):
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "documents.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet"))


# ------------------------------------------------------------------ periodic runs


def brute_runs(w, least=6, times=4):
    """Every period by itself: stretches in which each word comes again q words later."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            end = i
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            if end - i + q >= max(least, times * q):
                found.setdefault((i, end - i + q), q)
            i = end
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_collapsed(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted_words(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def run_texts():
    rng = random.Random(5)
    texts = [r[1] for r in odd_rows()]
    for k in (1, 2, 3, 5):
        texts += [" ".join(f"v{rng.randrange(k)}" for _ in range(rng.randrange(1, 200))) for _ in range(10)]
    for p in (1, 2, 3, 7, 20, 41):
        unit = prose(rng, p).split()
        body = (unit * 9)[: 4 * p + rng.randrange(-1, 3 * p + 2)]
        texts.append(" ".join(prose(rng, 7).split() + body + ["\n"] + prose(rng, 5).split() + body))
    texts += ["a " * 5, "a " * 6, "a b " * 6, "ab " * 3 + "a b " * 4, "x y " * 3000 + "x x"]
    return texts


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (9, 3)])
def test_periodic_runs(spark, tmp_path, least, times):
    data = [(i, t, None, None, 0) for i, t in enumerate(run_texts())]
    docs = clashing(written(spark, tmp_path, data + [data[3]]))
    got = periodic_runs.periodic_runs(docs, least, times).collect()
    assert len(got) == len(data) + 1
    found = 0
    for r in got:
        w = words(r.text)
        expected = brute_runs(w, least, times)
        assert [tuple(x) for x in r.runs] == expected
        assert r.n_words == len(w) and r.collapsed_text == brute_collapsed(w, expected)
        found += len(expected)
    assert found > 20
    assert set(got[0].asDict()) == {*docs.columns, "collapsed_text"}
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.periodic_runs(docs, 6, 1)


def test_common_extensions_of_a_grammar():
    rng = np.random.default_rng(4)
    for size, letters in ((400, 2), (900, 3), (700, 40)):
        inner = rng.integers(2, 2 + letters, size)
        inner[size // 2 :] = inner[: size - size // 2]
        text = np.concatenate([[0], inner, [1]])
        grammar = periodic_runs.Grammar(text, 2)
        assert all(len(s) >= 3 for s in grammar.symbols) and len(grammar.symbols[-1]) == 3
        a, b = rng.integers(1, size + 1, (2, 2000))
        a, b = a[a != b], b[a != b]
        for back in (False, True):
            for i, j, n in zip(a, b, grammar.extension(a, b, back)):
                n = int(n)
                if back:
                    assert (text[i - n : i] == text[j - n : j]).all() and text[i - n - 1] != text[j - n - 1]
                else:
                    assert (text[i : i + n] == text[j : j + n]).all() and text[i + n] != text[j + n]


def test_grid_of_one_long_text_comes_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    w = np.tile(rng.integers(0, 4, 90), 12)
    w[500] = 9
    whole = periodic_runs.runs_of(w, np.array([len(w)]), 6, 4)
    monkeypatch.setattr(periodic_runs, "STEP_POINTS", 64)
    parts = periodic_runs.runs_of(w, np.array([len(w)]), 6, 4)
    assert all((x == y).all() for x, y in zip(whole, parts))
    assert [tuple(map(int, x)) for x in zip(*parts[1:])] == brute_runs(list(w))


def check_op12(got, docs):
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in docs)
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(t)
    with_runs = 0
    for r in got:
        options = []
        for t in texts[r.doc_id]:
            w = planted_words(r.doc_id, words(t))
            runs = brute_runs(w)
            lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
            best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
            milli = None if best[0] is None else 1000 * best[1] // best[2]
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_collapsed(w, runs))]
            options.append((len(runs), *best, milli, *digests))
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) in options
        with_runs += r.n_runs > 0
    return with_runs


def test_op12_on_odd_rows(spark, tmp_path):
    data = [(i, t, None, None, 0) for i, t in enumerate(run_texts())] + [(None, "a a a a a a a", None, None, 0), (10, None, None, None, 0)]
    written(spark, tmp_path, data)
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert check_op12(got, [r[:2] for r in data]) > 20


def test_op12_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_periodic_runs"](spark, SF_SMALL)
    assert got.columns[:8] == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert check_op12(got.collect(), docs) > 5


# ------------------------------------------------------------------ secrets


def base62(value, n=6):
    out = ""
    for _ in range(n):
        out, value = secret_scan.BASE62[value % 62] + out, value // 62
    return out


def github(prefix, body):
    return prefix + body + base62(zlib.crc32(body.encode()))


def base58(raw):
    value, out = int.from_bytes(raw, "big"), ""
    while value:
        value, rest = divmod(value, 58)
        out = secret_scan.BASE58[rest] + out
    return out


def bech32(prefix, data):
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + data + [0] * 6
    rest = 1
    for v in values:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ v
        for i in range(5):
            rest ^= secret_scan.BECH32_STEPS[i] if top >> i & 1 else 0
    rest ^= 1
    return prefix + "1" + "".join(secret_scan.BECH32[x] for x in [*data, *(rest >> 5 * (5 - i) & 31 for i in range(6))])


def armoured(raw):
    rest = 0xB704CE
    for byte in raw:
        rest ^= byte << 16
        for _ in range(8):
            rest = rest << 1 ^ (0x1864CFB if rest & 0x800000 else 0)
            rest &= 0x1FFFFFF
    lines = base64.encodebytes(raw).decode()
    check = base64.b64encode((rest & 0xFFFFFF).to_bytes(3, "big")).decode()
    return f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: x\n\n{lines}={check}\n-----END PGP PRIVATE KEY BLOCK-----"


PRIVATE = bytes.fromhex("0488ade4") + bytes(range(74))
XPRV = base58(PRIVATE + hashlib.sha256(hashlib.sha256(PRIVATE).digest()).digest()[:4])
CHECKED = {
    "github": github("ghp_", "Ab3" * 10),
    "npm": github("npm_", "0zZ" * 10),
    "xprv": XPRV,
    "nsec": bech32("nsec", [i % 32 for i in range(52)]),
    "age": bech32("age-secret-key-", [(7 * i) % 32 for i in range(52)]).upper(),
    "pgp": armoured(bytes(range(200))),
}


def secret_texts():
    rng = random.Random(11)
    pieces = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "api__key", ":", "=", " = ", " ", "'", '"', "abc", "abcdef", "x/y+z==",
              "AKIA", "akia", "AKIA" + "Q" * 15, "AKIA" + "7" * 16, "AKIA" + "Z" * 30, "0f" * 11, "0f" * 12, "deadbeef" * 7, "DEADBEEF" * 4,
              "é", "日本", "\n", "\t", "ſecret", "toKen", "\U0001f511", *CHECKED.values()]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(400)]
    texts += ["token=secret=abcdef", "token == abcdef token: abcdef", "password" * 3 + "=hunter22", "secretoken=abcdefg", "token:  'short", "tokKen=abcdef"]
    texts += [f"key {v} end" for v in CHECKED.values()]
    return texts + [None, "", "x" * 300_000 + " token=abcdef " + "a" * 200_000, "é" * 50_000 + "0f" * 20]


BASE = (
    ("assign", re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def brute_base(text):
    found = []
    for i, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [x for *_, x in sorted(found)]


def check_op13(got, docs):
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(t)
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in docs)
    for r in got:
        options = [brute_base(t) for t in texts[r.doc_id]]
        spans = [x for x in r.spans.split(",") if x]
        base = [x for x in spans if x.split(":")[0] in secret_scan.BASE_NAMES]
        assert base in options
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in secret_scan.BASE_NAMES)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        order = [(int(x.split(":")[1]), [k.name for k in secret_scan.KINDS].index(x.split(":")[0])) for x in spans]
        assert order == sorted(order)


def test_op13_on_odd_rows(spark, tmp_path):
    data = [(i, t, None, None, 0) for i, t in enumerate(secret_texts())]
    data += [(i + 1000, t, None, None, 0) for i, t in enumerate(run_texts())] + [data[0], (None, "token=abcdef", None, None, 0)]
    written(spark, tmp_path, data)
    got = queries.QUERIES["op13_secret_scan"](spark, str(tmp_path)).collect()
    check_op13(got, [r[:2] for r in data])
    assert {k for r in got for k in re.findall(r"[a-z]+", r.spans)} == {k.name for k in secret_scan.KINDS}


def test_op13_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_secret_scan"](spark, "/root/testdata/sf0.01")
    assert got.columns[:6] == "doc_id n_assign n_access n_hex base_sha256 spans".split()
    got = got.collect()
    check_op13(got, docs)
    assert sum(r.n_assign for r in got) > 5


def test_checksums_decide(spark):
    """A secret with one character changed is none."""
    rng = random.Random(3)
    data = []
    for kind, secret in CHECKED.items():
        data.append((kind, f"« {secret} »", True))
        body = range(40, 100) if kind == "pgp" else range(len(secret) - 30, len(secret))
        if kind == "pgp":
            body = range(secret.index("\n\n") + 2, secret.index("\n\n") + 60)
        for _ in range(20):
            at = rng.choice(body)
            other = rng.choice([c for c in secret[body[0] : body[-1]] if c != secret[at] and c.isalnum()])
            data.append((kind, f"« {secret[:at]}{other}{secret[at + 1 :]} »", False))
    docs = clashing(spark.createDataFrame(data, "name string, text string, is_one boolean"))
    got = secret_scan.scan_secrets(docs).collect()
    assert len(got) == len(data)
    for r in got:
        spans = [s for s in r.secrets if s.kind == r.name]
        assert len(spans) == int(r.is_one), (r.name, r.text)
        if spans:
            assert r.text[spans[0].start : spans[0].end] == CHECKED[r.name]
    assert secret_scan.scan_secrets(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ spelling variants


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if v != w and is_near(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v.encode()), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return out


def odd_words(seed):
    rng = random.Random(seed)
    out = {}
    for letters, longest, n in (("ab", 6, 60), ("abc", 9, 250), ("abcdefghijklmnopqrstuvwxyzàéßÿ", 12, 150)):
        for _ in range(n):
            word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, longest)))
            out[word] = out.get(word, 0) + rng.randrange(1, 60)
    for stem in ("harbour", "colour", "x" * 300, "ÀÀÀÀ", "日本語"):
        out[stem] = 900
        for k in range(len(stem[:9]) + 1):
            out[stem[:k] + "u" + stem[k:]] = rng.randrange(1, 500)
            out[stem[:k] + stem[k + 1 :]] = rng.randrange(1, 500)
    out.pop("", None)
    return out


@pytest.mark.parametrize("crowded,rows", [(None, None), (5, 200), (1, 50)])
def test_variants(spark, monkeypatch, crowded, rows):
    """Also with small shards, and with halves that are split over several."""
    if crowded:
        monkeypatch.setattr(spelling, "HALF_ROWS", crowded)
        monkeypatch.setattr(spelling, "SHARD_ROWS", rows)
    counts = odd_words(crowded or 0)
    data = [(w, n) for w, n in counts.items()] + [(None, 5), ("", 7), ("nocount", None)]
    some = next(iter(counts))
    data += [(some, 2), (some, 2)]
    counts[some] += 4
    frame = clashing(spark.createDataFrame(data, "word string, n long"), "word", "n")
    got = spelling.variants(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_variants(counts)
    assert sum(r[1] is not None for r in rows) > 40
    assert spelling.variants(frame.limit(0)).count() == 0


def brute_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def test_op11_on_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = [w for w in odd_words(4) if len(w) > 3]
    data = [(i, " ".join(rng.choice(vocabulary) for _ in range(200)) + " ÉCOLE École×÷", None, None, 0) for i in range(60)]
    data += [r for r in odd_rows()] + [data[7], (None, "harbour harbour harbour", None, None, 0)]
    written(spark, tmp_path, data, DOCS)
    got = [tuple(r) for r in queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path)).collect()]
    expected = brute_variants(brute_counts([r[:2] for r in data]))
    assert len(got) == len(expected) and set(got) == expected


def test_op11_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_spelling_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    expected = brute_variants(brute_counts(docs))
    assert len(rows) == len(expected) and set(rows) == expected
    assert sum(r[1] is not None for r in rows) > 0


def test_bidirectional_ranks_stay_in_step():
    """The rows of both directions stand for the same places, whichever way a match grew."""
    rng = random.Random(6)
    words_ = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(80)})
    index = spelling.WordIndex(words_)
    text = "\x01" + "\x01".join(words_) + "\x01"
    code = {c: i + 2 for i, c in enumerate("abc")} | {"\x01": spelling.MARK}
    for _ in range(200):
        at = rng.randrange(len(text))
        size = rng.randrange(1, 6)
        piece = text[at : at + size]
        middle = rng.randrange(len(piece))
        steps = [(c, True) for c in piece[middle:]] + [(c, False) for c in reversed(piece[:middle])]
        one = np.zeros(1, dtype=np.int64)
        m = spelling.Matches(one, one, one, one, np.array([len(index.word_at)]))
        for c, right in steps:
            m = index._extended(m, np.array([code[c]]), right)
        places = {i for i in range(len(text)) if text.startswith(piece, i)}
        found = index.leftwards.order[m.left[0] : m.left[0] + m.size[0]]
        assert set(map(int, found)) == places
        behind = index.rightwards.order[m.right[0] : m.right[0] + m.size[0]]
        assert {len(text) - int(x) - len(piece) for x in behind} == places


# ------------------------------------------------------------------ earlier operators


INTERNAL_NAMES = ("windows", "_text", "_row_key", "row_key", "c0", "blocks", "buckets", "needed", "source_no", "_source", "_spans", "spans", "key", "id", "one")


def test_substring_and_mix_keep_columns_named_like_their_own(spark, tmp_path):
    """Extra columns under any of the steps' names come through unchanged, and change no result."""
    plain = written(spark, tmp_path, odd_rows())
    named = plain.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in INTERNAL_NAMES})
    for operator in (substring.without_repeats, mixing.mixed_documents):
        got, expected = operator(named), operator(plain)
        assert Counter(map(tuple, got.select(*expected.columns).collect())) == Counter(map(tuple, expected.collect()))
        for r in got.select("doc_id", *INTERNAL_NAMES).collect():
            assert r.doc_id is None or all(r[name] == f"{name}{r.doc_id}" for name in INTERNAL_NAMES)
    columns = mixing.mix(named).columns
    assert [c for c in columns if c in INTERNAL_NAMES] == list(INTERNAL_NAMES)


def test_topk_blocks_are_left_out_only_on_proof():
    """With the k-th best of other blocks known, a block gives all of its candidates that reach it."""
    rng = np.random.default_rng(12)
    skipped = 0
    for trial in range(60):
        matrix = rng.integers(-200, 200, (rng.integers(1, 300), 8))
        if trial % 3 == 0:
            matrix = matrix // 50 * 50  # many equal scores
        ids = rng.permutation(len(matrix)).astype(np.int64)
        index, query = topk.ImpactIndex(ids, matrix), rng.integers(-200, 200, 8)
        scores = matrix @ query
        every = sorted(((-int(s), int(i)) for s, i in zip(scores, ids) if i != 3))
        for at_least in (None, int(np.quantile(scores, 0.9)), int(scores.max()), int(scores.max()) + 1, 10**7):
            got = index.search(query, 3, 5, at_least)
            best = [(-s, i) for s, i in every[:5]]
            assert [x for x in got if at_least is None or x[0] >= at_least] == [x for x in best if at_least is None or x[0] >= at_least]
            skipped += got == [] and bool(every)
    assert skipped >= 60
