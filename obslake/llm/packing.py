"""Packing token sequences into windows by non-negative least squares.

Documents are cut into windows and one remainder each. Over the histogram of piece lengths,
all combinations of up to three lengths that fill a window exactly are the columns of a
non-negative least squares problem; the solution, rounded down to what the histogram still
holds, says how often each combination is used. Residual pieces are packed greedily. Only
the histogram (one number per length, at most the window) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import batch_slices, staged
from obslake.session import ship_package

WINDOW = 1024
END_ID = 0
#: Text bytes tokenized at a time.
SLICE_BYTES = 2 << 20
#: Rows of one rank bucket of a length, on average.
BUCKET_ROWS = 1_000
PIECES_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"

_ENCODERS: dict = {}


def encoder(tokenizer_path: str):
    """Encoder of a ``tokenizers`` file: its ids, without those that the file adds around a text.

    For a byte-level BPE file with its rank file beside it (same name, ``.tiktoken``) the ranks
    are used, several times faster, for texts of which they give the same ids. Texts with an
    added token (``<|endoftext|>``), which the ranks would spell out, and texts that the rank
    encoder refuses (about a million blanks in one run) are encoded by ``tokenizers``."""
    if tokenizer_path not in _ENCODERS:
        import os

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)

        def exact(text: str) -> np.ndarray:
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        ranks_path = tokenizer_path.removesuffix(".json") + ".tiktoken"
        # With a normalizer, a text may hold an added token without holding its letters.
        if os.path.exists(ranks_path) and tokenizer.normalizer is None:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

            def encode(text: str) -> np.ndarray:
                if any(token in text for token in added):
                    return exact(text)
                try:
                    return bpe.encode_to_numpy(text, disallowed_special=())
                except ValueError:  # the pattern's stack is bounded
                    return exact(text)

            _ENCODERS[tokenizer_path] = encode
        else:
            _ENCODERS[tokenizer_path] = exact
    return _ENCODERS[tokenizer_path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_pieces(
    docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end_id: int = END_ID, text: str = "text"
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids) of every document's pieces: whole windows, then the
    rest. ``ids`` are little-endian unsigned 32-bit. Null or empty text: the end id alone."""
    ship_package(docs.sparkSession)
    path = tokenizer_path or default_tokenizer()

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
        )
        encode = encoder(path)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            lengths = texts.fill_null("").to_pandas().str.len().to_numpy() if len(texts) else []
            for lo, hi in batch_slices(lengths, SLICE_BYTES):
                rows = ([], [], [], [], [])
                for doc_id, body in zip(names[lo:hi], texts.slice(lo, hi - lo).to_pylist(), strict=True):
                    ids = np.append(encode(body or ""), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        for column, value in zip(rows, (doc_id, start, len(piece), len(ids), piece.tobytes()), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(rows, schema, strict=True)], schema=schema
                )

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(cut, PIECES_SCHEMA)


def filling_combinations(lengths: list[int], window: int = WINDOW) -> np.ndarray:
    """All multisets of one to three of ``lengths`` with the sum ``window``, as rows padded with 0."""
    have = np.zeros(window + 1, dtype=bool)
    have[[n for n in lengths if 0 < n <= window]] = True
    rows = [np.array([[window, 0, 0]])] if have[window] else []
    values = np.flatnonzero(have[:window])
    pairs = [(a, window - a, 0) for a in values if a >= window - a and have[window - a]]
    rows += [np.array(pairs)] if pairs else []
    for a in values:
        b = values[(values <= a) & (values >= (window - a + 1) // 2) & (values < window - a)]
        b = b[have[window - a - b]]
        if len(b):
            rows.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(rows).astype(np.int64) if rows else np.zeros((0, 3), dtype=np.int64)


def nonnegative_least_squares(combinations: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, A counting each length in each
    combination; accelerated projected gradient steps over the sparse columns."""
    if not len(combinations):
        return np.zeros(0)
    flat, size = combinations.ravel(), len(histogram)

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, weights=np.repeat(x, 3), minlength=size)
        out[0] = 0
        return out

    def backward(r: np.ndarray) -> np.ndarray:
        return r[combinations].sum(axis=1)

    probe = np.ones(len(combinations))
    for _ in range(12):
        probe = backward(forward(probe / np.linalg.norm(probe)))
    step = 1.0 / (1.05 * np.linalg.norm(probe))
    goal = histogram.astype(np.float64)
    goal[0] = 0
    x = y = np.zeros(len(combinations))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * backward(forward(y) - goal))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def packing_plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """[(lengths with their multiplicity, number of sequences)] that uses up the histogram."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[dict[int, int], int]] = []
    combinations = filling_combinations(list(np.flatnonzero(left)), window)
    solution = nonnegative_least_squares(combinations, left)
    for j in np.argsort(-solution, kind="stable"):
        repeats = int(np.rint(solution[j]))
        if repeats <= 0:
            break
        used: dict[int, int] = {}
        for n in combinations[j]:
            if n:
                used[int(n)] = used.get(int(n), 0) + 1
        repeats = min(repeats, *(int(left[n]) // k for n, k in used.items()))
        if repeats > 0:
            plan.append((used, repeats))
            for n, k in used.items():
                left[n] -= k * repeats
    while left.any():
        used, space = {}, window
        have = left.copy()
        while space > 0 and len(fit := np.flatnonzero(have[: space + 1])):
            n = int(fit[-1])
            k = min(int(have[n]), space // n)
            used[n] = used.get(n, 0) + k
            have[n] -= k
            space -= n * k
        repeats = min(int(left[n]) // k for n, k in used.items())
        plan.append((used, repeats))
        for n, k in used.items():
            left[n] -= k * repeats
    return plan


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (with ``length`` up to ``window``) with sequence_id and offset.

    Every row is placed once; offsets in a sequence are gapless from 0. Pieces of one length
    are numbered in parallel: rows are dealt to buckets by hash, ranked inside, and offset by
    the buckets' sums, so a length that a third of all pieces have is no hot group. Repeated
    rows are pieces of their own. Columns named like the results are replaced.
    """
    spark = pieces.sparkSession
    pieces = staged(pieces.drop("sequence_id", "offset"), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(n is None or not 0 < n <= window for n in counts):
        raise ValueError("pieces must have lengths from 1 to the window")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for n, count in counts.items():
        histogram[n] = count
    plan = packing_plan(histogram, window)
    # Interval table: ranks [lo, ...) of a length go to sequences from `base`, `per` in each, from `at`.
    entries, used_up, sequence = [], dict.fromkeys(counts, 0), 0
    for used, repeats in plan:
        at = 0
        for n in sorted(used, reverse=True):
            entries.append((n, used_up[n], sequence, used[n], at))
            used_up[n] += used[n] * repeats
            at += n * used[n]
        sequence += repeats
    entries.sort()
    table = spark.sparkContext.broadcast(np.array(entries, dtype=np.int64).reshape(-1, 5))
    rank_bits = np.int64(1) << np.int64(48)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = table.value
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = rows[np.searchsorted(rows[:, 0] * rank_bits + rows[:, 1], n * rank_bits + r, side="right") - 1]
        within = r - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + within // row[:, 3], "offset": row[:, 4] + within % row[:, 3] * n})

    buckets = 1 + max(counts.values(), default=0) // BUCKET_ROWS
    keys = [c for c, t in pieces.dtypes if t != "binary" and not t.startswith("map")]
    dealt = pieces.withColumn("_order", F.xxhash64(*keys)).withColumn(
        "_bucket", F.pmod(F.shiftrightunsigned("_order", 20), F.lit(buckets))
    )
    sums = dealt.groupBy("length", "_bucket").count()
    above = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "_bucket", F.coalesce(F.sum("count").over(above), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn(
        "_n", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_order", *keys))
    ).join(starts, ["length", "_bucket"])
    placed = ranked.withColumn("_place", place("length", F.col("_before") + F.col("_n") - 1))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def packed_documents(docs: DataFrame, tokenizer_path: str | None = None, text: str = "text") -> DataFrame:
    """Documents tokenized, cut and packed: doc_id, start, length, doc_tokens, ids, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer_path, text=text))
