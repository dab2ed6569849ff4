"""Substring deduplication with compressed FM-indexes.

A window is a run of consecutive words. Its anchor is the smallest hash among its shorter
n-grams, so equal windows have equal anchors, and the text around an anchor is a segment.
Segments whose anchor no other document has are settled. The others are dealt to shards by
anchor; each shard builds an FM-index (a wavelet matrix of packed bits over the Burrows-
Wheeler transform) of its distinct segments and streams the segments through backward
search: the suffix range of each window gives the smallest document that has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from obslake.llm.common import batch_slices, memory_returned, numbered, released, staged, swept
from obslake.llm.hashing import ngram_hashes, utf8, word_hashes, word_spans
from obslake.llm.repeats import shared_hashes
from obslake.session import ship_package

WINDOW_WORDS = 13
ANCHOR_WORDS = 5
#: Distinct segments of one shard, on average.
SHARD_SEGMENTS = 20_000
#: Distinct segments around one anchor above which they are dealt window by window.
HOT_SEGMENTS = SHARD_SEGMENTS // 4
#: Rank of a null doc_id: behind all others.
NO_ID = 2**63 - 1
SLICE_BYTES = 2 << 20


class FmIndex:
    """FM-index over integer sequences (symbols 0, 1, ...), with document ranges.

    The sequences are laid end to end, each with an end mark of its own, so that every suffix
    order is settled within its sequence. ``search`` extends matches to the left.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        count = len(lengths)
        self.size = int(symbols.max()) + 1 if len(symbols) else 0
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(len(symbols) + count, dtype=np.int64)
        mark = np.zeros(len(text), dtype=bool)
        mark[ends] = True
        text[~mark] = symbols + count
        text[mark] = np.arange(count)
        self.order = _suffix_order(text, int(lengths.max()) + 1 if count else 0)
        before = np.concatenate([text[-1:], text[:-1]])[self.order]
        counts = np.bincount(text[~mark] - count, minlength=self.size)
        self.first = count + np.cumsum(counts) - counts
        # End marks are never searched for: one symbol, the largest, stands for them all.
        self.counts = counts
        self.levels = _wavelet_matrix(np.where(before >= count, before - count, self.size), self.size + 1)
        # Where each symbol's stretch begins behind the last level: it depends on the symbol alone.
        self.starts = np.zeros(self.size, dtype=np.int64)
        self.starts = self._walked(np.arange(self.size), self.starts)

    def _walked(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``at`` carried through the levels along ``symbol``."""
        for shift, (packed, ones, zeros) in zip(range(len(self.levels) - 1, -1, -1), self.levels, strict=True):
            before = _ones_before(packed, ones, at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + before, at - before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in the transform before ``at``."""
        return self._walked(symbol, at) - self.starts[symbol]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges after one more symbol on the left (empty where low >= high)."""
        first = self.first[symbol]
        both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return first + both[: len(low)], first + both[len(low) :]

    def window_ranges(self, symbols: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each window of ``length`` symbols of ``symbols`` at ``starts``.

        The windows are windows of the indexed sequences. A window is done once its end is found in one
        place only: what it gets is the range of that end, one suffix of its own sequence.
        """
        last = symbols[starts + length - 1]
        low, high = self.first[last], self.first[last] + self.counts[last]
        for k in range(length - 2, -1, -1):
            more = np.flatnonzero(high - low > 1)
            low[more], high[more] = self.extend(symbols[starts[more] + k], low[more], high[more])
        return low, high


def _suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array by doubling; suffixes differ within ``depth`` symbols."""
    n, reach = len(text), 1
    rank = text
    order = np.argsort(rank, kind="stable")
    while reach < depth:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - reach] = rank[reach:] + 1
        key = rank * np.int64(n + 2 + int(rank.max())) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        reach *= 2
    return order


def _wavelet_matrix(symbols: np.ndarray, size: int) -> list:
    """Per bit from the highest: packed bits, ones before each 64-bit word, and the number of zeros."""
    levels = []
    for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
        bits = ((symbols >> shift) & 1).astype(bool)
        words = np.zeros((len(bits) + 64) // 64 * 64, dtype=bool)
        words[: len(bits)] = bits
        packed = np.packbits(words, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32)
        levels.append((packed, ones, int(len(bits) - bits.sum())))
        symbols = np.concatenate([symbols[~bits], symbols[bits]])
    return levels


def _ones_before(packed: np.ndarray, ones: np.ndarray, at: np.ndarray) -> np.ndarray:
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    inside = packed[word] & ((np.uint64(1) << bit) - np.uint64(1))
    return ones[word] + np.bitwise_count(inside)


def anchored_windows(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor word, anchor hash) of every window (all words of one row)."""
    count = len(words) - WINDOW_WORDS + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = ngram_hashes(words, ANCHOR_WORDS)
    best, at = grams[:count].copy(), np.arange(count)
    for k in range(1, WINDOW_WORDS - ANCHOR_WORDS + 1):
        other = grams[k : k + count]
        less = other < best  # ties: the leftmost
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    whole = np.flatnonzero(rows[:count] == rows[WINDOW_WORDS - 1 :])
    return whole, at[whole], best[whole]


def _hashed(batch_text):
    data, offsets = utf8(batch_text)
    start, end, rows = word_spans(data, offsets)
    return word_hashes(data, start, end), rows


def shared_anchors(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, row_key, anchors) of the rows with an anchor that another row has too."""

    def extract(batch):
        import pyarrow as pa

        words, rows = _hashed(batch.column(2))
        first, _, anchors = anchored_windows(words, rows)
        own = rows[first] if len(first) else np.zeros(0, np.int64)
        order = np.lexsort((anchors, own))
        own, anchors = own[order], anchors[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (anchors[1:] != anchors[:-1])
        kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["doc_id", "row_key"])
        # The anchor itself is the smallest of several hashes; it is mixed to spread evenly.
        return kept, own[new], _spread(anchors[new])

    def finish(kept, rows, tokens, df):
        import pyarrow as pa

        order = np.argsort(rows, kind="stable")
        rows, tokens = rows[order], tokens[order] & np.uint64((1 << 40) - 1)
        present = np.unique(rows)
        starts = np.searchsorted(rows, present)
        ends = np.append(starts[1:], len(rows))[: len(starts)]  # no row may have any
        return pa.RecordBatch.from_arrays(
            [
                kept.column("doc_id").take(pa.array(present)),
                kept.column("row_key").take(pa.array(present)),
                pa.array([tokens[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            ],
            names=["doc_id", "row_key", "anchors"],
        )

    return shared_hashes(docs, extract, finish, "doc_id long, row_key long, anchors binary", "anchors")


def _spread(anchors: np.ndarray) -> np.ndarray:
    from obslake.llm.hashing import mix

    return mix(anchors ^ np.uint64(0xA0761D6478BD642F))


def segments(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(anchor, words, doc_id, row_key, start) of every run of windows with one shared anchor.

    ``words`` are 32-bit word hashes; a segment has one window to nine.
    """
    mask = np.uint64((1 << 40) - 1)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = np.diff(utf8(batch.column(3))[1])
            for lo, hi in batch_slices(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                words, rows = _hashed(part.column(3))
                first, at, anchors = anchored_windows(words, rows)
                anchors = _spread(anchors)
                own = rows[first] if len(first) else np.zeros(0, np.int64)
                live = np.zeros(len(first), dtype=bool)
                bounds = np.searchsorted(own, np.arange(part.num_rows + 1))
                for i, known in enumerate(part.column(2).to_pylist()):
                    a, b = bounds[i], bounds[i + 1]
                    live[a:b] = np.isin(anchors[a:b] & mask, np.frombuffer(known, np.uint64))
                first, at, anchors, own = first[live], at[live], anchors[live], own[live]
                new = np.ones(len(first), dtype=bool)
                new[1:] = at[1:] != at[:-1]
                starts = np.flatnonzero(new)
                ends = np.append(starts[1:], len(first)) - 1
                short = words.astype(np.uint32)
                row_start = np.searchsorted(rows, np.arange(part.num_rows))
                lefts, rights, owners = first[starts], first[ends] + WINDOW_WORDS, own[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors[starts].view(np.int64)),
                        pa.array([short[a:b].tobytes() for a, b in zip(lefts, rights, strict=True)], pa.binary()),
                        part.column(0).take(pa.array(owners)),
                        part.column(1).take(pa.array(owners)),
                        pa.array(lefts - row_start[owners], pa.int64()),
                    ],
                    names=["anchor", "words", "doc_id", "row_key", "start"],
                )
        memory_returned()

    keys = ["doc_id", "row_key"]
    known = shared.dropDuplicates(keys).select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "anchors")
    joined = docs.join(known.hint("merge"), (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return joined.select("doc_id", "row_key", "anchors", "text").mapInArrow(
        cut, "anchor long, words binary, doc_id long, row_key long, start long"
    )


def crowded_anchors(found: DataFrame) -> DataFrame:
    """Anchors with many distinct segments: a phrase that stands in very many contexts."""
    distinct = found.select("anchor", F.xxhash64("words").alias("seg")).distinct()
    return distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_SEGMENTS).select("anchor")


def dealt(found: DataFrame, crowded: DataFrame) -> DataFrame:
    """``found`` with ``deal``, the hash by which segments are dealt to shards.

    Segments around one anchor go to one shard. Those around a crowded anchor are first cut into
    their windows, which are dealt by their own words: equal windows still meet.
    """
    spread = F.col("crowded")
    windows = F.expr(
        f"transform(sequence(0, cast(octet_length(words) div 4 as int) - {WINDOW_WORDS}), "
        f"i -> struct(substring(words, 4 * i + 1, {4 * WINDOW_WORDS}) as words, start + i as start))"
    )
    pieces = F.when(spread, windows).otherwise(F.array(F.struct("words", "start")))
    joined = found.join(crowded.withColumn("crowded", F.lit(True)), "anchor", "left")
    cut = joined.select("anchor", "doc_id", "row_key", "crowded", F.explode(pieces).alias("piece")).select(
        "anchor", "doc_id", "row_key", "crowded", "piece.words", "piece.start"
    )
    return cut.withColumn("deal", F.when(spread, F.xxhash64("anchor", "words")).otherwise(F.xxhash64("anchor"))).drop("crowded")


def shard_matches(table):
    """For a shard's distinct segments (seg, words, owner): per window of a segment the smallest
    owner of any segment that holds the window, by backward search in the shard's FM-index."""
    import pyarrow as pa

    pieces = [np.frombuffer(w, np.uint32) for w in table.column("words").to_pylist()]
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    symbols = np.unique(np.concatenate(pieces), return_inverse=True)[1].astype(np.int64)
    index = FmIndex(symbols, lengths)
    # The owner of every suffix, in suffix order.
    owners = np.repeat(table.column("owner").to_numpy(), lengths + 1)[index.order]
    windows = lengths - WINDOW_WORDS + 1
    offsets = np.cumsum(lengths) - lengths
    starts = np.repeat(offsets - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    low, high = index.window_ranges(symbols, starts, WINDOW_WORDS)
    # Equal windows have one range, different ones disjoint ranges; of windows that are done early those
    # with one range end in the same place.
    ranges, which = np.unique(low, return_inverse=True)
    tops = np.zeros(len(ranges), dtype=np.int64)
    tops[which] = high
    edges = np.stack([ranges, tops], axis=1).ravel()
    least = np.minimum.reduceat(np.append(owners, NO_ID), edges)[::2][which]
    cuts = np.cumsum(windows)
    smallest = [least[b - n : b] for b, n in zip(cuts, windows, strict=True)]
    return pa.table({"seg": table.column("seg"), "smallest": pa.array([x.tolist() for x in smallest], pa.list_(pa.int64()))})


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, windows): first words of the windows whose word sequence also starts in a
    document with a smaller doc_id. ``docs`` has doc_id, row_key, text."""
    spark = docs.sparkSession
    ship_package(spark)
    anchors = shared_anchors(docs)
    written = staged(segments(docs, anchors), "segments")
    released(anchors)
    crowded = staged(crowded_anchors(written), "crowded-anchors")
    # What follows from the other columns is computed again rather than written.
    found = dealt(written, crowded).withColumns({"seg": F.xxhash64("anchor", "words"), "owner": F.coalesce("doc_id", F.lit(NO_ID))})
    # Copies of a segment are one entry of the index, combined before the shuffle.
    distinct = staged(
        found.groupBy("seg").agg(F.first("deal").alias("deal"), F.first("words").alias("words"), F.min("owner").alias("owner")),
        "distinct-segments",
    )
    swept(spark)

    def matches(table):
        out = shard_matches(table)
        memory_returned()
        return out

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + distinct.count() // SHARD_SEGMENTS)
    matched = (
        distinct.withColumn("shard", F.pmod("deal", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(matches, "seg long, smallest array<long>")
    )
    hits = found.select("seg", "doc_id", "row_key", "owner", "start").join(matched.hint("merge"), "seg")
    hits = hits.withColumn(
        "windows", F.expr("filter(transform(smallest, (x, i) -> CASE WHEN x < owner THEN start + i END), x -> x IS NOT NULL)")
    ).where(F.size("windows") > 0)
    windows = staged(
        hits.groupBy("doc_id", "row_key").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows")), "windows"
    )
    released(written, distinct, crowded)
    return windows


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept_text`` (the words that no repeated window covers,
    joined by one space).

    Windows are judged on the input as a whole. Null text: no words, and kept_text empty. A
    null doc_id comes after all others; rows with one doc_id do not remove each other's words;
    repeated rows get equal results. Columns named like the results are replaced.
    """
    ship_package(docs.sparkSession)
    own = ["n_words", "n_removed", "kept_text"]
    docs = docs.drop(*own)
    plain, col = numbered(docs)
    doc_id, text = col("doc_id").cast("long"), col("text").cast("string")
    keyed = plain.withColumn("row_key", F.xxhash64(text))
    windows = repeated_windows(keyed.select(doc_id.alias("doc_id"), "row_key", text.alias("text")))
    windows = windows.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "windows")
    joined = keyed.join(windows.hint("merge"), (F.col("row_key") == F.col("key")) & doc_id.eqNullSafe(F.col("id")), "left")

    def strip(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            last = batch.num_columns - 1
            texts, gone = batch.column(last - 1), batch.column(last)
            counts, removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                starts = gone[i].as_py()
                stay = words
                if starts:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    at = np.array(starts)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + WINDOW_WORDS, -1)
                    stay = [words[j] for j in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                counts.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(last - 1)], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*rest, *own],
            )

    rest = docs.columns
    source = joined.select(*plain.columns, text.alias("text"), "windows")
    results = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())]
    return source.mapInArrow(strip, StructType([*docs.schema.fields, *results]))
