"""Spelling variants: words one edit apart, by search schemes in bidirectional FM-indexes.

Two words one edit apart agree in the first or in the last half of either. So every word is dealt to
shards by the halves that it shares with a word of its length, one less or one more; a shard indexes
its delimited words in both directions and searches for those that were dealt there as queries: a half
with its delimiter is matched exactly, then the match goes on across the other half and allows one
error, keeping the suffix ranks in both directions in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import ascii_lower, staged
from obslake.session import ship_package

#: A run of letters (after A-Z are lower-cased).
LETTERS = "[a-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT = 5, 3
#: A run of a document loses a character if this divides its checksum.
CHANGED_EVERY = 97
#: Dealt rows of one shard, on average; rows of one half above which its words are split over shards.
SHARD_ROWS = 40_000
HALF_ROWS = 20_000
END, MARK = 0, 1  # behind the whole text; before and behind every word


class RankIndex:
    """Burrows-Wheeler transform of a text with ranks by a wavelet matrix: extends matches to the left."""

    def __init__(self, text: np.ndarray, size: int):
        self.order = suffix_order(text)
        self.transform = text[self.order - 1]
        counts = np.bincount(self.transform, minlength=size)
        first = np.cumsum(counts) - counts
        # Row of the suffix that is one symbol longer, for every row.
        self.longer = np.empty(len(text), dtype=np.int64)
        by_symbol = np.argsort(self.transform, kind="stable")
        self.longer[by_symbol] = np.arange(len(text))
        self.levels, place = [], self.transform
        starts = np.zeros(size, dtype=np.int64)
        every = np.arange(size)
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = (place >> shift) & 1 == 1
            padded = np.zeros((len(bits) + 64) // 64 * 64, dtype=bool)
            padded[: len(bits)] = bits
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = int(len(bits) - bits.sum())
            level = (packed, ones, zeros)
            self.levels.append((shift, *level))
            # Where each symbol's stretch begins at the next level: its first row, walked down once.
            before = _ones_before(packed, ones, starts)
            starts = np.where((every >> shift) & 1 == 1, zeros + before, starts - before)
            place = np.concatenate([place[~bits], place[bits]])
        self.base = first - starts

    def extend(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, size) after one more symbol, and how many of the rows have a smaller symbol there."""
        high = low + size
        less = np.zeros(len(low), dtype=np.int64)
        for shift, packed, ones, zeros in self.levels:
            bit = (symbol >> shift) & 1 == 1
            a, b = _ones_before(packed, ones, low), _ones_before(packed, ones, high)
            less += np.where(bit, (high - low) - (b - a), 0)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return self.base[symbol] + low, high - low, less


def _ones_before(packed: np.ndarray, ones: np.ndarray, at: np.ndarray) -> np.ndarray:
    word = at >> 6
    inside = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
    return ones[word] + np.bitwise_count(inside)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array: as many symbols as a long holds are compared at once, then twice as many each round."""
    n = len(text)
    bits = max(1, int(text.max(initial=1)).bit_length())
    reach = 62 // bits
    key = np.zeros(n, dtype=np.int64)
    for k in range(reach):
        key <<= bits
        key[: max(0, n - k)] |= text[k:]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, dtype=np.int64)
    while True:
        # A suffix's rank is the first place of those that are equal so far.
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        tied = ~fresh | ~np.append(fresh[1:], True)
        places = np.flatnonzero(tied)
        if not len(places):
            return order
        suffix = order[places]
        behind = np.where(suffix + reach < n, rank[np.minimum(suffix + reach, n - 1)], -1)
        own = rank[suffix]
        by = np.lexsort((behind, own))
        order[places] = suffix[by]
        own, behind = own[by], behind[by]
        fresh[places] = np.concatenate([[True], (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])])
        reach *= 2


@dataclass
class Matches:
    """Matches of stretches of queries: rows in both indexes, and how far each query has come."""

    query: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray

    def take(self, which: np.ndarray) -> Matches:
        return Matches(self.query[which], self.at[which], self.left[which], self.right[which], self.size[which])

    def joined(self, *others: Matches) -> Matches:
        every = (self, *others)
        return Matches(*(np.concatenate([getattr(m, c) for m in every]) for c in ("query", "at", "left", "right", "size")))


class WordIndex:
    """Distinct words, delimited, in a bidirectional FM-index."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.symbols = codes.astype(np.int64) + 2
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.size = len(self.alphabet) + 2
        marks = self.offsets + np.arange(len(words))
        text = np.full(len(points) + len(words) + 1, MARK, dtype=np.int64)
        inner = np.ones(len(text), dtype=bool)
        inner[np.append(marks, len(text) - 1)] = False
        text[inner] = self.symbols
        self.leftwards = RankIndex(np.append(text, END), self.size)
        self.rightwards = RankIndex(np.append(text[::-1], END), self.size)
        self.word_at = np.full(len(text) + 1, -1, dtype=np.int64)
        self.word_at[marks] = np.arange(len(words))

    def one_edit(self, queries: np.ndarray, prefix: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): the indexed words one edit away whose first half (else: last half) is the query's.

        ``queries`` are numbers of indexed words; the first half is the shorter one.
        """
        length, offset = self.lengths[queries], self.offsets[queries]
        half = length // 2
        # The exact part is read outwards to its delimiter, the other part outwards to the other one.
        exact = half if prefix else length - half
        rest = length - exact
        back, ahead = (offset + half - 1, offset + half) if prefix else (offset + half, offset + half - 1)
        step = -1 if prefix else 1

        def symbol(start: np.ndarray, sign: int, size: np.ndarray, who: np.ndarray, at: np.ndarray) -> np.ndarray:
            inside = at < size[who]
            place = np.where(inside, start[who] + sign * at, 0)
            return np.where(inside, self.symbols[place], MARK) if len(self.symbols) else np.full(len(at), MARK)

        n = len(self.word_at)
        zero = np.zeros(len(queries), dtype=np.int64)
        now = Matches(np.arange(len(queries)), zero, zero, zero, np.full(len(queries), n, dtype=np.int64))
        ready = []
        t = 0
        while len(now.query):
            now = self._extended(now, symbol(back, step, exact, now.query, now.at), not prefix)
            whole = now.at > exact[now.query]
            ready.append(now.take(whole))
            now = now.take(~whole)
            t += 1
        front = ready[0].joined(*ready[1:]) if ready else now
        front.at[:] = 0
        none = front.take(np.zeros(0, dtype=np.int64))
        changed, out = none, []
        while len(front.query) or len(changed.query):
            if len(changed.query):
                changed = self._extended(changed, symbol(ahead, -step, rest, changed.query, changed.at), prefix)
                whole = changed.at > rest[changed.query]
                if whole.any():
                    ended = changed.take(whole)
                    out.append((ended.query, self.word_at[self.leftwards.order[ended.left]]))
                    changed = changed.take(~whole)
            if len(front.query):
                left = front.at < rest[front.query]
                own = symbol(ahead, -step, rest, front.query, front.at)
                after = symbol(ahead, -step, rest, front.query, front.at + 1)
                children, parent, letter = self._children(front, prefix)
                other = letter != own[parent]
                replaced = children.take(other & left[parent])
                replaced.at += 1
                inserted = children.take(other)  # before an equal letter is the same as behind it
                deleted = front.take(left & (own != after))
                deleted.at = deleted.at + 1
                changed = changed.joined(replaced, inserted, deleted)
                front = self._extended(front.take(left), own[left], prefix)
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pairs = np.unique(np.concatenate([q for q, _ in out]) * len(self.lengths) + np.concatenate([w for _, w in out]))
        who, word = pairs // len(self.lengths), pairs % len(self.lengths)
        if not prefix:
            # Words that have the first half too are found from there.
            keep = ~self._starts_alike(queries[who], word, half[who])
            who, word = who[keep], word[keep]
        return queries[who], word

    def _starts_alike(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        alike = self.lengths[b] >= size
        t = 0
        while len(open_ := np.flatnonzero(alike & (size > t))):
            alike[open_] = self.symbols[self.offsets[a[open_]] + t] == self.symbols[self.offsets[b[open_]] + t]
            t += 1
        return alike

    def _extended(self, m: Matches, symbol: np.ndarray, rightwards: bool) -> Matches:
        """The matches that go on with ``symbol``."""
        if rightwards:
            right, size, less = self.rightwards.extend(symbol, m.right, m.size)
            out = Matches(m.query, m.at + 1, m.left + less, right, size)
        else:
            left, size, less = self.leftwards.extend(symbol, m.left, m.size)
            out = Matches(m.query, m.at + 1, left, m.right + less, size)
        return out.take(size > 0)

    def _children(self, m: Matches, rightwards: bool) -> tuple[Matches, np.ndarray, np.ndarray]:
        """The matches with every letter that goes on, which match each comes from, and the letter."""
        index, low = (self.rightwards, m.right) if rightwards else (self.leftwards, m.left)
        narrow = np.flatnonzero(m.size <= self.size)
        wide = np.flatnonzero(m.size > self.size)
        # Few rows: look at the symbol of each. Many: ask for every letter.
        size = m.size[narrow]
        rows = np.repeat(low[narrow] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key, first, count = np.unique(np.repeat(narrow, size) * self.size + index.transform[rows], return_index=True, return_counts=True)
        parent, letter = key // self.size, key % self.size
        begins = np.searchsorted(parent, parent)  # the first child of the same match
        less = np.cumsum(count) - count
        less = less - less[begins] if len(less) else less
        near, far = index.longer[rows[first]], (m.left if rightwards else m.right)[parent] + less
        if len(wide):
            every = np.arange(2, self.size)
            who, what = np.repeat(wide, len(every)), np.tile(every, len(wide))
            at, n, below = index.extend(what, low[who], m.size[who])
            there = n > 0
            parent, letter = np.append(parent, who[there]), np.append(letter, what[there])
            near, count = np.append(near, at[there]), np.append(count, n[there])
            far = np.append(far, ((m.left if rightwards else m.right)[who] + below)[there])
        is_letter = letter >= 2
        parent, letter, near, far, count = (x[is_letter] for x in (parent, letter, near, far, count))
        left, right = (far, near) if rightwards else (near, far)
        return Matches(m.query[parent], m.at[parent].copy(), left, right, count), parent, letter


def shard_pairs(table):
    """(word, near, near_n) of the dealt rows (half, word, n, query, indexed) of one shard.

    A pair comes out where both words were dealt by the half that they share, so it comes out once.
    """
    import pyarrow as pa

    words = table.column("word").to_pylist()
    numbers: dict[str, int] = {}
    number = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    halves: dict[str, int] = {}
    half = np.array([halves.setdefault(h, len(halves)) for h in table.column("half").to_pylist()], dtype=np.int64)
    indexed, query = (table.column(c).to_numpy() for c in ("indexed", "query"))
    counts = np.zeros(len(numbers), dtype=np.int64)
    counts[number] = table.column("n").to_numpy()
    of = np.array([h[0] == "<" for h in halves], dtype=bool)
    index = WordIndex(list(numbers))
    there = half[indexed] * len(numbers) + number[indexed]
    a, b = [], []
    for prefix in (True, False):
        asked = query & (of[half] == prefix)
        own_half = np.zeros(len(numbers), dtype=np.int64)
        own_half[number[asked]] = half[asked]
        found, near = index.one_edit(np.unique(number[asked]), prefix)
        together = np.isin(own_half[found] * len(numbers) + near, there)
        a.append(found[together])
        b.append(near[together])
    a, b = np.concatenate(a), np.concatenate(b)
    names = pa.array(list(numbers))
    return pa.table({"word": names.take(pa.array(a)), "near": names.take(pa.array(b)), "near_n": pa.array(counts[b])})


def dealt_halves(counts: DataFrame) -> DataFrame:
    """(half, word, n, query): every half by which a word is looked up or found.

    A query of m letters is cut behind m / 2 letters (rounded down); words of one letter less or more
    are dealt by the same cuts. ``query`` marks the two halves of the word itself.
    """
    around = "sequence(greatest(length(word) - 1, 1), length(word) + 1)"
    halves = F.expr(
        f"concat(transform(array_distinct(transform({around}, m -> m div 2)), k -> struct(concat('<', left(word, int(k))) AS half, "
        f"k = length(word) div 2 AS query)), "
        f"transform(array_distinct(transform({around}, m -> m - m div 2)), k -> struct(concat('>', right(word, int(k))) AS half, "
        f"k = length(word) - length(word) div 2 AS query)))"
    )
    return counts.select("word", "n", F.explode(halves).alias("_h")).select("_h.half", "word", "n", "_h.query")


def near_words(counts: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``counts`` (staged: word, n) one edit apart."""
    spark = counts.sparkSession
    ship_package(spark)
    dealt = dealt_halves(counts)
    sizes = dealt.groupBy("half").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > HALF_ROWS)
    crowded = staged(sizes.withColumn("parts", F.ceil(F.col("rows") / HALF_ROWS).cast("int")), "crowded-halves")
    # Words of a crowded half are indexed in one part of it each and searched for in all.
    part = F.expr("explode(sequence(0, coalesce(parts, 1) - 1))")
    own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))) == F.col("part")
    spread = dealt.join(crowded.select("half", "parts"), "half", "left").select("half", "word", "n", "query", "parts", part.alias("part"))
    spread = spread.withColumn("indexed", own).where("indexed OR query")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + 4 * counts.count() // SHARD_ROWS)
    shard = F.pmod(F.xxhash64("half", "part"), F.lit(shards))
    return (
        spread.select(shard.alias("shard"), "half", "word", "n", "query", "indexed")
        .groupBy("shard")
        .applyInArrow(lambda t: shard_pairs(t), "word string, near string, near_n long")
    )


def variants(counts: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``counts`` (word string, n long).

    ``n_near``: words one inserted, deleted or replaced character away. ``form``: of those the most
    frequent (ties: smallest by code points), if at least twice as frequent, with its count in ``form_n``;
    else null. ``root``: where following the forms ends, the word itself if it has none. Counts of
    repeated words add up; null and empty words and rows without a count take no part; an empty table
    gives an empty one; other columns of ``counts`` are not kept.
    """
    usable = counts.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    counts = staged(usable, "word-counts")
    pairs = near_words(counts)
    # One exchange: the word's own count and its near words meet in one aggregation.
    none = F.lit(None)
    rows = counts.select("word", "n", none.cast("string").alias("near"), none.cast("long").alias("near_n")).unionByName(
        pairs.select("word", none.cast("long").alias("n"), "near", "near_n")
    )
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("best")
    decided = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    is_form = -F.col("best.less") >= 2 * F.col("n")
    formed = staged(
        decided.select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n", "n_near", F.when(is_form, -F.col("best.less")).alias("form_n")
        ),
        "word-forms",
    )
    ends = roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    joined = formed.join(ends.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the chain of each word ends, by joining links to links (twice as far each round).

    A form is at least twice as frequent as its word, so chains are short and have no cycle.
    """
    links = staged(links, "word-roots")
    while True:
        onward = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        longer = links.join(onward, F.col("root") == F.col("_word"), "left")
        if longer.where("_word IS NOT NULL").isEmpty():
            return links
        links = staged(longer.select("word", F.coalesce("_root", "root").alias("root")), "word-roots")


def letter_runs(text: Column) -> Column:
    """Runs of letters of a text, A-Z lower-cased (null text: none)."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(LETTERS), F.lit(0))


def changed_word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): words of all texts of which some have lost a character, that are long and frequent enough.

    A run whose checksum with its document's id is divisible by 97 loses one character. Runs of a
    null doc_id stay as they are; repeated rows count each for themselves.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(letter_runs(F.col("text"))).alias("run"))
    checked = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    lost = "concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
    word = F.when(F.col("h") % CHANGED_EVERY == 0, F.expr(lost)).otherwise(F.col("run"))
    counted = checked.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)
