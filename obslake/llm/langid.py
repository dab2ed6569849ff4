"""Language identification with bit-sliced Bloom filters of language bitmasks.

One filter holds all languages: slot i is a mask with bit l set when some n-gram of
language l hashes to i. The masks of an n-gram's slots, ANDed, give all languages that
contain it at once. Every n-gram of every text is in this plane. In a large corpus most
languages contain most n-grams once, so further planes of the same make hold the n-grams
with a least share of their language. A text's n-grams are counted per language and plane
(popcount of its bit), each count is corrected by the slice's false positive rate, and the
largest mean over the planes decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import batch_slices
from obslake.llm.hashing import mix
from obslake.session import ship_package

#: Letters of an n-gram (words are set apart by one space).
GRAM = 4
#: Slots of the filter, whatever the corpus: more n-grams only raise the false positive rates that the
#: counts are corrected for.
SLOTS = 1 << 22
#: Planes of the filter: least share of its language's n-grams that an n-gram of the plane has. The
#: first holds all.
SHARES = (0.0, 2e-5, 2e-4)
HASHES = 4
#: Most languages (distinct values of lang): with SLOTS it bounds the filter to 200 MB.
MOST_LANGUAGES = 128
UNDETERMINED = "und"
#: Characters handled at a time.
SLICE_CHARS = 1 << 20

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_LETTERS: list = []


def _letters() -> np.ndarray:
    """For every code point: is it a letter?"""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of every n-gram of lower-cased letters, and per text whether it has a letter.

    Anything but letters becomes one space between words; a text is padded so that a single
    letter gives an n-gram.
    """
    pad = " " * (GRAM - 2)
    lowered = [f"{pad}{t.lower()} " for t in texts]
    lengths = np.array([len(t) for t in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(texts)), lengths)
    letter = _letters()[points]
    starts = np.cumsum(lengths) - lengths
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character behind a word stands for the gap
    for k in range(len(pad)):
        keep[starts + k] = True
    has_letter = np.zeros(len(texts), dtype=bool)
    has_letter[rows[letter]] = True
    points = np.where(letter, points, 32)[keep].astype(np.uint64)
    rows = rows[keep]
    total = _windows(points)
    whole = rows[: len(total)] == rows[GRAM - 1 :] if len(total) else np.zeros(0, dtype=bool)
    return rows[: len(total)][whole], total[whole], has_letter


def _windows(points: np.ndarray) -> np.ndarray:
    """Hash of every GRAM neighbouring code points."""
    n = max(0, len(points) - GRAM + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        total = mix(total + points[k : k + n])
    return total


def long_gram_hashes(text: str, most: int = SLICE_CHARS) -> Iterator[tuple[np.ndarray, bool]]:
    """The hashes that ``gram_hashes`` gives for one text, stretch by stretch of ``most``
    characters, and whether the stretch has a letter: memory follows the stretch."""
    lowered = f"{text.lower()} "
    carry, inside = np.full(GRAM - 2, 32, dtype=np.uint64), False
    for lo in range(0, len(lowered), most):
        points = np.frombuffer(lowered[lo : lo + most].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= inside
        inside = bool(letter[-1])
        points = np.concatenate([carry, np.where(letter, points, 32)[keep].astype(np.uint64)])
        carry = points[-(GRAM - 1) :]  # the n-grams of the next stretch begin here
        yield _windows(points), bool(letter.any())


def _parts(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``gram_hashes`` of all texts together, but for those over ``most`` characters, which come in stretches."""
    long = [i for i, t in enumerate(texts) if len(t) > most]
    yield gram_hashes([t if len(t) <= most else "" for t in texts])
    for i in long:
        for hashes, letter in long_gram_hashes(texts[i], most):
            yield np.full(len(hashes), i), hashes, np.arange(len(texts)) == (i if letter else -1)


def slots_of(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    """The HASHES slots (of a power of two) of each n-gram."""
    return [((hashes * m) >> np.uint64(20)) & np.uint64(slots - 1) for m in _MULTIPLIERS[:HASHES]]


@dataclass
class LanguageFilter:
    """The learned filter: ``masks`` has a row per slot, with the words (64 languages each) of every plane."""

    languages: list[str]
    masks: np.ndarray
    common: int = 0
    #: By language and plane.
    false_positive: np.ndarray = field(default_factory=lambda: np.zeros((0, len(SHARES))))

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """Bitmask words of the languages that contain each n-gram, plane by plane (the first: at all)."""
        found = None
        for slots in slots_of(hashes, len(self.masks)):
            masks = self.masks[slots]
            found = masks if found is None else found & masks
        return found

    def identify(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; ``und`` and 0 for a text without a letter."""
        total, has_letter = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        counts = np.zeros((len(self.languages), len(texts)))
        if not self.languages:
            return [UNDETERMINED] * len(texts), total
        rate = self.false_positive
        scale = 1 / np.maximum(1e-9, 1 - rate) / len(SHARES)
        for rows, hashes, letter in _parts(texts):
            total += np.bincount(rows, minlength=len(texts))
            has_letter |= letter
            found = self.languages_of(hashes)
            width, words = found.dtype.itemsize * 8, found.shape[1] // len(SHARES)
            for i in range(len(self.languages)):
                weight = np.zeros(len(hashes))
                for plane in range(len(SHARES)):
                    bit = (found[:, plane * words + i // width] >> found.dtype.type(i % width)) & found.dtype.type(1)
                    weight += bit * scale[i, plane]
                counts[i] += np.bincount(rows, weights=weight, minlength=len(texts))
        # The mean over the planes of (count - rate * total) / (1 - rate).
        corrected = np.maximum(0.0, counts - (rate * scale).sum(axis=1)[:, None] * total)
        best = np.argmax(corrected, axis=0)  # ties: the first by code point
        top = corrected[best, np.arange(len(texts))]
        best = np.where(top > 0, best, self.common)
        score = np.where(has_letter & (total > 0), np.clip(top / np.maximum(total, 1), 0, 1), 0.0)
        return [self.languages[b] if k else UNDETERMINED for b, k in zip(best, has_letter, strict=True)], score


def held_out(doc_id: Column) -> Column:
    """Is the document in the held-out fold? (crc32 of the id as text, mod 3, is 1; null id: no)"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts of ``docs`` (lang, text): combined in tasks, then by shuffle."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            sizes = texts.to_pandas().str.len().to_numpy() if len(texts) else []
            by_lang: dict[str, list] = {}
            for lo, hi in batch_slices(sizes, SLICE_CHARS):
                names = np.array(langs[lo:hi], dtype=object)
                for rows, hashes, _ in _parts(texts.slice(lo, hi - lo).to_pylist()):
                    for lang in set(langs[lo:hi]):
                        by_lang.setdefault(lang, []).append(np.unique(hashes[(names == lang)[rows]], return_counts=True))
            for lang, parts in by_lang.items():
                grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([c for _, c in parts]), minlength=len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slot_masks(counts: DataFrame, totals: dict[str, int], slots: int, width: int) -> DataFrame:
    """(slot, word, mask) of the filter of all n-grams of ``counts``: at most ``slots`` rows for each word
    (``width`` languages of one plane). ``totals``: n-grams of each language."""
    languages = sorted(totals)
    words = -(-len(languages) // width)
    number = {lang: i for i, lang in enumerate(languages)}
    sums = np.array([totals[lang] for lang in languages], dtype=np.float64)

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names = batch.column(0).dictionary_encode()
            own = np.array([number[x] for x in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()]
            grams, n = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            for plane, least in enumerate(SHARES):
                keep = n >= least * sums[own]
                mask, word = np.int64(1) << (own[keep] % width), plane * words + own[keep] // width
                for at in slots_of(grams[keep], slots):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at.astype(np.int64)), pa.array(word), pa.array(mask)], names=["slot", "word", "mask"]
                    )

    rows = counts.select("lang", "gram", "n").mapInArrow(place, "slot long, word long, mask long")
    return rows.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))


def learn(docs: DataFrame, slots: int = SLOTS) -> LanguageFilter:
    """Filter of all n-grams of the texts of each language, with its planes.

    Learns from ``text`` and non-null ``lang`` of every row of ``docs``. The driver receives one
    row a language and at most ``slots`` masks a plane for every 64 languages, whatever the
    corpus; over MOST_LANGUAGES values of ``lang`` are an error.
    """
    from obslake.llm.common import staged

    counts = staged(gram_counts(docs.where("lang IS NOT NULL")), "grams")
    found = counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang")
    totals = {r["lang"]: r["n"] for r in found}
    languages = sorted(totals)
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), dtype=np.uint8))
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    width = np.dtype(kind).itemsize * 8
    words = -(-len(languages) // width)
    masks = np.zeros((slots, words * len(SHARES)), dtype=kind)
    rows = slot_masks(counts, totals, slots, width).toArrow()
    at, word, mask = (rows.column(c).to_numpy() for c in ("slot", "word", "mask"))
    masks[at, word] = mask.view(np.uint64).astype(kind)
    rates = np.zeros((len(languages), len(SHARES)))
    for i in range(len(languages)):
        for plane in range(len(SHARES)):
            rates[i, plane] = np.mean((masks[:, plane * words + i // width] >> kind(i % width)) & kind(1)) ** HASHES
    common = max(range(len(languages)), key=lambda i: totals[languages[i]])
    return LanguageFilter(languages, masks, common, rates)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with lang_pred and score.

    One row per row of ``docs``. Null texts and texts without a letter: ``und`` and score 0. A
    text none of whose n-grams is known gets the language with most training n-grams and
    score 0. Columns of ``docs`` named like the results are replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    shared = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.num_columns - 1).fill_null("")
            sizes = texts.to_pandas().str.len().to_numpy() if len(texts) else []
            names, scores = [], []
            for lo, hi in batch_slices(sizes, SLICE_CHARS):
                found, score = shared.value.identify(texts.slice(lo, hi - lo).to_pylist())
                names += found
                scores.append(score)
            scores = np.concatenate(scores) if scores else np.zeros(0)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"]
            )

    source = docs.select(*kept, F.col(text).cast("string").alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]] + ["lang_pred string, score double"])
    return source.mapInArrow(apply, schema)
