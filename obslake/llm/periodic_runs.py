"""Periodic runs of words by recompression.

The words of a batch of texts become one integer sequence. Recompression shrinks it level by
level, in turns replacing every block of one symbol by (symbol, length) and every pair of a left and
a right symbol by a new one: a run-length grammar that derives equal stretches by equal symbols but
for their ends. A longest common extension walks up the levels and down again, one step a level.

A run of period p and exponent e or more holds a point of the grid of step (e - 1) * p whose word
comes again p words later. The grids of all periods have n * log(n) points; those whose word comes
again are extended to both sides by the grammar, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from obslake.llm.common import batch_slices
from obslake.llm.hashing import mix, utf8, word_spans
from obslake.session import ship_package

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Text bytes of one grammar (one text at least), and grid points looked at in one step.
SLICE_BYTES = 2 << 20
STEP_POINTS = 1 << 20

RUNS = ArrayType(StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")]), False)


class Grammar:
    """Levels of recompression of a sequence in which symbols below ``marks`` stand alone.

    ``symbols[l]`` is the sequence at level l; ``above[l]`` gives the place in level l + 1 of each
    of its symbols, ``first[l + 1]`` the first place in level l of each symbol of level l + 1 (and an
    end); ``blocks[l]`` says whether level l + 1 comes from blocks or from pairs.
    """

    def __init__(self, symbols: np.ndarray, marks: int):
        self.symbols, self.above, self.first, self.blocks = [symbols.astype(np.int32)], [], [None], []
        self._next, self._marks = int(symbols.max(initial=0)) + 1, marks
        turn = 0
        while True:
            now = self.symbols[-1]
            inner = now >= marks
            beside = inner[:-1] & inner[1:]
            if not beside.any():
                break  # one symbol between any two marks
            if (same := beside & (now[:-1] == now[1:])).any():
                self._blocks(now, same)
            else:
                self._pairs(now, beside, turn)
            turn += 1

    def _add(self, starts: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        place = np.zeros(len(self.symbols[-1]), dtype=np.int32)
        place[starts] = 1
        self.above.append(np.cumsum(place, dtype=np.int32) - 1)
        self.first.append(np.append(starts, len(place)).astype(np.int32))
        self.symbols.append(symbols.astype(np.int32))
        self.blocks.append(blocks)

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, equal for equal keys."""
        import pandas as pd

        codes, distinct = pd.factorize(keys)
        codes = codes + self._next
        self._next += len(distinct)
        return codes

    def _blocks(self, now: np.ndarray, same: np.ndarray) -> None:
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        lengths = np.diff(np.append(starts, len(now)))
        symbols = now[starts].astype(np.int64)
        long = lengths > 1
        symbols[long] = self._named(symbols[long] << np.int64(31) | lengths[long])
        self._add(starts, symbols, True)

    def _pairs(self, now: np.ndarray, beside: np.ndarray, turn: int) -> None:
        side = mix(now.astype(np.uint64) + (np.uint64(turn + 1) << np.uint64(33))) & np.uint64(1) == 1
        joined = beside & ~side[:-1] & side[1:]
        other = beside & side[:-1] & ~side[1:]
        if np.count_nonzero(other) > np.count_nonzero(joined):
            joined = other
        starts = np.flatnonzero(np.concatenate([[True], ~joined]))
        symbols = now[starts].astype(np.int64)
        left = np.append(joined, False)[starts]
        if left.any():
            symbols[left] = self._named(symbols[left] << np.int64(31) | now[starts[left] + 1])
            self._add(starts, symbols, False)

    def _step(self, level: int, a: np.ndarray, b: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
        """How far ``a`` and ``b`` go within their symbols of the next level, and whether they end together.

        ``back`` is 1 to read to the left (what stands before a place), else 0.
        """
        symbols = self.symbols[level]
        x, y = a - back, b - back
        equal = symbols[x] == symbols[y]
        if not self.blocks[level]:
            return equal.astype(np.int32), equal
        above, first = self.above[level], self.first[level + 1]
        if back:
            ra, rb = a - first[above[x]], b - first[above[y]]
        else:
            ra, rb = first[above[x] + 1] - a, first[above[y] + 1] - b
        return np.where(equal, np.minimum(ra, rb), 0), equal & (ra == rb)

    def extension(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of what is common from ``a`` on and from ``b`` on (``back``: up to before both).

        The two places of a query differ and lie between the same two marks.
        """
        back, sign = int(back), -1 if back else 1
        at, a, b = a, a.astype(np.int32), b.astype(np.int32)
        query = np.arange(len(a))
        stopped: list[tuple] = []
        top = len(self.above)
        for level in range(top):
            # Both at the start of a symbol of the next level: compare there. Else go on to it.
            above, first = self.above[level], self.first[level + 1]
            whole = (first[above[a]] == a) & (first[above[b]] == b)
            inside = np.flatnonzero(~whole)
            ends = np.zeros(0, dtype=np.int64)
            if len(inside):
                far, together = self._step(level, a[inside], b[inside], back)
                a[inside] += sign * far
                b[inside] += sign * far
                ends = inside[~together]
            stopped.append((query[ends], a[ends], b[ends]))
            if len(ends):
                stay = np.ones(len(a), dtype=bool)
                stay[ends] = False
                query, a, b = query[stay], a[stay], b[stay]
            a, b = above[a], above[b]
        # At a level where they stopped the next symbols differ; below, these have a common part.
        for level in range(top - 1, -1, -1):
            first = self.first[level + 1]
            a, b = first[a], first[b]
            if len(a):
                far, _ = self._step(level, a, b, back)
                a, b = a + sign * far, b + sign * far
            ended = stopped[level]
            query, a, b = (np.concatenate(x) for x in zip((query, a, b), ended, strict=True))
        out = np.empty(len(at), dtype=np.int64)
        out[query] = a
        return np.abs(out - at)


def word_symbols(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal bytes."""
    import pyarrow as pa

    if not len(start):
        return np.zeros(0, dtype=np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start] += 1
    inside[end] -= 1  # a word may begin where another row's ends
    packed = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def grid_points(lengths: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, word number) of the grids of all periods that a text has room for, in parts."""
    most = np.where(lengths >= min_length, lengths // min_exponent, 0)
    ends = np.cumsum(most)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, STEP_POINTS):
        number = np.arange(low, min(low + STEP_POINTS, total))
        text = np.searchsorted(ends, number, side="right")
        period = number - (ends - most)[text] + 1
        step = np.maximum(min_length, min_exponent * period) - period
        points = -(-(lengths[text] - period) // step)
        cuts = np.cumsum(points)
        at = 0
        while at < len(points):
            to = max(at + 1, int(np.searchsorted(cuts, (cuts[at - 1] if at else 0) + STEP_POINTS, side="right")))
            each = points[at:to]
            k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            yield np.repeat(text[at:to], each), np.repeat(period[at:to], each), k * np.repeat(step[at:to], each)
            at = to


def runs_of(words: np.ndarray, lengths: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run of every text, by text, start and period."""
    texts = len(lengths)
    before = np.cumsum(lengths) - lengths
    begin = before + np.arange(texts) + 1  # a mark stands before the first text and behind every text
    sequence = np.empty(len(words) + texts + 1, dtype=np.int64)
    mark = np.zeros(len(sequence), dtype=bool)
    mark[np.append(0, begin + lengths)] = True
    sequence[mark] = np.arange(texts + 1)
    sequence[~mark] = words + texts + 1
    grammar, found = None, []
    for text, period, at in grid_points(lengths, min_length, min_exponent):
        a = begin[text] + at
        again = np.flatnonzero(sequence[a] == sequence[a + period])
        if not len(again):
            continue
        grammar = grammar or Grammar(sequence, texts + 1)
        text, period, a = text[again], period[again], a[again]
        left, right = grammar.extension(a, a + period, back=True), grammar.extension(a, a + period)
        whole = np.flatnonzero(left + right + period >= np.maximum(min_length, min_exponent * period))
        found.append(np.stack([text, a - left - begin[text], left + right + period, period])[:, whole])
    runs = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    # A stretch is found by every multiple of its period that fits, and by each of its grid points.
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], dtype=bool)
    new[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    runs = runs[:, new]
    return tuple(runs[:, np.lexsort((runs[3], runs[1], runs[0]))])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed_text``.

    ``runs`` are (start, length, period) of every stretch of words with smallest period ``period``
    that no neighbouring word extends, of ``min_length`` words and ``min_exponent`` (two at least) periods
    or more, by start and period. ``collapsed_text`` has the words that no run contains after its first
    period, joined by one space.

    Whole texts, each for itself: null and empty texts have no words and no runs, repeated rows get
    equal results, an empty table gives an empty one, and columns named like the results are replaced.
    A text is one grammar of about 100 bytes a word.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    ship_package(docs.sparkSession)
    docs = docs.drop("n_words", "runs", "collapsed_text")
    own = [StructField("n_words", LongType(), False), StructField("runs", RUNS, False), StructField("collapsed_text", StringType(), False)]
    schema = StructType([*docs.schema.fields, *own])
    at = docs.columns.index("text")

    def found(batches: Iterator) -> Iterator:
        import pyarrow as pa

        entry = [pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]
        for batch in batches:
            sizes = np.diff(utf8(batch.column(at))[1])
            for lo, hi in batch_slices(sizes, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                data, offsets = utf8(part.column(at))
                start, end, rows = word_spans(data, offsets)
                lengths = np.bincount(rows, minlength=part.num_rows).astype(np.int64)
                text, first, length, period = runs_of(word_symbols(data, start, end), lengths, min_length, min_exponent)
                before = np.append(0, np.cumsum(lengths))
                change = np.zeros(len(start) + 1, dtype=np.int64)
                np.add.at(change, before[text] + first + period, 1)
                np.add.at(change, before[text] + first + length, -1)
                stays = np.cumsum(change)[:-1] == 0
                kept = []
                raw = data.tobytes()
                for i in range(part.num_rows):
                    words = raw[offsets[i] : offsets[i + 1]].split()
                    stay = stays[before[i] : before[i + 1]]
                    kept.append(b" ".join(words if stay.all() else [words[j] for j in np.flatnonzero(stay)]).decode())
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (first, length, period)], fields=entry)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lengths), pa.ListArray.from_arrays(pa.array(cuts), runs), pa.array(kept, pa.string())],
                    names=schema.names,
                )

    return docs.mapInArrow(found, schema)
