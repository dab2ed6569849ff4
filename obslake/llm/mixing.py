"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents are shuffled and laid end to end; the line of its words is cut into
equal blocks. Slots are numbered 0, 1, 2, ...; slot i takes the point frac((i + 1) * golden
ratio), which falls into one source's interval of the cumulative weights. The k-th slot of
a source takes its block k, from the start again when the blocks are used up. Any stretch
of the schedule therefore holds the sources close to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from obslake.llm.common import numbered, staged, words
from obslake.session import ship_package

GOLDEN = 0.6180339887498949
#: Words of a block, and the least number of blocks of a source that has as many words.
BLOCK_WORDS = 256
LEAST_BLOCKS = 512
#: Documents of one shuffle bucket of a source, on average.
BUCKET_DOCS = 1_000
#: Slots that one task maps to sources at a time.
SLOTS_AT_ONCE = 1 << 16
SHARE = 1.5
MOST_REPEATS = 2
WEIGHTS = (3, 1, 2)


def source_targets(sizes: list[tuple[str | None, int]], share: float = SHARE) -> dict[str | None, float]:
    """Target words of each source: weights 3, 1, 2 repeating by code point order (null last),
    ``share`` of all words between them, none above twice its own words; what a capped source
    leaves is shared again by weight."""
    ordered = sorted((s for s, _ in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    ordered += [None] if any(s is None for s, _ in sizes) else []
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(ordered)}
    size = dict(sizes)
    left, target, open_ = share * sum(size.values()), {}, list(ordered)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > MOST_REPEATS * size[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = float(MOST_REPEATS * size[s])
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


def slot_counts(spark: SparkSession, needs: list[float], purpose: str = "slots") -> DataFrame:
    """The schedule: (slot, source_no, rank) for sources with real-valued ``needs`` of slots.

    Two passes over the slot numbers, both in parallel ranges: the first counts the slots of
    each source in each range, the second ranks them from the running sums. Per range and
    source one row is gathered, never one per slot.
    """
    slots = int(round(sum(needs)))
    edges = np.cumsum(np.asarray(needs, dtype=np.float64))
    edges = edges / edges[-1] if len(edges) and edges[-1] > 0 else edges
    ranges = max(1, -(-slots // SLOTS_AT_ONCE))

    def source_of(lo: int, hi: int):
        # The fractional part from integer arithmetic: exact for any slot number.
        step = np.uint64(11400714819323198485)
        with np.errstate(over="ignore"):
            points = (np.arange(lo + 1, hi + 1, dtype=np.uint64) * step).astype(np.float64) / 2.0**64
        return np.minimum(np.searchsorted(edges, points, side="right"), len(edges) - 1)

    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for r in pdf["id"]:
                n = np.bincount(source_of(r * SLOTS_AT_ONCE, min(slots, (r + 1) * SLOTS_AT_ONCE)), minlength=len(edges))
                yield pd.DataFrame({"id": r, "source_no": np.arange(len(n)), "n": n})

    def rank(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for r, before in zip(pdf["id"], pdf["before"], strict=True):
                lo = r * SLOTS_AT_ONCE
                source = source_of(lo, min(slots, lo + SLOTS_AT_ONCE))
                order = np.argsort(source, kind="stable")
                ordered = source[order]
                first = np.searchsorted(ordered, ordered, side="left")
                base = np.zeros(len(edges), dtype=np.int64)
                for entry in before:
                    base[entry["source_no"]] = entry["before"]
                ranks = np.arange(len(ordered)) - first + base[ordered]
                yield pd.DataFrame({"slot": lo + order, "source_no": ordered, "rank": ranks})

    numbers = spark.range(0, ranges if slots else 0, 1, max(1, min(ranges, spark.sparkContext.defaultParallelism * 4)))
    counted = staged(numbers.mapInPandas(count, "id long, source_no long, n long"), f"{purpose}-counts")
    running = Window.partitionBy("source_no").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    per_range = before.groupBy("id").agg(F.collect_list(F.struct("source_no", "before")).alias("before"))
    return per_range.mapInPandas(rank, "slot long, source_no long, rank long")


def _order(columns: list[str]) -> Column:
    """A shuffled order that depends on nothing but the row."""
    return F.xxhash64(F.lit("mix"), *[F.col(c) for c in columns])


def mix(docs: DataFrame, text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and block of it that the schedule takes, and one (block null) for a
    document that gets none: the columns of ``docs`` with size, source_size, target, block,
    block_from and block_to (the span of the document's words in that block) and slots (the
    schedule's slots that take the block), order_key (the row's place in the shuffle) and line_from
    (the words before it on its source's line).

    Null or empty texts have size 0 and get no words; null sources are one source, last in
    order; a null doc_id is ordered like any value; repeated rows are documents of their own.
    An empty table gives an empty result. Of the corpus the driver gets one row per source
    (its words and documents). Clashing columns of ``docs`` are replaced by the results.
    """
    spark = docs.sparkSession
    own = ["size", "source_size", "target", "block", "block_from", "block_to", "slots", "order_key", "line_from"]
    docs = docs.drop(*own)
    plain, col = numbered(docs)
    sized = plain.withColumn("size", F.size(words(col(text))).cast("long"))
    light = sized.select("size", col(source).alias("_source"))
    totals = light.groupBy("_source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    target = source_targets([(r["_source"], r["size"]) for r in totals])
    plan = []
    for no, r in enumerate(sorted(totals, key=lambda r: (r["_source"] is None, r["_source"] or ""))):
        blocks = min(r["size"], max(-(-r["size"] // block_words), LEAST_BLOCKS))
        needed = target[r["_source"]] * blocks / r["size"] if r["size"] else 0.0
        buckets = 1 + r["docs"] // BUCKET_DOCS
        plan.append((r["_source"], no, r["size"], float(target[r["_source"]]), blocks, needed, buckets))
    # Written and read back, its size is known: Spark broadcasts it if it is under its threshold.
    sources = spark.createDataFrame(
        plan,
        f"_source {docs.schema[source].dataType.simpleString()}, source_no long, source_size long, "
        "target double, blocks long, needed double, buckets long",
    )
    sources = staged(sources, "source-targets")
    # The k-th slot of a source takes block k mod blocks; a block is taken twice at most.
    taken = (
        slot_counts(spark, [p[5] for p in plan])
        .join(sources.select("source_no", "blocks"), "source_no")
        .where(F.col("rank") < MOST_REPEATS * F.col("blocks"))
        .groupBy("source_no", (F.col("rank") % F.col("blocks")).alias("block"))
        .agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    )
    # Words before each document in its source's shuffled order: within a bucket of the order by a
    # window, before the bucket by the buckets' sums; a hot source spreads over many buckets.
    order = _order([c for c, t in plain.dtypes if not t.startswith("map")])
    placed = sized.join(sources, col(source).eqNullSafe(F.col("_source"))).withColumns(
        {"order_key": order, "_bucket": F.pmod(F.shiftrightunsigned(order, 20), F.col("buckets"))}
    )
    bucket_sums = placed.select("source_no", "_bucket", "size").groupBy("source_no", "_bucket").agg(F.sum("size").alias("_n"))
    above = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucket_sums.select(
        "source_no", "_bucket", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_bucket_start")
    )
    within = Window.partitionBy("source_no", "_bucket").orderBy("order_key", *[col(c) for c in docs.columns if c == "doc_id"])
    placed = (
        placed.withColumn("_end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(starts, ["source_no", "_bucket"])
        .withColumn("_from", F.col("_bucket_start") + F.col("_end") - F.col("size"))
        .withColumn("_to", F.col("_bucket_start") + F.col("_end"))
    )
    # Block b of a source holds its words from floor(b * size / blocks) to floor((b + 1) * size / blocks).
    spread = placed.withColumn(
        "block",
        F.expr(
            "explode_outer(CASE WHEN size > 0 THEN sequence("
            "((_from + 1) * blocks - 1) div source_size, (_to * blocks - 1) div source_size) END)"
        ),
    ).withColumns(
        {
            "block_from": F.expr("greatest(_from, block * source_size div blocks) - _from"),
            "block_to": F.expr("least(_to, (block + 1) * source_size div blocks) - _from"),
        }
    )
    spread = spread.withColumn("line_from", F.col("_from"))
    named = [col(c).alias(c) for c in docs.columns]
    return spread.join(taken, ["source_no", "block"], "left").select(*named, *own)


def taken_words() -> Column:
    """Words of a row of ``mix`` that the schedule takes, repeats counted."""
    return F.coalesce((F.col("block_to") - F.col("block_from")) * F.size("slots"), F.lit(0)).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each run of its words that the schedule takes,
    twice where it takes them twice. A whole document keeps its text; a part has its words
    joined by one space, and ``n_chars`` (if there) follows the text. Documents of which
    nothing is taken, or without words, are left out."""
    ship_package(docs.sparkSession)
    plain, col = numbered(docs)
    keyed = plain.withColumn("row_key", F.xxhash64(col("text").cast("string")))
    light = mix(keyed.select(col("doc_id").alias("doc_id"), col("source").alias("source"), "row_key", col("text").alias("text")))
    span = F.struct("line_from", "block_from", "block_to", F.size("slots").alias("times"), "size")
    taken = (
        light.where("slots IS NOT NULL")
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_list(span)).alias("spans"))
        .select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "spans")
    )
    same = (F.col("row_key") == F.col("key")) & col("doc_id").eqNullSafe(F.col("id"))
    # Repeated rows share one entry, with the spans of each of them.
    once = keyed.withColumn("one", col("doc_id")).dropDuplicates(["one", "row_key"])
    joined = once.join(taken.hint("merge"), same).select(*plain.columns, "spans")
    names, at = docs.columns, docs.columns.index("text")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows, texts = [], []
                for i, (text, spans) in enumerate(zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist(), strict=True)):
                    words = None
                    for start, end, size in _runs(spans):
                        if end - start < size:
                            words = text.encode().split() if words is None else words
                            texts.append(b" ".join(words[start:end]).decode())
                        else:
                            texts.append(text)
                        rows.append(i)
                columns = [c.take(pa.array(rows, pa.int64())) for c in part.columns[: len(names)]]
                columns[at] = pa.array(texts, pa.string())
                if "n_chars" in names:
                    columns[names.index("n_chars")] = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [StructField(f.name, LongType() if f.name == "n_chars" else f.dataType) for f in docs.schema]
    return joined.mapInArrow(cut, StructType(kinds))


def _runs(spans: list[dict]) -> Iterator[tuple[int, int, int]]:
    """(from, to, size) of the runs of words taken at least once, then at least twice, of each row."""
    for line in sorted({s["line_from"] for s in spans}):
        for times in range(1, MOST_REPEATS + 1):
            start = end = None
            for s in spans:
                if s["line_from"] != line or s["times"] < times:
                    continue
                if end != s["block_from"]:
                    if start is not None:
                        yield start, end, size
                    start = s["block_from"]
                end, size = s["block_to"], s["size"]
            if start is not None:
                yield start, end, size
