"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows of a 0/1 incidence matrix over word n-grams. Equal rows are one class.
Columns that one row alone has add nothing to the product; a row left with fewer columns
than the least overlap its size allows is out. Of the rest only the rarest columns (as many
as the size bound asks for) propose pairs, and blocks of proposed pairs have their overlap
accumulated over all columns. Pairs below the bound given by their sizes are discarded.

What is wanted is which documents hang together, so a pair is only proposed while its
documents are not yet linked through others: first every row with one hub of its columns,
then across the components that remain apart. No link between different components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import numbered, released, staged
from obslake.llm.hashing import lower_ascii, mix, shingles, utf8, word_hashes, word_spans
from obslake.llm.repeats import shared_hashes

SHINGLE_WORDS = 5
#: Least similarity in hundredths: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Rounds in which every row is held against its best hub before all remaining pairs are.
HUB_ROUNDS = 3
#: Words of a parity sketch: bit i is the parity of the live columns that fall on it.
SKETCH = ("s0", "s1", "s2", "s3")
DOC_SCHEMA = (
    "doc_id long, row_key long, n_shingles long, node long, weight double, n_live long, "
    "s0 long, s1 long, s2 long, s3 long, live binary, prefix binary"
)


def row_key() -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.col("text").cast("string")).alias("row_key")


def least_overlap(n: np.ndarray) -> np.ndarray:
    """Least intersection of a row of ``n`` with any row it may link to: ceil(PERCENT% of n)."""
    return -(-PERCENT * n // 100)


def incidence(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Staged rows (doc_id, row_key, n_shingles, node, weight, n_live, sketch words, live, prefix), one per row of ``docs``.

    ``node`` identifies the row's set; ``weight`` is how many rows a column of it is in, on average
    (a text that others are copied from has a larger one than its copies); ``live`` holds its columns that other rows have too
    (null when too few for any link), ``n_live`` how many, the sketch words the parity of those
    that fall on each bit, and ``prefix`` the rarest of them that must contain a common one,
    each with its place in the order of the row's live columns.
    """

    def extract(batch):
        import pyarrow as pa

        data, offsets = utf8(batch.column(2))
        data = lower_ascii(data)
        start, end, rows = word_spans(data, offsets)
        own, grams = shingles(word_hashes(data, start, end), rows, batch.num_rows, shingle_words)
        order = np.lexsort((grams, own))
        own, grams = own[order], grams[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (grams[1:] != grams[:-1])
        own, grams = own[new], grams[new]
        n = np.bincount(own, minlength=batch.num_rows)
        node = np.zeros(batch.num_rows, dtype=np.uint64)
        again = np.zeros(batch.num_rows, dtype=np.uint64)
        np.add.at(node, own, mix(grams))
        np.add.at(again, own, mix(grams ^ np.uint64(0x5851F42D4C957F2D)))
        node = mix(node + mix(again + n.astype(np.uint64)))
        kept = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node.view(np.int64))],
            names=["doc_id", "row_key", "n", "node"],
        )
        return kept, own, grams

    def finish(kept, rows, tokens, df):
        import pyarrow as pa

        n = kept.column("n").to_numpy()
        order = np.lexsort((tokens, df, rows))
        rows, tokens = rows[order], tokens[order]
        starts = np.searchsorted(rows, np.arange(len(n) + 1))
        weight = np.bincount(rows, weights=df[order], minlength=len(n)) / np.maximum(n, 1)
        parity = np.zeros((len(n), 64 * len(SKETCH)), dtype=np.uint8)
        np.bitwise_xor.at(parity, (rows, (mix(tokens) % np.uint64(parity.shape[1])).astype(np.int64)), np.uint8(1))
        sketch = np.packbits(parity, axis=1, bitorder="little").view(np.int64)
        live, prefix = [], []
        for i, need in enumerate(least_overlap(n)):
            own = tokens[starts[i] : starts[i + 1]]
            if not len(own) or len(own) < need:
                live.append(None)
                prefix.append(None)
                continue
            alone = int(n[i]) - len(own)  # columns of this row only stand first in the order
            first = own[: int(n[i] - need + 1) - alone]
            prefix.append(np.stack([first, np.arange(len(first), dtype=np.uint64)], axis=1).tobytes())
            live.append(np.sort(own).tobytes())
        return pa.RecordBatch.from_arrays(
            [
                *kept.columns,
                pa.array(weight),
                pa.array(np.diff(starts), pa.int64()),
                *[pa.array(np.ascontiguousarray(word)) for word in sketch.T],
                pa.array(live, pa.binary()),
                pa.array(prefix, pa.binary()),
            ],
            names=["doc_id", "row_key", "n_shingles", "node", "weight", "n_live", *SKETCH, "live", "prefix"],
        )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(), F.col("text").cast("string").alias("text")
    )
    return shared_hashes(source, extract, finish, DOC_SCHEMA, "incidence")


def _postings(classes: DataFrame) -> DataFrame:
    """(token, node, weight, place) of every prefix column of every class."""

    def unpack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                pairs = [np.frombuffer(p, np.uint64).reshape(-1, 2) for p in part.column(2).to_pylist()]
                counts = [len(p) for p in pairs]
                flat = np.concatenate(pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat[:, 0].copy().view(np.int64)),
                        pa.array(np.repeat(part.column(0).to_numpy(), counts)),
                        pa.array(np.repeat(part.column(1).to_numpy(), counts)),
                        pa.array(flat[:, 1].copy().view(np.int64)),
                    ],
                    names=["token", "node", "weight", "place"],
                )

    return classes.select("node", "weight", "prefix").mapInArrow(unpack, "token long, node long, weight double, place long")


def _linked(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose overlap, accumulated over all live columns, reaches the bound."""

    def product(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                a, b, n_a, n_b = (part.column(i).to_numpy() for i in range(4))
                sides = []
                for column in (4, 5):
                    rows = [np.frombuffer(x, np.uint64) for x in part.column(column).to_pylist()]
                    sides.append((np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)))
                pair = np.concatenate([sides[0][0], sides[1][0]])
                token = np.concatenate([sides[0][1], sides[1][1]])
                order = np.lexsort((token, pair))
                pair, token = pair[order], token[order]
                common = (pair[1:] == pair[:-1]) & (token[1:] == token[:-1])
                overlap = np.bincount(pair[1:][common], minlength=part.num_rows)
                keep = 100 * overlap >= PERCENT * (n_a + n_b - overlap)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    def side(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("live").alias(f"live_{name}"))

    # The size bound once more, before any column is fetched.
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    rows = both.select("a", "b", "n_a", "n_b", "live_a", "live_b")
    return rows.mapInArrow(product, "a long, b long")


def may_link() -> Column:
    """Whether two rows (columns ending in _a and _b) that share a column at place_a and place_b may link.

    Their overlap is bounded three times: by the shorter stretch of live columns before and
    behind the shared one (columns of one row only overlap nothing), and by the live columns in
    which they differ, of which there are at least as many as differing bits of the sketches.
    Every bound holds for all pairs, so no link is lost.
    """
    a, b = ({c: F.col(f"{c}_{x}") for c in ("place", "n", "n_live", *SKETCH)} for x in "ab")
    stretches = F.least(a["place"], b["place"]) + F.least(a["n_live"] - a["place"], b["n_live"] - b["place"])
    differ = sum((F.bit_count(a[w].bitwiseXOR(b[w])) for w in SKETCH), F.lit(0))
    need = PERCENT * (a["n"] + b["n"])
    return ((100 + PERCENT) * stretches >= need) & ((100 + PERCENT) * (a["n_live"] + b["n_live"] - differ) >= 2 * need)


def connected(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Staged (node, component, old) of every node of ``edges`` (a, b); a component is its smallest node.

    Labels move to the smallest of the neighbours and then to their label's label; each round
    is written to the shared folder, and rounds end when no label changes.
    """
    both = staged(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{purpose}-edges"
    )
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), purpose)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component").hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near")
        )
        stepped = (
            labels.select("node", "component")
            .join(near.hint("merge"), "node")
            .select("node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        )
        far = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        stepped = staged(
            stepped.join(far.hint("merge"), "component", "left").select(
                "node", F.least("component", F.coalesce("far", "component")).alias("component"), "old"
            ),
            purpose,
        )
        released(labels)
        labels = stepped
        if stepped.where("component <> old").isEmpty():
            released(both)
            return labels


def _with_component(postings: DataFrame, labels: DataFrame) -> DataFrame:
    joined = postings.join(labels.select("node", "component").hint("merge"), "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def _apart(postings: DataFrame) -> DataFrame:
    """Postings of the columns whose rows lie in two or more components."""
    open_ = postings.groupBy("token").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b")
    return postings.join(open_.select("token").hint("merge"), "token", "left_semi")


def components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, row_key, component) of every row of ``docs``.

    ``component`` labels the rows that hang together (null: linked with none). ``component_id`` is the smallest doc_id reachable by links (a row's own included; null ids
    count only when there is no other); ``n_copies`` the rows with the same set. Rows without
    a word, null or empty texts: no shingle, linked with nothing. Repeated rows are copies of
    each other. Other columns of ``docs`` are ignored.
    """
    matrix = incidence(docs, shingle_words)
    rows = staged(matrix.select("doc_id", "row_key", "n_shingles", "node"), "rows")
    classes = staged(
        matrix.where("live IS NOT NULL")
        .groupBy("node")
        .agg(
            F.first("n_shingles").alias("n"),
            *[F.first(c).alias(c) for c in ("n_live", *SKETCH)],
            F.max("weight").alias("weight"),
            F.first("live").alias("live"),
            F.first("prefix").alias("prefix"),
            F.min("doc_id").alias("first_doc"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    released(matrix)
    unpacked = _postings(classes)
    several = unpacked.groupBy("token").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).where("_a <> _b")
    postings = staged(unpacked.join(several.select("token").hint("merge"), "token", "left_semi"), "postings")

    # First every row with the best hub among its columns, one pair a row: copies of one text differ
    # from each other more than from that text. Then once more across components.
    edges, tried, open_ = None, [], postings
    for _ in range(HUB_ROUNDS):
        apart = open_ if tried else postings.withColumn("component", F.col("node"))
        hubs = apart.groupBy("token").agg(F.max(F.struct("weight", "node", "component")).alias("hub"))
        pairs = staged(
            apart.join(hubs.hint("merge"), "token")
            .where("component <> hub.component")
            .groupBy("node")
            .agg(F.max("hub").alias("hub"))
            .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
            .distinct(),
            "pairs",
        )
        tried.append(pairs)
        found = _linked(pairs, classes)
        links = staged(found if edges is None else edges.union(found), "links")
        labels = connected(links)
        rest = staged(_apart(_with_component(apart.drop("component"), labels)), "apart")
        released(labels, open_, *([] if edges is None else [edges]))
        edges, open_ = links, rest
    # Last, what is still apart: all pairs across components that may link.
    bounds = ("n", "n_live", *SKETCH)
    apart = staged(open_.drop("weight").join(classes.select("node", *bounds).hint("merge"), "node"), "apart")
    released(open_)
    most = (
        apart.groupBy("token", "component").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("token").agg(F.max(F.struct("_n", "component")).alias("_m"))
        .select("token", F.col("_m.component").alias("largest"))
    )
    minor = apart.join(most.hint("merge"), "token").where("component <> largest")
    columns = ("node", "place", "component", *bounds)
    left = minor.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = apart.select("token", *[F.col(c).alias(f"{c}_b") for c in columns])
    across = (
        left.join(right.hint("merge"), "token")
        .where("component_a <> component_b")
        .where(may_link())
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
        .join(reduce(DataFrame.union, tried).hint("merge"), ["a", "b"], "left_anti")
    )
    links = staged(edges.union(_linked(across, classes)), "links")
    released(apart, edges, *tried)
    labels = connected(links)

    grouped = classes.select("node", "first_doc", "copies").join(labels.select("node", "component").hint("merge"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = grouped.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    per_node = grouped.join(smallest.hint("merge"), "component").select("node", "component", "component_id", "copies")
    result = rows.join(per_node.hint("merge"), "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("copies", F.lit(1)).alias("n_copies"),
        "row_key", "component",
    )
    result = staged(result, "result")
    released(rows, classes, links, labels)
    return result


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does: that with the smallest
    doc_id (null last, then by text). Of rows with equal doc_id and text one stays, also
    where the text has no word. Other columns keep their values, whatever their names."""
    found = components(docs).select("doc_id", "row_key", "component")
    alone = found.where("component IS NULL").select("doc_id", "row_key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.row_key")
    stay = alone.union(first).distinct().select(F.col("doc_id").alias("stay_id"), F.col("row_key").alias("stay_key"))
    plain, col = numbered(docs)
    keyed = plain.withColumns({"id": col("doc_id").cast("long"), "key": F.xxhash64(col("text").cast("string"))})
    same = (F.col("key") == F.col("stay_key")) & F.col("id").eqNullSafe(F.col("stay_id"))
    one = keyed.join(stay.hint("merge"), same, "left_semi").dropDuplicates(["id", "key"])
    return one.drop("id", "key").toDF(*docs.columns)
