"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors lie in index blocks. A block holds, for every dimension, posting segments: the
vectors whose component falls into one quantised level. For a query, a segment's impact is
the least contribution of its level above the dimension's floor. Segments of all dimensions
are processed by descending impact into accumulators; processing stops only when the bound
on everything not yet processed proves that a few possible members remain, and these are
rescored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.session import ship_package

SCALE = 256
BLOCK_VECTORS = 8192
QUERY_VECTORS = 256
LEVELS = 12
#: Possible members (as a share of the block) at which processing may stop, and the segments between two looks.
MEMBERS_SHARE = 0.05
LOOK_EVERY = 48


def quantised(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, components): every component x as floor(scale * x), x as a double.

    Rows without an id or vector, and vectors with a null or non-finite component (or none at
    all), are left out.
    """
    doubles = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("_v")).where("vec_id IS NOT NULL")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return doubles.where((F.size("_v") > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(_v, x -> cast(floor({scale} * x) as bigint))").alias("components")
    )


class ImpactIndex:
    """Posting segments of one block of vectors."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        low, high = matrix.min(axis=0), matrix.max(axis=0)
        step = np.maximum(1, -(-(high - low + 1) // LEVELS))
        level = (matrix - low) // step
        dims, first, last, postings = [], [], [], []
        for d in range(matrix.shape[1]):
            order = np.argsort(level[:, d], kind="stable").astype(np.int32)
            cuts = np.flatnonzero(np.diff(level[order, d])) + 1
            for part in np.split(order, cuts):
                # Exact extremes of the segment: the quantised level's tightest bounds.
                values = matrix[part, d]
                dims.append(d)
                first.append(values.min())
                last.append(values.max())
                postings.append(part)
        self.dims, self.postings = np.array(dims), postings
        self.sizes = np.array([len(p) for p in postings], dtype=np.int64)
        self.first, self.last = np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)
        self.low, self.high = low, high

    def search(self, query: np.ndarray, query_id: int, k: int, at_least: int | None = None) -> list[tuple[int, int]]:
        """The ``k`` best (score, vec_id), ties to the smaller id, without the query's own id.

        ``at_least``: a score that ``k`` candidates of other blocks reach. Vectors that cannot reach it
        are left out, and a block none of whose segments add up to it is not processed.
        """
        n = len(self.ids)
        weight = query[self.dims]
        a, b = weight * self.first, weight * self.last
        least, most = np.minimum(a, b), np.maximum(a, b)
        floor = np.minimum(query * self.low, query * self.high)  # per dimension: the least contribution
        impact, reach = least - floor[self.dims], most - floor[self.dims]
        own = self.ids == query_id
        want = min(k, n - int(own.sum()))
        # Every vector lies within [gained, gained + bound]: a dimension either has the vector's segment
        # processed (then reach above impact is open) or still to come (then all of its reach).
        open_ = reach.copy()
        most_open = np.zeros(len(query), dtype=np.int64)
        np.maximum.at(most_open, self.dims, open_)
        needed = -1 if at_least is None else at_least - int(floor.sum())
        if want <= 0 or most_open.sum() < needed:
            return []
        order = np.argsort(-reach, kind="stable")
        gained = np.zeros(n, dtype=np.int64)
        members = np.flatnonzero(~own)
        for low in range(0, len(order), LOOK_EVERY):
            part = order[low : low + LOOK_EVERY]
            adding = part[impact[part] > 0]
            if len(adding):
                # Sums of whole numbers far below 2**53, so exact as doubles.
                each = np.repeat(impact[adding], self.sizes[adding])
                gained += np.bincount(np.concatenate([self.postings[s] for s in adding]), each, n).astype(np.int64)
            open_[part] -= impact[part]
            most_open[:] = 0
            np.maximum.at(most_open, self.dims, open_)
            bound = int(most_open.sum())
            reachable = gained[members]
            worst_kept = np.partition(reachable, len(reachable) - want)[len(reachable) - want] if len(reachable) >= want else 0
            members = members[reachable + bound >= max(worst_kept, needed)]
            if len(members) <= max(4 * k, MEMBERS_SHARE * n):
                break
        scores = self.matrix[members] @ query
        best = np.lexsort((self.ids[members], -scores))[:want]
        return [(int(scores[j]), int(self.ids[members[j]])) for j in best]


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Vectors in blocks of up to ``size`` of one dimension: (dim, ids, matrix)."""

    def block(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("dim", pa.int64()), ("ids", pa.binary()), ("matrix", pa.binary())])
        held: dict[int, list] = {}

        def out(dim: int):
            rows = held.pop(dim)
            ids = np.array([r[0] for r in rows], dtype=np.int64)
            matrix = np.array([r[1] for r in rows], dtype=np.int64)
            return pa.RecordBatch.from_pylist([{"dim": dim, "ids": ids.tobytes(), "matrix": matrix.tobytes()}], schema=schema)

        for batch in batches:
            for vec_id, components in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(len(components), []).append((vec_id, components))
                if len(held[len(components)]) >= size:
                    yield out(len(components))
        for dim in list(held):
            yield out(dim)

    return vectors.mapInArrow(block, "dim long, ids binary, matrix binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` for each of ``queries``.

    Both come from ``quantised``. Only vectors of a query's own dimension are compared, and
    never a row with the query's id. Repeated rows with another id are ranked like any; fewer
    than ``k`` candidates give fewer rows; empty tables give none. Repeated rows of ``queries``
    are one query; rows with one id and other components are queries of their own, each with
    ranks from 1.

    Blocks of the index are dealt to as many groups as there are shuffle partitions, and each
    group gets every block of queries once: a stated query set against all rows, block by
    block. Each pair of blocks leaves ``k`` rows a query for the final ranking.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = _blocks(vectors, BLOCK_VECTORS).withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    asked = _blocks(queries.select("vec_id", "components").distinct(), QUERY_VECTORS).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")
    )
    asked = asked.withColumn("slot", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    pairs = index.join(asked.hint("merge"), "slot").where("dim = q_dim").select("dim", "ids", "matrix", "q_ids", "q_matrix")

    def search(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        schema = pa.schema([("query_id", pa.int64()), ("query_digest", pa.binary()), ("vec_id", pa.int64()), ("score", pa.int64())])
        known: tuple = (None, None)
        reached: dict[tuple, list[int]] = {}  # per query the best scores of the blocks so far
        for batch in batches:
            for dim, ids, matrix, q_ids, q_matrix in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if known[0] != ids:
                    known = (ids, ImpactIndex(np.frombuffer(ids, np.int64), np.frombuffer(matrix, np.int64).reshape(-1, dim)))
                found = []
                for query_id, query in zip(np.frombuffer(q_ids, np.int64), np.frombuffer(q_matrix, np.int64).reshape(-1, dim), strict=True):
                    digest = hashlib.blake2b(query.tobytes(), digest_size=16).digest()
                    scores = reached.setdefault((int(query_id), digest), [])
                    best = known[1].search(query, query_id, k, scores[k - 1] if len(scores) >= k else None)
                    scores[:] = sorted([*scores, *[score for score, _ in best]], reverse=True)[:k]
                    found += [(int(query_id), digest, vec_id, score) for score, vec_id in best]
                columns = list(zip(*found, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    best = pairs.mapInArrow(search, "query_id long, query_digest binary, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_digest").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
