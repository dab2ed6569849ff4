"""Which hashes of a document also occur in another document, for all documents at once.

Map tasks hash slices of documents ("blocks") and send each bucket of the hash space one
packed array a block; a reducer sorts its bucket, counts the documents of each hash and
sends those of two or more back to their blocks. Documents' texts are not shuffled.

A hash that several documents of a block have is sent once, with their number; which ones
they are stays with the block. So a line that stands in every document costs its bucket seven
bytes a block (a megabyte of text), not seven bytes a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import batch_slices, memory_returned, staged, swept
from obslake.session import ship_package

#: Text bytes and rows of a block; text bytes for which a bucket of hashes is planned.
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 20_000
BUCKET_BYTES = 24 << 20
#: Bits of a hash that are compared within a bucket (the bucket adds its own).
KEPT_BITS = 40
KEPT_MASK = np.uint64((1 << KEPT_BITS) - 1)
#: A sent row number from here on is the number of the block's rows that have the hash (a block has fewer
#: than 2^15 rows, so both fit into 16 bits).
SEVERAL = 1 << 15
#: Kinds of what is sent: hashes, a block's kept rows, a block's rows of the hashes that several of them have.
HASHES, KEPT, MEMBERS = 0, 1, 2
ROWS_SCHEMA = "key long, block long, kind int, payload binary"


def once_each(value: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """A block's distinct ``value``s in order, each with its row or, from SEVERAL on, the number of its
    rows, and packed the rows of those with several: their number, the values, the counts, the rows."""
    order = np.argsort(value, kind="stable")
    value, rows = value[order], rows[order].astype(np.uint16)
    new = np.ones(len(value), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(value)))
    several = counts > 1
    own = np.where(several, SEVERAL + counts, rows[first]).astype(np.uint16)
    if not several.any():
        return value[first], own, b""
    known = value[first[several]]
    packed = (np.array([len(known)], np.uint64), known, counts[several].astype(np.uint16), rows[np.repeat(several, counts)])
    return value[first], own, b"".join(x.tobytes() for x in packed)


def each_row(value: np.ndarray, own: np.ndarray, df: np.ndarray, members: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, df) of every row of a block that has a value, from what ``once_each`` gave of them."""
    several = own >= SEVERAL
    rows = own.astype(np.int64)
    if not several.any():
        return rows, value, df
    n = int(np.frombuffer(members, np.uint64, 1)[0])
    known = np.frombuffer(members, np.uint64, n, 8)
    counts = np.frombuffer(members, np.uint16, n, 8 + 8 * n).astype(np.int64)
    listed = np.frombuffer(members, np.uint16, offset=8 + 10 * n)
    at = np.searchsorted(known, value[several])
    times = counts[at]
    starts = (np.cumsum(counts) - counts)[at]
    places = np.repeat(starts - (np.cumsum(times) - times), times) + np.arange(times.sum())
    return (
        np.concatenate([rows[~several], listed[places].astype(np.int64)]),
        np.concatenate([value[~several], np.repeat(value[several], times)]),
        np.concatenate([df[~several], np.repeat(df[several], times)]),
    )


def shared_hashes(docs: DataFrame, extract: Callable, finish: Callable, schema: str, purpose: str) -> DataFrame:
    """Staged table of ``finish``'s rows.

    ``docs`` has the column ``text`` last and must be a table of files, so that a repeated task
    reads the same rows in the same order. ``extract(batch)`` gives for some rows of it a record
    batch of what to keep of each row, and (row, hash) arrays, each pair once. ``finish(kept,
    row, hash, df)`` gets a block's kept rows with the hashes (identity within the corpus) that
    occur in ``df`` >= 2 of all rows, and returns a record batch.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            import pyarrow.compute as pc

            sizes = np.maximum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False), BLOCK_BYTES // BLOCK_ROWS)
            for lo, hi in batch_slices(sizes, BLOCK_BYTES):
                kept, rows, hashes = extract(batch.slice(lo, hi - lo))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, kept.schema) as writer:
                    writer.write_batch(kept)
                out = [(block % buckets, block, KEPT, sink.getvalue().to_pybytes())]
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                value = (hashes & KEPT_MASK) | (bucket << np.uint64(KEPT_BITS))
                value, own, members = once_each(value, rows)
                if len(members):
                    out.append((block % buckets, block, MEMBERS, members))
                bucket = value >> np.uint64(KEPT_BITS)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                low = value.astype(np.uint32)
                high = (value >> np.uint64(32)).astype(np.uint8)
                for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
                    if b > a:
                        out.append((int(bucket[a]), block, HASHES, low[a:b].tobytes() + high[a:b].tobytes() + own[a:b].tobytes()))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary())],
                    names=["key", "block", "kind", "payload"],
                )
                block += 1
        memory_returned()

    def counted(table):
        out = count(table)
        memory_returned()
        return out

    def count(table):
        import pyarrow as pa

        keys, blocks, kinds, payloads = (table.column(i).to_pylist() for i in range(4))
        out = [(b, kind, p) for b, kind, p in zip(blocks, kinds, payloads, strict=True) if kind != HASHES]
        sent = [(b, p) for b, kind, p in zip(blocks, kinds, payloads, strict=True) if kind == HASHES]
        if sent:
            counts = np.array([len(p) // 7 for _, p in sent])
            value = np.concatenate(
                [
                    np.frombuffer(p, np.uint32, n).astype(np.uint64)
                    | np.frombuffer(p, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)
                    for (_, p), n in zip(sent, counts, strict=True)
                ]
            )
            own = np.concatenate([np.frombuffer(p, np.uint16, n, 5 * n) for (_, p), n in zip(sent, counts, strict=True)])
            order = np.argsort(value, kind="stable")
            ordered = value[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            runs = np.diff(np.append(first, len(ordered)))
            having = np.where(own < SEVERAL, 1, own.astype(np.int64) - SEVERAL)
            total = np.add.reduceat(having[order], first)
            df = np.empty(len(ordered), dtype=np.uint32)
            df[order] = np.repeat(total, runs).astype(np.uint32)
            value |= np.uint64(keys[0]) << np.uint64(KEPT_BITS)
            ends = np.cumsum(counts)
            for (block, _), a, b in zip(sent, ends - counts, ends, strict=True):
                live = np.flatnonzero(df[a:b] > 1) + a
                if len(live):
                    out.append((block, HASHES, value[live].tobytes() + df[live].tobytes() + own[live].tobytes()))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table(
            {"block": pa.array(columns[0], pa.int64()), "kind": pa.array(columns[1], pa.int32()), "payload": pa.array(columns[2], pa.binary())}
        )

    def assembled(table):
        import pyarrow as pa

        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        kept = next(pa.ipc.open_stream(p).read_next_batch() for k, p in zip(kinds, payloads, strict=True) if k == KEPT)
        members = next((p for k, p in zip(kinds, payloads, strict=True) if k == MEMBERS), b"")
        sent = [(p, len(p) // 14) for k, p in zip(kinds, payloads, strict=True) if k == HASHES]
        value = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in sent] or [np.zeros(0, np.uint64)])
        df = np.concatenate([np.frombuffer(p, np.uint32, n, 8 * n) for p, n in sent] or [np.zeros(0, np.uint32)])
        rows = np.concatenate([np.frombuffer(p, np.uint16, n, 12 * n) for p, n in sent] or [np.zeros(0, np.uint16)])
        return pa.Table.from_batches([finish(kept, *each_row(value, rows, df, members))])

    sent = docs.mapInArrow(hashed, ROWS_SCHEMA)
    live = sent.groupBy("key").applyInArrow(counted, "block long, kind int, payload binary")
    out = staged(live.groupBy("block").applyInArrow(assembled, schema), purpose)
    swept(spark)
    return out
