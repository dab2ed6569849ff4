"""Shared helpers: reading the given tables, staged tables, the word rule."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.session import scratch_path

#: A word is a run of characters other than space and the controls 0x09 to 0x0D.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order (null text: none)."""
    # One-character replaces and a one-character split work on bytes; a pattern is several times slower.
    body = F.coalesce(text, F.lit(""))
    for space in SPACES[1:]:
        body = F.replace(body, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(body, " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged (the same rule in every engine)."""
    return F.translate(text, UPPER, UPPER.lower())


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh folder below the shared folder, and read back.

    Cuts the lineage: what follows is computed from files every executor can read, so
    the loss of an executor never repeats the work above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{purpose}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def numbered(docs: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    """``docs`` with columns named by their number, so that no column that a step adds meets one of
    them, and a function that gives the column of an old name."""
    place = {name.lower(): i for i, name in enumerate(docs.columns)}
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), lambda name: F.col(f"c{place[name.lower()]}")


def released(*tables: DataFrame) -> None:
    """Delete tables of ``staged`` that nothing reads any more (their readers must have been staged
    themselves), and the shuffles behind what is staged."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    swept(tables[0].sparkSession)


def swept(spark: SparkSession) -> None:
    """Have Spark remove the shuffles of finished steps.

    It does so once the driver has collected what refers to them, which may be long after;
    disk then holds one step of a job and not all steps so far.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def memory_returned() -> None:
    """Give memory that a Python worker has freed back to the system.

    Workers wait for their next task with what Arrow's pool and the C library keep of the last one; beside
    the workers of another session, that is memory which the executor needs. Called at the end of a large step.
    """
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def batch_slices(lengths, most: int) -> Iterator[tuple[int, int]]:
    """[from, to) row ranges whose summed ``lengths`` stay near ``most`` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
