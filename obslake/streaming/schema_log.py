"""The columns of a growing table, kept as numbered versions in a folder.

A version is written once and never changed: a folder ``version=<n>`` with one row a column. New
columns go behind the known ones, so a later version reads everything that an earlier one wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from obslake.sources.landing import merged_columns

SCHEMA = "version int, position int, name string"
ATTEMPTS = 5


def known_columns(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """Newest version (0 if there is none) and its columns in order."""
    try:
        log = spark.read.schema(SCHEMA).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    newest = log.where(F.col("version") == log.agg(F.max("version")).first()[0])
    rows = newest.orderBy("position").collect()  # one row a column
    return (rows[0].version, [r.name for r in rows]) if rows else (0, [])


def extend(spark: SparkSession, folder: str, headers: Sequence[str]) -> list[str]:
    """The columns of the table once those of ``headers`` belong to it; writes a version if some are new.

    Repeating it changes nothing. If another query writes the next version first, its columns
    are taken in and the one behind it is written.
    """
    for attempt in range(ATTEMPTS):
        version, known = known_columns(spark, folder)
        columns = merged_columns(known, headers)
        if columns == known:
            return columns
        rows = spark.createDataFrame(list(enumerate(columns)), "position int, name string")
        try:
            rows.coalesce(1).write.mode("errorifexists").json(f"{folder.rstrip('/')}/version={version + 1}")
            return columns
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS" or attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("not reached")
