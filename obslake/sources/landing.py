"""Landing CSV files whose columns change between releases, read as text by header.

Spark's CSV reader maps columns by position, so files with different headers cannot share one read.
Here all files are scanned as lines. The first line of each file is found by an aggregation that
keeps one line a file; these header rows, with the release lineage parsed once a file, are joined back
to the lines by path. Lines are then parsed by ``from_csv`` with the columns of their own header, in one
projection for all headers, and put under the columns of the table by name.

A line that repeats the header of its file is a header too. Blank lines and empty files have no rows.
Quotes are doubled inside quoted fields (RFC 4180); a field does not span lines.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from obslake.functions import lineage
from obslake.schemas import RESCUED_COLUMN

#: What every landing row carries besides the columns of its file.
LINEAGE_FIELDS = (
    StructField("source_file", StringType()),
    StructField("file_modification_time", TimestampType()),
    StructField("source_quarter", StringType()),
    StructField("source_revision", IntegerType()),
    StructField(RESCUED_COLUMN, StringType()),
    StructField("ingested_at", TimestampType()),
)
#: An unquoted empty field is null and a quoted one is empty; the reader tells them apart by a null text
#: of its own, which no field may be.
NULL_TEXT = "\u0001\u0000\u0001"
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "nullValue": NULL_TEXT, "emptyValue": ""}
#: One field of a line with what stands before it (its comma or the start of the line).
FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'
BYTE_ORDER_MARK = "﻿"


def lines_of(scan: DataFrame) -> DataFrame:
    """(line, source_file, file_modification_time, block) of a text scan, batch or streaming."""
    return scan.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def landing_lines(spark: SparkSession, landing: str) -> DataFrame:
    """Lines of all ``*.csv`` files below a folder."""
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    return lines_of(reader.text(landing))


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_file, header): the first line of each file that is not blank."""
    numbered = lines.where(F.trim("line") != "").withColumn("at", F.struct("block", F.monotonically_increasing_id().alias("n")))
    headers = numbered.groupBy("source_file").agg(F.min_by("line", "at").alias("header"))
    return headers.withColumn("header", F.ltrim(F.col("header"), F.lit(BYTE_ORDER_MARK)))


def with_lineage(files: DataFrame) -> DataFrame:
    """``files`` with the release that each path lies in and the time of this run.

    A path outside the contract fails the job that computes it, with the path in the message.
    """
    path = F.col("source_file")
    outside = F.raise_error(lineage.invalid_path_message(path)).cast("struct<source_quarter:string,source_revision:int>")
    release = F.coalesce(lineage.release(path), outside)
    return files.withColumn("_release", release).select(*files.columns, "_release.*", F.current_timestamp().alias("ingested_at"))


def header_columns(header: str) -> list[str]:
    """Column names of a header line; an unnamed column is called by its position.

    Names that differ in case only, or that the lineage columns use, are an error.
    """
    names = [name.strip() or f"_c{i}" for i, name in enumerate(next(csv.reader([header])))]
    seen: set[str] = {f.name.lower() for f in LINEAGE_FIELDS}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"landing header names {name!r} twice, or as lineage does: {header}")
        seen.add(name.lower())
    return names


def merged_columns(known: Sequence[str], headers: Sequence[str]) -> list[str]:
    """``known`` with the columns that only ``headers`` have behind them (names match in either case)."""
    out = list(known)
    seen = {name.lower() for name in out}
    for header in sorted(headers):
        for name in header_columns(header):
            if name.lower() not in seen:
                seen.add(name.lower())
                out.append(name)
    return out


def surplus_fields(line: Column, width: int) -> Column:
    """JSON object of the fields behind the first ``width``, named by position; null without any."""
    fields = F.slice(F.regexp_extract_all(line, F.lit(FIELD), F.lit(1)), width + 1, 1 << 30)
    quoted = F.transform(
        fields,
        lambda f: F.when(f.startswith('"'), F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f),
    )
    named = F.transform(quoted, lambda f, i: F.struct(F.concat(F.lit("_c"), (i + width).cast("string")), f))
    return F.when(F.size(fields) > 0, F.to_json(F.map_from_entries(named)))


def aligned(line: Column, header: str, columns: Sequence[str]) -> Column:
    """``line`` parsed by its header: a struct of ``columns`` and the surplus fields.

    A column that the header lacks, or that a short line does not reach, is null.
    """
    own = header_columns(header)
    schema = StructType([StructField(f"f{i}", StringType()) for i in range(len(own))] + [StructField("_line", StringType())])
    place = {name.lower(): i for i, name in enumerate(own)}

    def row(parsed: Column) -> Column:
        fields = [
            (parsed[f"f{place[c.lower()]}"] if c.lower() in place else F.lit(None).cast("string")).alias(c) for c in columns
        ]
        # ``_line`` is set where the number of fields is another one than the header's.
        rescued = F.when(parsed["_line"].isNotNull(), surplus_fields(parsed["_line"], len(own)))
        return F.struct(*fields, rescued.alias(RESCUED_COLUMN))

    # Bound to a name, so that a line is parsed once and not once a column.
    parsed = F.from_csv(line, F.lit(schema.simpleString()[7:-1].replace(":", " ")), CSV_OPTIONS)
    return F.get(F.transform(F.array(parsed), row), F.lit(0))


def landing_rows(lines: DataFrame, headers: DataFrame, distinct: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``lines`` as text under ``columns``, with lineage.

    ``headers`` has one row a file (``file_headers`` with lineage), ``distinct`` are the
    headers in it.
    """
    files = headers.withColumnRenamed("source_file", "_file")
    data = lines.where(F.trim("line") != "").join(files, F.col("source_file") == F.col("_file"))
    body = F.ltrim(F.col("line"), F.lit(BYTE_ORDER_MARK))
    row = F.lit(None)
    for header in distinct:
        row = F.when(F.col("header") == header, aligned(F.col("line"), header, columns)).otherwise(row)
    kept = data.where(body != F.col("header")).select(row.alias("row"), *[f.name for f in LINEAGE_FIELDS if f.name != RESCUED_COLUMN])
    names = [F.col("row").getField(c).alias(c) for c in columns]
    ends = [F.col("row").getField(RESCUED_COLUMN).alias(RESCUED_COLUMN) if f.name == RESCUED_COLUMN else F.col(f.name) for f in LINEAGE_FIELDS]
    return kept.select(*names, *ends)


def read_landing(spark: SparkSession, landing: str, stage: str) -> DataFrame:
    """All rows of a landing folder at once; the headers are written to ``stage`` first."""
    lines = landing_lines(spark, landing)
    headers, distinct = staged_headers(lines, stage)
    return landing_rows(lines, headers, distinct, merged_columns([], distinct))


def staged_headers(lines: DataFrame, stage: str) -> tuple[DataFrame, list[str]]:
    """Header rows of ``lines`` written to ``stage`` and read back, and the distinct headers among them.

    Read back, their size is known, so Spark itself decides whether to broadcast them. Distinct
    headers are as few as the shapes that the source has had.
    """
    with_lineage(file_headers(lines)).write.mode("overwrite").parquet(stage)
    headers = lines.sparkSession.read.parquet(stage)
    return headers, sorted(r.header for r in headers.select("header").distinct().collect())


def write_landing(df: DataFrame, landing: str, release: str = "release") -> None:
    """Write rows as landing CSV below ``release=<value>/`` folders, text kept exactly.

    Few files a release, and several for a large one; every file has the header.
    """
    (
        df.hint("rebalance", release)
        .write.mode("append")
        .partitionBy(release)
        .option("header", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(landing)
    )
