"""Declared types, column contracts and fixed values shared by all layers."""

from __future__ import annotations

from typing import Final

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with the
# published contract of the pipeline (reason codes, patterns, separators).
# ---------------------------------------------------------------------------
INVALID_DATE: Final = "INVALID_DATE"
MISSING_SERIAL_NUMBER: Final = "MISSING_SERIAL_NUMBER"
INVALID_FAILURE_FLAG: Final = "INVALID_FAILURE_FLAG"
INVALID_CAPACITY_BYTES: Final = "INVALID_CAPACITY_BYTES"
UNRESOLVED_DUPLICATE: Final = "UNRESOLVED_DUPLICATE"
# Wide reading columns: smart_<id>_raw / smart_<id>_normalized.
SMART_COLUMN_PATTERN: Final = r"^smart_(\d+)_(raw|normalized)$"
# One path segment naming a source release, e.g. release=2024-Q1-r2.
RELEASE_SEGMENT_PATTERN: Final = r"^release=(\d{4}-Q[1-4])-r([1-9]\d*)$"
# Simple SQL identifier accepted as a merge key.
MERGE_KEY_PATTERN: Final = r"^[A-Za-z_][A-Za-z0-9_]*$"
# Quarantine id parts are joined with the unit separator; a null part becomes <null>.
ID_SEPARATOR: Final = "\u001f"
NULL_SENTINEL: Final = "<null>"
INVALID_PATH_MESSAGE: Final = "Source path must contain release=YYYY-QN-rN: "

# Keys, precedence, column lists and declared types of the published tables.
BUSINESS_KEYS: Final = ("date", "serial_number")
PRECEDENCE_COLUMNS: Final = ("source_revision", "file_modification_time", "source_file")
# Columns that change when the same file is ingested again; kept out of evidence
# JSON and of the business content fingerprint so that ids survive a Bronze rebuild.
VOLATILE_COLUMNS: Final = ("file_modification_time", "ingested_at")
RESCUED_COLUMN: Final = "_rescued_data"
# Columns that the library adds on the way: the untyped source values of a row, the digest of its
# business content, its rejection reasons.
EVIDENCE_COLUMN: Final = "_evidence"
DIGEST_COLUMN: Final = "_digest"
REASONS_COLUMN: Final = "rejection_reasons"
INTERNAL_COLUMNS: Final = (EVIDENCE_COLUMN, DIGEST_COLUMN, REASONS_COLUMN)

REQUIRED_BRONZE_COLUMNS: Final = frozenset(
    {"date", "serial_number", "capacity_bytes", "failure", "source_file", "source_revision"}
)
REQUIRED_SILVER_COLUMNS: Final = frozenset({"date", "serial_number", "model", "failure"})

SMART_READING_TYPE: Final = StructType(
    [
        StructField("raw", LongType(), nullable=True),
        StructField("normalized", LongType(), nullable=True),
    ]
)
SMART_ATTRIBUTES_TYPE: Final = MapType(StringType(), SMART_READING_TYPE, valueContainsNull=False)
QUALITY_WARNINGS_TYPE: Final = ArrayType(StringType(), containsNull=False)

GOLD_DAILY_SCHEMA: Final = StructType(
    [
        StructField("date", DateType(), nullable=True),
        StructField("model", StringType(), nullable=True),
        StructField("active_drives", LongType(), nullable=False),
        StructField("failures", LongType(), nullable=True),
        StructField("drive_days", LongType(), nullable=False),
    ]
)

GOLD_PERIOD_SCHEMA: Final = StructType(
    [
        StructField("period_start", DateType(), nullable=False),
        StructField("period_end", DateType(), nullable=False),
        StructField("model", StringType(), nullable=True),
        StructField("unique_drives_observed", LongType(), nullable=False),
        StructField("failed_drives", LongType(), nullable=False),
        StructField("total_drive_days", LongType(), nullable=False),
        StructField("naive_failed_drive_percentage", DoubleType(), nullable=True),
        StructField("failures_per_million_drive_days", DoubleType(), nullable=True),
    ]
)

TRUSTED_COLUMNS: Final = (
    "date",
    "serial_number",
    "model",
    "capacity_bytes",
    "failure",
    "smart_attributes",
    "quality_warnings",
    "source_file",
    "source_quarter",
    "source_revision",
    "file_modification_time",
    "ingested_at",
    "_rescued_data",
)

QUARANTINE_COLUMNS: Final = (
    "quarantine_id",
    "source_file",
    "source_quarter",
    "source_revision",
    "file_modification_time",
    "ingested_at",
    "raw_record",
    "rejection_reasons",
)
# ---------------------------------------------------------------------------


def require_columns(columns: list[str], required: frozenset[str], label: str) -> None:
    """Raise ``ValueError`` naming the sorted missing columns (names are case-sensitive)."""
    missing = sorted(required.difference(columns))
    if missing:
        raise ValueError(f"{label}: {', '.join(missing)}")
