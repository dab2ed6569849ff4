"""Split raw rows into typed accepted rows and quarantined rows with reason codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.casts import safe_integer
from obslake.functions.evidence import json_of_struct, quarantine_id, row_struct
from obslake.schemas import (
    EVIDENCE_COLUMN,
    INTERNAL_COLUMNS,
    INVALID_CAPACITY_BYTES,
    INVALID_DATE,
    INVALID_FAILURE_FLAG,
    MISSING_SERIAL_NUMBER,
    REQUIRED_BRONZE_COLUMNS,
    VOLATILE_COLUMNS,
    require_columns,
)


@dataclass(frozen=True)
class ValidationFrames:
    """Typed rows that passed every rule, and rows that failed at least one."""

    accepted: DataFrame
    rejected: DataFrame


def evidence_columns(columns: Sequence[str], exclude: Sequence[str] = VOLATILE_COLUMNS) -> list[str]:
    """Source columns serialised as raw evidence: everything but volatile lineage."""
    return sorted(c for c in columns if c not in exclude and c not in INTERNAL_COLUMNS)


def typed_columns(df: DataFrame) -> DataFrame:
    """Safe typing: a value that does not convert becomes null instead of failing."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            "date": F.col("date").try_cast("date"),
            "serial_number": F.trim(F.col("serial_number").cast("string")),
            "capacity_bytes": safe_integer(F.col("capacity_bytes"), "bigint", types["capacity_bytes"]),
            "failure": safe_integer(F.col("failure"), "int", types["failure"]),
        }
    )


def rejection_reasons() -> Column:
    """All four rules, in fixed order, on typed columns; a row can fail several."""
    serial = F.col("serial_number")
    failure = F.col("failure")
    capacity = F.col("capacity_bytes")
    return F.array_compact(
        F.array(
            F.when(F.col("date").isNull(), F.lit(INVALID_DATE)),
            F.when(serial.isNull() | (serial == ""), F.lit(MISSING_SERIAL_NUMBER)),
            F.when(failure.isNull() | ~failure.isin(0, 1), F.lit(INVALID_FAILURE_FLAG)),
            F.when(capacity.isNull() | (capacity <= 0), F.lit(INVALID_CAPACITY_BYTES)),
        )
    )


def with_diagnostics(df: DataFrame, evidence_exclude: Sequence[str] = VOLATILE_COLUMNS) -> DataFrame:
    """Typed columns plus ``rejection_reasons`` and the untyped source values.

    The original values are kept as one struct (``_evidence``); it is only turned
    into JSON where evidence is published, and Catalyst drops it from every branch
    that does not need it.
    """
    require_columns(df.columns, REQUIRED_BRONZE_COLUMNS, "Missing required columns")
    evidence = row_struct(evidence_columns(df.columns, evidence_exclude))
    return typed_columns(df.withColumn(EVIDENCE_COLUMN, evidence)).withColumn(
        "rejection_reasons", rejection_reasons()
    )


def with_raw_evidence(df: DataFrame) -> DataFrame:
    """``raw_record`` and ``quarantine_id`` from the kept source values."""
    raw = (
        json_of_struct(F.col(EVIDENCE_COLUMN))
        if EVIDENCE_COLUMN in df.columns
        else json_of_struct(row_struct(evidence_columns(df.columns)))
    )
    return df.withColumn("raw_record", raw).withColumn(
        "quarantine_id", quarantine_id(F.col("source_file"), F.col("source_revision"), F.col("raw_record"))
    )


def validate_rows(df: DataFrame, evidence_exclude: Sequence[str] = VOLATILE_COLUMNS) -> ValidationFrames:
    """Typed accepted rows and rejected rows with reasons, raw JSON and a stable id.

    Raw JSON is taken before typing, over the source columns in sorted order, so the
    id does not depend on column order and does not change when Bronze is rebuilt.
    """
    diagnosed = with_diagnostics(df, evidence_exclude)
    accepted = diagnosed.filter(F.size("rejection_reasons") == 0).drop("rejection_reasons")
    rejected = with_raw_evidence(diagnosed.filter(F.size("rejection_reasons") > 0)).drop(EVIDENCE_COLUMN)
    return ValidationFrames(accepted=accepted, rejected=rejected)
