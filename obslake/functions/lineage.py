"""Release lineage derived from a landing path such as /landing/release=2024-Q1-r2/day.csv."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.schemas import INVALID_PATH_MESSAGE, RELEASE_SEGMENT_PATTERN


def release_segments(path: Column) -> Column:
    """Path segments that are exactly a release directory name."""
    return F.filter(F.split(path, "/"), lambda segment: segment.rlike(RELEASE_SEGMENT_PATTERN))


def release_match_count(path: Column) -> Column:
    return F.size(release_segments(path))


def release_is_valid(path: Column) -> Column:
    """Strict rule: exactly one release directory in the path."""
    return F.coalesce(release_match_count(path) == 1, F.lit(False))


def release_quarter(path: Column) -> Column:
    return F.regexp_extract(F.element_at(release_segments(path), 1), RELEASE_SEGMENT_PATTERN, 1)


def release_revision(path: Column) -> Column:
    return F.regexp_extract(F.element_at(release_segments(path), 1), RELEASE_SEGMENT_PATTERN, 2).cast(
        "int"
    )


def release(path: Column) -> Column:
    """(source_quarter, source_revision) of the path's release directory; null unless there is exactly one."""

    def parts(segment: Column) -> Column:
        quarter, revision = (F.regexp_extract(segment, RELEASE_SEGMENT_PATTERN, k) for k in (1, 2))
        return F.struct(quarter.alias("source_quarter"), revision.cast("int").alias("source_revision"))

    # Bound to a name, so that a path is split and matched once.
    only = F.transform(F.array(release_segments(path)), lambda found: F.when(F.size(found) == 1, parts(F.get(found, F.lit(0)))))
    return F.get(only, F.lit(0))


def invalid_path_message(path: Column) -> Column:
    return F.concat(F.lit(INVALID_PATH_MESSAGE), F.coalesce(path.cast("string"), F.lit("<null>")))
