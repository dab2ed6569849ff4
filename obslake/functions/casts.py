"""Safe typing of text columns.

``try_cast`` of text that is not a number costs a thrown and caught exception per
value inside the generated code; Bronze readings are often blank or junk, so the
integer casts first check the text against the shape the cast accepts (optional
surrounding whitespace, optional sign, digits) and only then cast. The result is the
same as ``try_cast`` for every input: text outside the shape gives null either way,
and an overflowing number still gives null from the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

INTEGER_TEXT = r"^[\s\x00-\x1F]*[+-]?[0-9]+[\s\x00-\x1F]*$"


def safe_integer(column: Column, data_type: str, source_type=None) -> Column:
    """``try_cast(column as data_type)`` for an integral type, without exceptions on junk."""
    if source_type is not None and not isinstance(source_type, StringType):
        return column.try_cast(data_type)
    return F.when(column.rlike(INTEGER_TEXT), column.try_cast(data_type))
