from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from obslake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = build_session("local[*]", shuffle_partitions=8)
    yield session
    session.stop()
