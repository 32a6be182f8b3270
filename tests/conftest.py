from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame, SparkSession

from sedimenta.session import local_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def name() -> str:
    """A table name nobody else uses, in its own database."""
    return f"db_{uuid.uuid4().hex[:8]}.t"


@pytest.fixture
def drop(tmp_path: Path) -> Callable[..., str]:
    """Write one landing file with exactly the given Arrow columns; returns the root."""

    def write(file_name: str, root: str = "landing", **columns: pa.Array) -> str:
        path = tmp_path / root / file_name
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), path)
        return str(tmp_path / root)

    return write


def rows_of(df: DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns in order by name."""
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def plan_of(df: DataFrame) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
