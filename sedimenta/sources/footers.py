"""Footer fingerprints: one distributed pass that says which files share a schema.

Tasks read the footers, not the rows, and send a digest for each file. Spark itself derives the
schema of each distinct digest from one file of it, so the types are those that a scan would see.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that :func:`fingerprinted` adds.
FINGERPRINT, FAULT = "fingerprint", "fault"

#: Fault of a file that tasks cannot open: no client for its store, or no right or no file there.
NO_CLIENT = "cannot be opened by tasks"

# What the client calls the stores of some connectors.
_CLIENT = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}

# Fixed value: key of a footer under which Spark keeps the schema that it wrote.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


@cache
def _store(scheme: str, host: str) -> pafs.FileSystem:
    """The client of a store; one for each in a task."""
    if scheme == "file":
        return pafs.LocalFileSystem()
    return pafs.FileSystem.from_uri(f"{_CLIENT.get(scheme, scheme)}://{host}/")[0]


def _opened(path: str) -> pa.NativeFile:
    scheme, _, rest = path.partition(":")
    if "/" in scheme:
        scheme, rest = "file", path
    if scheme == "file":
        return _store("file", "").open_input_file("/" + rest.lstrip("/"))
    host, _, key = rest.lstrip("/").partition("/")
    # Object stores name a file by its container and key, others by its path alone.
    return _store(scheme, host).open_input_file(f"/{key}" if scheme in ("hdfs", "viewfs") else f"{host}/{key}")


def footer_digest(source: pa.NativeFile) -> str:
    """Digest of all that the schema of a file depends on."""
    found = pq.ParquetFile(source).metadata
    # The first line of the text names an object of this process.
    schema = str(found.schema).partition("\n")[2].encode()
    written = (found.metadata or {}).get(_SPARK_SCHEMA, b"")
    return hashlib.sha256(schema + b"\x00" + written).hexdigest()


def _read(path: str) -> tuple[str | None, str | None]:
    try:
        source = _opened(path)
    except (OSError, ValueError, ImportError, NotImplementedError):
        return None, NO_CLIENT
    with source:
        try:
            return footer_digest(source), None
        except (pa.ArrowInvalid, OSError) as error:
            return None, str(error) or type(error).__name__


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        answers = [_read(path) for path in batch.column("path").to_pylist()]
        digests, faults = (list(column) for column in zip(*answers)) if answers else ([], [])
        columns = [*batch.columns, pa.array(digests, pa.string()), pa.array(faults, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, FINGERPRINT, FAULT])


def fingerprinted(files: DataFrame, tasks: int) -> DataFrame:
    """The files with the digest of each footer, or with what keeps it from being read."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    # Names are a few bytes each: without this all of them would be one task's.
    dealt = files.repartition(tasks, F.col("path"))
    return dealt.mapInArrow(_pass, f"{names}, {FINGERPRINT} string, {FAULT} string")
