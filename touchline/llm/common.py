"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import checkpoint_dir, materialize

__all__ = ["checkpoint_dir", "folder", "input_table", "joined_ranges", "materialize", "open_folder",
           "slices", "spread_name", "table", "unsigned_hex"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_table(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator works on, under its own names and types.

    Further columns of the caller, whatever their names, can then not clash with
    the operator's own.
    """
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def folder(spark: SparkSession, name: str) -> str:
    """A new folder (not yet made) for files of one run, below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


def open_folder(uri: str):
    """The file system of a URI or a plain path, and the path within it; made if absent."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    system.create_dir(path, recursive=True)
    return system, path


def spread_name(prefix: str, suffix: str) -> str:
    """A file name no other attempt of any task uses."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each stay below most_bytes, or are one row.

    Bounds what the vectorised code below holds at a time, whatever the length of the texts.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and held + n > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        yield batch.slice(begin)


def joined_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + length) over all pairs."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def unsigned_hex(column: Column) -> Column:
    """16 lowercase hexadecimal digits of a 64-bit integer."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
