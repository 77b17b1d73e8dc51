"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LAST_ID = 2**63 - 1  # where a null id sorts
ROW_BYTES = 64  # what a row counts besides its text


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def if_small(df: DataFrame, measured_bytes: int, limit: int) -> DataFrame:
    """``df`` marked for broadcast where its measured size allows it, else left to a shuffle join."""
    return F.broadcast(df) if measured_bytes <= limit else df


def text_chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """The rows of a partition in tables of about ``limit`` bytes of ``text``; a longer text is a table of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = 0
        for row in range(batch.num_rows):
            value = column[row]
            size += ROW_BYTES + (len(value.as_buffer()) if value.is_valid else 0)
            if size >= limit:
                held.append(batch.slice(start, row + 1 - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, row + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class Numbers(dict):
    """Numbers its keys from 0 in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, those of equal weight side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(planes.T.tobytes(), 1)


def expand(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)
