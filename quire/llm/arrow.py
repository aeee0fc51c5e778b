"""Arrow helpers of the operators that work on batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes in
    ``column`` (one row at least), so that work space is bounded."""
    for batch in batches:
        sizes = np.cumsum(lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            upto = max(int(np.searchsorted(sizes, done + limit, side="right")), at + 1)
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()  # workers live on for other stages


def lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each value, null as 0."""
    offsets = _offsets(values)
    return np.where(np.asarray(values.is_valid()), np.diff(offsets), 0)


def _offsets(values: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else np.int32
    raw = values.buffers()[1]
    if raw is None or len(values) == 0:
        return np.zeros(len(values) + 1, np.int64)
    return np.frombuffer(raw, kind)[values.offset:values.offset + len(values) + 1].astype(np.int64)


def joined(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the UTF-8 bytes of all values one after the other and
    where each begins (one more at the end); nulls are empty."""
    if values.null_count:
        values = values.fill_null("" if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else b"")
    offsets = _offsets(values)
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]
