"""Record batches in Python workers."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of the worked-on column that are taken together.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """The batches cut into runs of rows with at most ``limit`` bytes in
    ``column`` (strings, or lists of numbers; one row at least), so that work
    space and output are bounded by ``limit`` or one row, not by what Spark puts
    into a batch."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        values = batch.column(column)
        if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
            sizes, width = pc.list_value_length(values), max(1, values.type.value_type.bit_width // 8)
        else:
            sizes, width = pc.binary_length(values), 1
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64) * width)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(int(np.searchsorted(ends, done + limit, side="right")), at + 1)
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()  # workers live on for other stages
