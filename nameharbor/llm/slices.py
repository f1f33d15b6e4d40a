"""Arrow batches in slices of a few MB of text, so that the arrays made from one stay small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20
#: Bytes of the Arrow batches between Spark and a Python worker.
BATCH_BYTES = 8 << 20


def small_batches(rows: DataFrame) -> DataFrame:
    """The rows; from here on the session hands long rows to Python in batches of a few MB."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with ``limit`` bytes of text at most (a longer text is alone); no empty slice."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        filled, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            end = int(np.searchsorted(filled, (filled[at - 1] if at else 0) + limit, "right"))
            yield batch.slice(at, max(at + 1, end) - at)
            at = max(at + 1, end)
    pa.default_memory_pool().release_unused()


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as no column of the rows is called so."""
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name
