"""Arrow batches cut small: Spark's hold up to ten thousand rows, however long."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cut(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Places from and to of rows in a row, each of about ``limit`` at most; one larger row is alone."""
    if not len(sizes):
        return []
    group = (np.cumsum(sizes) - 1) // limit
    edges = np.flatnonzero(np.diff(group)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)], strict=True))


def text_slices(batches, limit: int = 4 << 20):
    """Arrow batches with a column ``text``, cut so that each holds about ``limit`` bytes of
    text. A single longer text is a batch of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        for a, b in cut(np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64), limit):
            yield batch.slice(a, b - a)


def few_texts(column: pa.Array, limit: int = 1 << 20):
    """The texts of a column as lists, some at a time; a missing one is empty."""
    for a, b in cut(np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64), limit):
        yield [t or "" for t in column.slice(a, b - a).to_pylist()]
