"""Greedy packing of neighbours into groups of a bounded size, in one sorted pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def greedy_groups(rows: DataFrame, key: str, order: str, size: str, budget: int, name: str) -> DataFrame:
    """rows with `name` int: within each key and in order, a group (0 first) is filled while the sum of its sizes is at most the budget; what is larger stands alone. A null size is 0.

    Rows are dealt by key and sorted; a task streams through them and holds one batch, whatever a key has. A group's end is
    looked up in the batch's running sums, so the time is that of the sort. A key's rows stay together, as each group begins
    where the one before it ends.
    """
    rows = rows.drop(name)
    at_key, at_size = rows.columns.index(key), rows.columns.index(size)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group, held, started = None, 0, 0, False
        for batch in batches:
            keys = batch.column(at_key).dictionary_encode()
            codes = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            values = keys.dictionary.to_pylist()
            sizes = batch.column(at_size).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = np.zeros(batch.num_rows, np.int32)
            cuts = np.flatnonzero(np.diff(codes)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)], strict=True):
                if a == b:
                    continue
                now = values[codes[a]] if codes[a] >= 0 else None
                if not started or now != last:
                    last, group, held, started = now, 0, None, True
                sums = np.cumsum(sizes[a:b])
                at, before = 0, 0
                while at < b - a:
                    # held None: nothing is in the group, so its first row goes in whatever its size
                    end = int(np.searchsorted(sums, budget - (held or 0) + before, side="right"))
                    if held is None:
                        end = max(end, at + 1)
                    end = max(end, at)
                    out[a + at : a + end] = group
                    if end > at:
                        held = (held or 0) + int(sums[end - 1]) - before
                        before = int(sums[end - 1])
                    at = end
                    if at < b - a:
                        group, held = group + 1, None
            yield batch.append_column(name, pa.array(out))

    dealt = rows.repartition(F.col(key)).sortWithinPartitions(key, order)
    return dealt.mapInArrow(packed, T.StructType([*rows.schema.fields, T.StructField(name, T.IntegerType())]))
