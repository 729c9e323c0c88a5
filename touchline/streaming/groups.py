"""Kernels over whole groups of sorted rows, carried from one Arrow batch to the next."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame


def group_ends(keys: list[pa.Array]) -> np.ndarray:
    """Where a row's keys differ from those of the row before, of sorted columns; nulls are alike."""
    n = len(keys[0])
    new = np.zeros(max(n - 1, 0), bool)
    for k in keys:
        a, b = k.slice(0, n - 1), k.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        new |= np.asarray(pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))))
    return np.flatnonzero(new) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of sorted rows, each as one table: what is left at a batch's end waits for the next. Memory is that of one group
    and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:  # does the first row go on with the group that waits?
            seam = [pa.concat_arrays([held[-1].column(k).slice(held[-1].num_rows - 1), batch.column(k).slice(0, 1)]) for k in keys]
            if len(group_ends(seam)):
                yield pa.Table.from_batches(held)
                held = []
        start = 0
        for end in group_ends([batch.column(k) for k in keys]).tolist():
            yield pa.Table.from_batches([*held, batch.slice(start, end - start)])
            held, start = [], end
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def map_groups(rows: DataFrame, keys: list[str], order: list[str | Column], kernel: Callable[[pa.Table], pa.Table], schema: str, halo: str | None = None) -> DataFrame:
    """``kernel`` over each group of ``keys``, its rows in ``order``: a table in, a table of ``schema`` out.

    Rows are dealt out by key and sorted in their partitions, which can spill; a task then holds one group at a time, not its
    partition. With ``halo``, a boolean column, a group's rows also hold copies of its neighbours' (``halo_windows``): the kernel gives a
    row for each of its rows, and those of copies are left out of the result. Null keys are a group."""

    def run(batches):
        for group in whole_groups(batches, keys):
            out = kernel(group)
            if halo is not None:
                out = out.filter(pc.invert(pc.fill_null(group.column(halo), False)))
            yield from out.to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
