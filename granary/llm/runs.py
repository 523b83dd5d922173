"""Placement by runs: rows numbered within a class, looked up in a small table.

A packing decided on a histogram says, for each class (a length, a group
size), which stretch of that class's row numbers goes where. The table of
such stretches is bounded by the histogram, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass
class Runs:
    """Stretches [first, first + count) of a class. Row first+i goes to bin
    ``bin + i // per`` at place ``base + (i % per) * step``."""

    rows: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)

    def add(self, klass: int, first: int, count: int, bin: int, per: int, base: int, step: int) -> None:
        if count:
            self.rows.append((klass, first, count, bin, per, base, step))

    def tables(self) -> dict[int, np.ndarray]:
        by: dict[int, list] = {}
        for r in self.rows:
            by.setdefault(r[0], []).append(r[1:])
        return {k: np.array(sorted(v), dtype=np.int64) for k, v in by.items()}


def place(df: DataFrame, runs: Runs, klass: str, number: str, bin: str, at: str) -> DataFrame:
    """Add columns `bin` and `at` (long) to df by its columns klass and number."""
    from pyspark.sql import types as T

    held = df.sparkSession.sparkContext.broadcast(runs.tables())
    schema = T.StructType([*df.schema.fields, T.StructField(bin, T.LongType()), T.StructField(at, T.LongType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.value
        for b in batches:
            k = b.column(b.schema.get_field_index(klass)).to_numpy(zero_copy_only=False)
            n = b.column(b.schema.get_field_index(number)).to_numpy(zero_copy_only=False)
            to, off = np.empty(len(k), np.int64), np.empty(len(k), np.int64)
            for c in np.unique(k):
                rows = np.flatnonzero(k == c)
                t = tables[int(c)]
                hit = t[np.searchsorted(t[:, 0], n[rows], side="right") - 1]
                i = n[rows] - hit[:, 0]
                to[rows] = hit[:, 2] + i // hit[:, 3]
                off[rows] = hit[:, 4] + (i % hit[:, 3]) * hit[:, 5]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to), pa.array(off)], names=[*b.schema.names, bin, at])

    return df.mapInArrow(look_up, schema)
