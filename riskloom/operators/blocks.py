"""Rows of a training table as blocks of numbers, which iterative fits read again and again.

A block is what one Arrow batch holds. Fits ask for sums over all rows: tasks add up what their blocks give, and the
sums of all tasks meet in one grouped aggregate, so the driver gets as many numbers as there are keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "rows int, x binary, y binary, fold binary, draw binary"


def blocked(rows: DataFrame, label: str, seed: int) -> DataFrame:
    """``rows, x, y, fold, draw``: features (doubles), label and fold (-1 without one), a draw from 0 to 9 by row value."""
    fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(-1)
    draw = F.pmod(F.xxhash64("features", F.lit(seed)), F.lit(10)).cast("int")
    narrow = rows.select(
        vector_to_array("features").alias("x"), F.col(label).cast("int").alias("y"), fold.alias("fold"), draw.alias("draw")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<f8")
            others = [batch.column(i).to_numpy(zero_copy_only=False).astype("<i4").tobytes() for i in (1, 2, 3)]
            columns = [pa.array([batch.num_rows], pa.int32()), *[pa.array([b], pa.binary()) for b in (x.tobytes(), *others)]]
            yield pa.RecordBatch.from_arrays(columns, names=["rows", "x", "y", "fold", "draw"])

    return narrow.mapInArrow(run, BLOCK)


class Block:
    """One block as arrays; ``x`` has a row a column of the table."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.n = batch.column("rows")[i].as_py()
        x = np.frombuffer(batch.column("x")[i].as_buffer(), "<f8")
        self.x = x.reshape(self.n, -1).T
        self.y, self.fold, self.draw = (
            np.frombuffer(batch.column(c)[i].as_buffer(), "<i4") for c in ("y", "fold", "draw")
        )


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch, i)
