"""Numeric tables packed into blocks, and sums of arrays over their tasks.

Learners that pass over their rows again and again get them as blocks: a row of the packed table is a
matrix of some thousand rows, so a pass hands bytes to numpy instead of converting values. Stored blocks
are an RDD of pairs of matrices: a pass needs no plan, and a task holds one block at a time, however many
it reads. What a pass returns are arrays whose size depends on the columns, never on the rows; they are
added up by key on the executors until few are left per key, then on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from forerate.sources.staging import ship_package

#: Rows of a block.
BLOCK_ROWS = 4096
#: Where rows are kept that are read again and again: on the executors' disks, block by block. Python's level with
#: memory holds them serialized in arrays of 1 MB, which take up to twice the heap that Spark reckons with; when
#: several fits run side by side, executors run out of heap. Rows on disk are also sent elsewhere without heap.
KEPT = StorageLevel.DISK_ONLY
#: Arrays of a key that are added up on the driver at most.
FAN_IN = 64
#: Numbers of an array that are added up in one piece.
SLICE = 1 << 16

Block = tuple[np.ndarray, np.ndarray]
Partial = Callable[[Iterator[Block]], Iterator[tuple[int, np.ndarray]]]


def packed(rows: DataFrame, columns: list[str], features: str = "features") -> DataFrame:
    """Blocks of ``rows``: ``x`` is the matrix of the feature vector, ``y`` that of the given number columns."""
    ship_package(rows.sparkSession)
    width = len(columns)
    numbers = [F.col(c).cast("double").alias(c) for c in columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = np.asarray(batch.column("_x").flatten(), dtype=np.float64)
                y = np.stack([np.asarray(batch.column(c)) for c in columns], axis=1) if width else np.zeros((batch.num_rows, 0))
                data = [[batch.num_rows], [x.tobytes()], [np.ascontiguousarray(y).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in data], names=["n", "x", "y"])

    # few rows of a batch are many when each is a vector
    return rows.select(vector_to_array(features).alias("_x"), *numbers).mapInArrow(work, "n long, x binary, y binary")


def block_of(row: Row, kind: type = np.float64) -> Block:
    """The matrices of a row of the packed table."""
    x, y = (np.frombuffer(row[c], t).reshape(row["n"], -1) for c, t in (("x", kind), ("y", np.float64)))
    return x, y


def as_blocks(blocks: DataFrame | RDD) -> RDD:
    return blocks if isinstance(blocks, RDD) else blocks.rdd.map(block_of)


def stored_blocks(rows: DataFrame, columns: list[str], features: str = "features") -> RDD:
    """Stored pairs of matrices of ``rows``, as ``packed`` makes them."""
    return as_blocks(packed(rows, columns, features)).persist(KEPT)


def summed_arrays(blocks: DataFrame | RDD, partial: Partial, tasks: int, size: int = 0) -> dict[int, np.ndarray]:
    """Sums, by key, of the flat arrays that ``partial`` gives for the blocks of each task.

    ``blocks`` is stored and read by ``tasks`` tasks. Beyond ``FAN_IN`` of them, groups of tasks are added
    up on the executors first; arrays that are said to have ``size`` numbers in all are added up there down
    to one per key.
    Arrays are added in the order of the tasks.
    """

    def work(part: int, found: Iterator[Block]) -> Iterator[tuple[tuple[int, int, int], tuple[int, np.ndarray]]]:
        total: dict[int, np.ndarray] = {}
        for key, values in partial(found):
            flat = np.ascontiguousarray(values, dtype=np.float64).ravel()
            total[key] = total[key] + flat if key in total else flat
        for key, flat in total.items():
            for i in range(0, max(1, len(flat)), SLICE):
                yield (part // fan_in, key, i // SLICE), (part, flat[i : i + SLICE])

    def again(found: Iterator[tuple[tuple[int, int, int], tuple[int, np.ndarray]]]) -> Iterator[tuple[tuple[int, int, int], tuple[int, np.ndarray]]]:
        for (part, key, at), values in _in_order(found).items():
            yield (part // fan_in, key, at), (part, values)

    fan_in = FAN_IN
    sums = as_blocks(blocks).mapPartitionsWithIndex(work)
    while tasks > (1 if size else fan_in):
        groups = math.ceil(tasks / fan_in)
        wanted = groups * math.ceil(size / SLICE) if size else fan_in
        sums, tasks = sums.partitionBy(max(1, min(tasks, wanted)), _place).mapPartitions(again), groups
    by_key: dict[int, list[np.ndarray]] = {}
    found = _in_order(((0, *key[1:]), value) for key, value in sums.collect())
    for (_, key, _), values in sorted(found.items(), key=lambda kv: kv[0]):
        by_key.setdefault(key, []).append(values)
    return {key: np.concatenate(parts) for key, parts in by_key.items()}


def _place(key: tuple[int, int, int]) -> int:
    return 31 * key[0] + 7 * key[1] + key[2]


def _in_order(found: Iterable[tuple[tuple[int, int, int], tuple[int, np.ndarray]]]) -> dict[tuple[int, int, int], np.ndarray]:
    """The sum of the arrays of each key, added in the order of their tasks."""
    held: dict[tuple[int, int, int], list[tuple[int, np.ndarray]]] = {}
    for key, value in found:
        held.setdefault(key, []).append(value)
    out = {}
    for key, values in held.items():
        values.sort(key=lambda v: v[0])
        out[key] = values[0][1].copy()
        for _, more in values[1:]:
            out[key] += more
    return out
