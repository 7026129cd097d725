"""Operator 13: centroid clustering with ns-bounds.

Lloyd's rounds on integer vectors, made exact and cheap by bounds. A vector keeps its distance to its
centroid and to every other one as of the round in which it was last evaluated, and that round's
number. All earlier centroids are retained, so a stored distance is loosened by the norm of the total
displacement of its centroid since then: how far the centroid is now from where it was. Summing the
drifts of all rounds in between would be looser, as a centroid that swings back has moved little. Where
the loosened bounds can't tell that another centroid is farther, the distances are evaluated exactly,
in whole numbers; ties go to the smaller number.

A round is one pass over the vectors: it reads the bounds and writes them anew, with the sums of the
vectors that moved, in one table of the shared folder; the one before is deleted. What reaches the
driver are k centroids. Their history is sent with the code of the tasks; when it grows beyond
``HISTORY_BYTES``, the bounds are loosened for good once and the history begins anew.

Results for odd input: a vector that is null, of another length, or with a component that is null or
not finite isn't kept. Components are cut to what ``LIMIT`` allows, as squared distances must fit into
a long. Vectors that are the same row are clustered each; an id that several rows share is drawn as
often as it comes, rows of equal hash in order of their components. With fewer vectors than ``k`` there
are fewer centroids, with none no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.llm.common import mapped, packed_lists
from forerate.sources.staging import delete, new_path, staged

#: Components are between this and its negative, so that a squared distance of 64 of them is a long.
LIMIT = 1 << 27
HISTORY_BYTES = 16 << 20
#: Vectors that are compared at a time.
ROWS = 8192
STATE = (
    "vec_id long, x array<int>, cluster int, upper double, upper_at int, lows array<double>, lows_at array<int>, "
    "moved long, shift array<long>"
)
NAMES = [c.split()[0] for c in STATE.split(", ")]


def integer_vectors(vectors: DataFrame, column: str, key: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, x``: kept vectors, each component as ``floor(scale * component)``."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    whole = F.transform(x, lambda v: F.greatest(F.least(F.floor(F.greatest(F.least(v * scale, F.lit(1e15)), F.lit(-1e15))), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias(column))
    return rows.where((F.size(column) == dims) & finite).select("vec_id", whole.alias("x"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the smallest hashes of seed and id, in their order."""
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(ident, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def square_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    apart = x - centroids
    return np.einsum("ij,ij->i", apart, apart)


def displacement(history: np.ndarray) -> np.ndarray:
    """``[j, s]``: how far centroid j is now from where it was in round s of the history."""
    return np.sqrt(((history - history[-1]) ** 2).sum(axis=2, dtype=np.float64)).T


class Bounds:
    """Clusters of a block of vectors with the distances last evaluated and when that was."""

    def __init__(self, x: np.ndarray, cluster, upper, upper_at, lows, lows_at):
        self.x, self.cluster, self.upper, self.upper_at = x, cluster, upper, upper_at
        self.lows, self.lows_at = lows, lows_at

    @classmethod
    def evaluated(cls, x: np.ndarray, centroids: np.ndarray, now: int) -> Bounds:
        """All distances."""
        square = np.stack([square_distances(x, c) for c in centroids], axis=1)
        cluster = square.argmin(axis=1)
        rows = np.arange(len(x))
        far = np.sqrt(square.astype(np.float64))
        return cls(x, cluster, far[rows, cluster], np.full(len(x), now), far, np.full(far.shape, now))

    def doubtful(self, rows: np.ndarray, gone: np.ndarray, start: int) -> np.ndarray:
        """Which centroids of the given rows aren't surely farther than the row's own."""
        k = np.arange(gone.shape[0])
        own = self.cluster[rows]
        most = self.upper[rows] + gone[own, self.upper_at[rows] - start]
        least = self.lows[rows] - gone[k, self.lows_at[rows] - start]
        maybe = least <= (most * (1 + 1e-9) + 1e-6)[:, None]
        maybe[np.arange(len(rows)), own] = False
        return maybe

    def renew(self, history: np.ndarray, start: int) -> np.ndarray:
        """Move every vector to its nearest centroid of the last round; the clusters before."""
        now, centroids, gone = start + len(history) - 1, history[-1], displacement(history)
        before = self.cluster.copy()
        rows = np.arange(len(self.x))
        rows = rows[self.doubtful(rows, gone, start).any(axis=1)]
        own = square_distances(self.x[rows], centroids[self.cluster[rows]])
        self.upper[rows], self.upper_at[rows] = np.sqrt(own.astype(np.float64)), now
        maybe = self.doubtful(rows, gone, start)
        nearest, least = self.cluster[rows].copy(), own.copy()
        for j in range(len(centroids)):
            at = np.flatnonzero(maybe[:, j])
            if not len(at):
                continue
            square = square_distances(self.x[rows[at]], centroids[j])
            self.lows[rows[at], j], self.lows_at[rows[at], j] = np.sqrt(square.astype(np.float64)), now
            closer = (square < least[at]) | ((square == least[at]) & (j < nearest[at]))
            nearest[at[closer]], least[at[closer]] = j, square[closer]
        went = np.flatnonzero(nearest != before[rows])
        some, left = rows[went], before[rows[went]]
        self.lows[some, left], self.lows_at[some, left] = self.upper[some], now
        self.cluster[some], self.upper[some] = nearest[went], np.sqrt(least[went].astype(np.float64))
        return before

    def settle(self, history: np.ndarray, start: int) -> None:
        """Loosen all bounds for good, as of the last round of the history."""
        gone, now, k = displacement(history), start + len(history) - 1, np.arange(history.shape[1])
        self.upper += gone[self.cluster, self.upper_at - start]
        self.lows -= gone[k, self.lows_at - start]
        self.upper_at[:], self.lows_at[:] = now, now


def matrix(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    return np.array(column.flatten(), dtype=kind).reshape(-1, width)


def one_round(history: np.ndarray, start: int, settled: bool):
    """State rows after a round; and per task and cluster a row with what ``moved`` in, and its sums."""
    k, dims = history.shape[1:]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved, shift = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                x = matrix(batch.column("x"), dims, np.int64)
                if "cluster" not in batch.schema.names:
                    state = Bounds.evaluated(x, history[-1], start + len(history) - 1)
                    came = np.arange(len(x))
                else:
                    numbers = [np.array(batch.column(c)) for c in ("cluster", "upper", "upper_at")]
                    state = Bounds(x, *numbers, matrix(batch.column("lows"), k, np.float64), matrix(batch.column("lows_at"), k, np.int64))
                    before = state.renew(history, start)
                    came = np.flatnonzero(before != state.cluster)
                    np.subtract.at(moved, before[came], 1)
                    np.subtract.at(shift, before[came], x[came])
                if settled:
                    state.settle(history, start)
                np.add.at(moved, state.cluster[came], 1)
                np.add.at(shift, state.cluster[came], x[came])
                n = len(x)
                columns = [
                    batch.column("vec_id"),
                    batch.column("x").cast(pa.list_(pa.int32())),
                    pa.array(state.cluster, pa.int32()),
                    pa.array(state.upper),
                    pa.array(state.upper_at, pa.int32()),
                    packed_lists(list(state.lows), pa.float64()),
                    packed_lists(list(state.lows_at), pa.int32()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)
        some = np.flatnonzero(moved | shift.any(axis=1))
        columns = [
            pa.nulls(len(some), pa.int64()),
            pa.nulls(len(some), pa.list_(pa.int32())),
            pa.array(some, pa.int32()),
            pa.nulls(len(some), pa.float64()),
            pa.nulls(len(some), pa.int32()),
            pa.nulls(len(some), pa.list_(pa.float64())),
            pa.nulls(len(some), pa.list_(pa.int32())),
            pa.array(moved[some]),
            packed_lists(list(shift[some]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return work


def squared(centroids: np.ndarray):
    """Every vector's exact squared distance to its centroid."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = np.asarray(batch.column("cluster"))
            x = matrix(batch.column("x"), centroids.shape[1], np.int64)
            columns = [batch.column("vec_id"), batch.column("cluster"), pa.array(square_distances(x, centroids[cluster]))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return work


def clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, column: str = "embedding", key: str = "vec_id"
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` (squared) of every kept vector, and the final centroids."""
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, column, key, dims, scale)
    history = first_centroids(whole, k, seed)[None]
    if not history.size:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), dtype=np.int64)
    counts, sums = [0] * history.shape[1], [[0] * dims for _ in range(history.shape[1])]
    state, path, start, done = whole, None, 0, False
    for _ in range(rounds):
        settled = history.nbytes > HISTORY_BYTES
        after = new_path(spark, "bounds")
        mapped(state, one_round(history, start, settled), STATE).write.parquet(after)
        if path:
            delete(spark, path)
        path, table = after, spark.read.schema(STATE).parquet(after)
        state = table.where("x is not null").drop("moved", "shift")
        change = table.where("moved is not null").select("cluster", "moved", F.posexplode("shift").alias("at", "by"))
        # exact sums, one row per cluster and component
        change = change.groupBy("cluster", "at").agg(F.sum(F.col("by").cast("decimal(38,0)")).alias("by"), F.sum("moved").alias("moved"))
        for r in change.collect():
            sums[r["cluster"]][r["at"]] += int(r["by"])
            counts[r["cluster"]] += r["moved"] if r["at"] == 0 else 0
        means = [[s // n for s in row] if n else c.tolist() for row, n, c in zip(sums, counts, history[-1], strict=True)]
        if settled:
            start, history = start + len(history) - 1, history[-1:]
        done = bool((history[-1] == means).all())
        if done:  # the vectors are where they belong, and nothing will move any more
            break
        history = np.concatenate([history, np.array(means, dtype=np.int64)[None]])
    if not done:
        state = mapped(state, one_round(history, start, False), STATE).where("x is not null")
    result = mapped(state.select("vec_id", "x", "cluster"), squared(history[-1]), "vec_id long, cluster int, distance long")
    result = staged(result, "clusters")
    if path:
        delete(spark, path)
    return result, history[-1]


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Clusters with the distances summed over each and over all, and a hash of the final centroid.

    Sums beyond the largest long stay there.
    """
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per centroid
    total, most = int(sum(r["s"] for r in each)), 2**63 - 1
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = [(r["cluster"], min(int(r["s"]), most), min(total, most), names[r["cluster"]]) for r in each]
    about = found.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
