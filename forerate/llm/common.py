"""Helpers of the text operators: Arrow blocks, word hashes in numpy, words in SQL, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.sources.staging import ship_package, staged

#: What separates words: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are hashed in blocks of about this many bytes; a longer text is a block of its own.
BLOCK = 4 << 20

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multipliers of the polynomial hashes, one pair per seed: bytes of a word, words of a window.
_BASES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices whose ``text`` has about ``size`` bytes.

    What Arrow has freed goes back to the system after each block, as it would otherwise be kept by every
    worker process, at work or idle.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column("text"))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            pa.default_memory_pool().release_unused()
            start = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return whole[first : int(offsets[-1])], offsets.astype(np.int64) - first


class Words:
    """The words of a block of texts: bytes, where each word starts and ends, and whose it is."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = buffers(texts)
        n = len(self.data)
        space = _SPACE[self.data]
        first = np.zeros(n + 1, dtype=bool)
        first[self.offsets] = True
        first = first[:n]
        self.space, self.first = space, first
        before = np.ones(n, dtype=bool)
        before[1:] = space[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = space[1:] | first[1:]
        self.starts = np.flatnonzero(~space & (before | first))
        self.ends = np.flatnonzero(~space & after) + 1
        #: ``bounds[d]`` is the index of the first word of text ``d``.
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        if not len(self.starts):
            return np.zeros(0, U64)
        data = _LOWER[self.data] if lower else self.data
        return span_hashes(data, self.starts, self.ends, seed)

    def windows(self, hashes: np.ndarray, length: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``length`` words from every word on, and whether they lie in one text."""
        n = len(hashes)
        inside = np.zeros(n, dtype=bool)
        if n >= length:
            inside[: n - length + 1] = self.text_of[: n - length + 1] == self.text_of[length - 1 :]
        return mix(folded(hashes, length, seed)), inside


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of disjoint, ascending byte spans."""
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASES[seed][0], dtype=U64))
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int32)
    values = data[place + np.repeat((starts - at).astype(np.int32), lengths)].astype(U64)
    values += U64(1)
    values *= powers[place - np.repeat(at.astype(np.int32), lengths)]
    filled = lengths > 0
    sums = np.zeros(len(starts), U64)
    if filled.any():
        sums[filled] = np.add.reduceat(values, at[filled])
    return mix(sums + lengths.astype(U64))


def folded(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Polynomial of the next ``length`` values at every place, by doubling; the tail counts zeros."""
    base = _BASES[seed][1]

    def ahead(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        if by < len(x):
            out[: len(x) - by] = x[by:]
        return out

    out, have, power = hashes.copy(), 1, base
    for bit in bin(length)[3:]:
        out, have, power = out * U64(power) + ahead(out, have), have * 2, power * power % 2**64
        if bit == "1":
            out, have, power = out * U64(base) + ahead(hashes, have), have + 1, power * base % 2**64
    return out


def shingle_sets(words: Words, hashes: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``length``-word shingles.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    grams, _ = words.windows(hashes, length)
    for d, n in enumerate(words.counts):
        a = words.bounds[d]
        if n >= length:
            some = np.sort(grams[a : a + n - length + 1])
            first = np.ones(len(some), dtype=bool)
            np.not_equal(some[1:], some[:-1], out=first[1:])
            yield some[first]
        elif n:
            yield mix(folded(hashes[a : a + n], int(n))[:1] + U64(n))
        else:
            yield np.zeros(0, U64)


def packed_lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one numpy array per row."""
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def words_sql(text: str, lower: bool = False) -> str:
    """SQL for the array of words of a column; null and blank texts have none."""
    bare = f"coalesce({text}, '')"
    if lower:
        bare = f"translate({bare}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"filter(split({bare}, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def free_names(taken: list[str], *names: str) -> list[str]:
    """``names``, each made longer until no column has it."""
    held = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        out.append(name)
    return out


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through Arrow batches, in tasks that can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``(a long, b long)``: rows ``(node, component)``.

    The component is its smallest node; every node of a link is returned. Alternating large-star and
    small-star steps, each written to the shared folder, so neither a hub nor a long chain meets in
    one task: a step is two aggregates and a join.
    """
    edges = staged(links.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.selectExpr("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) m")
        large = staged(both.join(least, "a").where("b > a").selectExpr("b a", "m b").distinct(), "large")
        down = large.selectExpr("greatest(a, b) a", "least(a, b) b").where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").selectExpr("b a", "m b").union(least.selectExpr("a", "m b"))
        edges = staged(small.where("a <> b").distinct(), "small")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.groupBy("a").agg(F.min("b").alias("b"))
    return roots.union(edges.select("b", "b").distinct().toDF("a", "b")).selectExpr("a node", "b component")
