"""Operator 2: Jaccard self-join on word n-grams by rare-first prefix filtering.

A document's set is its distinct n-word shingles, as 64-bit hashes. Sets are ordered by how often a
shingle's hash bucket occurs, rarest first, ties by hash, the same for all documents. Two sets as
similar as asked share a shingle among the first ``n - ceil(t n) + 1`` of each, so only those are
joined. A pair of sets that meet there is kept if their lengths allow the similarity, if the places
where they meet do, and if the sizes of the parts cut by fixed pivots do (the suffix filter). What is
left is verified once per pair on the whole sets.

A prefix shingle shared by many sets doesn't become all their pairs. The set that has it first in
its order is the pivot; the others are compared with the pivot, and links are joined to components.
Where members of one shingle still lie in several components, pairs between components are compared
too, so no link that matters to the components is lost. Equal sets are one set throughout.

Results for odd input: a null or blank text has an empty set, linked with nothing, and is its own
component; a text of fewer words than n has one shingle, all its words. Rows that share an id are one
node of the links, and each row is returned. A row without an id has no component. Empty tables give
no rows; other columns of the input are ignored. A very long text is a block of its own, and its set is
handled whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.llm.common import U64, Words, blocks, components, free_names, mapped, shingle_sets, signed
from forerate.sources.staging import scratch, staged

#: Bits of a shingle's hash that name its bucket in the order.
ORDER_BITS = 18
#: The suffix filter cuts a set into parts of about so many shingles, a power of two.
PART_BITS = 3
SETS = "doc_id long, n long, s long, parts binary, bucket int, seen long"


def set_hash(shingles: np.ndarray) -> int:
    """A 64-bit hash of a sorted set."""
    return int.from_bytes(hashlib.blake2b(shingles, digest_size=8).digest(), "little", signed=True)


def sets_of(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    text = Words(batch.column("text"))
    return shingle_sets(text, text.hashes(lower=True), words)


def part_sizes(shingles: np.ndarray) -> bytes:
    """How many of a set's shingles lie between fixed pivots, as 32-bit numbers."""
    bits = max(1, len(shingles).bit_length() - 1 - PART_BITS)
    counts = np.bincount((shingles >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype("<u4").tobytes()


def least_apart(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their part sizes."""
    a, b = (np.frombuffer(v, dtype="<u4").astype(np.int64) for v in (x, y))
    if len(a) < len(b):
        a, b = b, a
    return int(np.abs(a.reshape(len(b), -1).sum(axis=1) - b).sum())


def describe(words: int, bits: int):
    """Rows of two kinds: a document's size, set hash and part sizes; a task's counts of a bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, dtype=np.int64)
        for batch in blocks(batches):
            sets = list(sets_of(batch, words))
            n, s = [len(x) for x in sets], [set_hash(x) for x in sets]
            seen += np.bincount((np.concatenate(sets) >> U64(64 - bits)).astype(np.int64), minlength=len(seen))
            rows = len(n)
            columns = [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(s, pa.int64()),
                pa.array([part_sizes(x) for x in sets], pa.binary()),
                pa.nulls(rows, pa.int32()),
                pa.nulls(rows, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "s", "parts", "bucket", "seen"])
        used = np.flatnonzero(seen)
        for at in range(0, len(used), 1 << 16):
            some = used[at : at + (1 << 16)]
            columns = [
                pa.nulls(len(some), pa.int64()),
                pa.nulls(len(some), pa.int64()),
                pa.nulls(len(some), pa.int64()),
                pa.nulls(len(some), pa.binary()),
                pa.array(some, pa.int32()),
                pa.array(seen[some], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "s", "parts", "bucket", "seen"])

    return work


def prefixes(words: int, bits: int, percent: int, counts: np.ndarray):
    """Rows ``(h, s, pn)`` of the prefix shingles of every set; ``pn`` packs place and set size.

    A task emits a set once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in blocks(batches):
            out: list[tuple[np.ndarray, int]] = []
            for x in sets_of(batch, words):
                n = len(x)
                if not n:
                    continue
                s = set_hash(x)
                if s in done:
                    continue
                done.add(s)
                rare = np.argsort(counts[(x >> U64(64 - bits)).astype(np.int64)], kind="stable")
                out.append((x[rare[: n - -(-percent * n // 100) + 1]], s, n))
            if not out:
                continue
            sizes = [len(x) for x, _, _ in out]
            place = np.concatenate([np.arange(k, dtype=np.int64) for k in sizes])
            n = np.repeat(np.array([n for _, _, n in out], dtype=np.int64), sizes)
            columns = [
                pa.array(signed(np.concatenate([x for x, _, _ in out])), pa.int64()),
                pa.array(np.repeat(np.array([s for _, s, _ in out], dtype=np.int64), sizes), pa.int64()),
                pa.array((place << 32) | n, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "s", "pn"])

    return work


def whole_sets(words: int):
    """Rows ``(s, n, shingles)`` with the set as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            found = [(set_hash(x), len(x), x.tobytes()) for x in sets_of(batch, words) if len(x)]
            if found:
                s, n, data = zip(*found, strict=True)
                columns = [pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["s", "n", "shingles"])

    return work


def verify(percent: int):
    """Pairs of sets as bytes whose similarity is enough, as ``(x, y)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("xs"), batch.column("ys"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), U64), np.frombuffer(b.as_buffer(), U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            rows = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in ("x", "xn", "y", "yn")], names=["x", "xn", "y", "yn"])

    return work


def near_enough(percent: int):
    """Suffix filter: pairs whose part sizes leave the similarity possible."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.asarray(batch.column("xn")) + np.asarray(batch.column("yn"))
            parts = zip(batch.column("x_parts").to_pylist(), batch.column("y_parts").to_pylist(), strict=True)
            apart = np.fromiter((least_apart(x, y) for x, y in parts), dtype=np.int64, count=len(total))
            rows = pa.array(np.flatnonzero((100 + percent) * (total - apart) >= 2 * percent * total))
            names = ["x", "xn", "x_doc", "y", "yn", "y_doc"]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in names], names=names)

    return work


def may_link(percent: int) -> Column:
    """Length and positional filter for rows with ``pn`` and ``qn``: places and sizes of both sets."""
    size = F.lit(0xFFFFFFFF)
    n, m = F.col("pn").bitwiseAND(size), F.col("qn").bitwiseAND(size)
    behind = F.least(n - F.shiftright("pn", 32), m - F.shiftright("qn", 32))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * behind >= percent * (n + m))


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(x, xn, y, yn)`` among the distinct pairs of sets, after suffix filter and verification.

    ``sets`` has one row ``(s, n, doc_id, parts)`` per set.
    """

    def named(prefix: str) -> DataFrame:
        return sets.select(*(F.col(c).alias(prefix + t) for c, t in (("s", ""), ("n", "n"), ("doc_id", "_doc"), ("parts", "_parts"))))

    pairs = pairs.join(named("x"), ["x", "xn"]).join(named("y"), ["y", "yn"])
    schema = "x long, xn long, x_doc long, y long, yn long, y_doc long"
    pairs = staged(mapped(pairs.select("x", "xn", "x_doc", "x_parts", "y", "yn", "y_doc", "y_parts"), near_enough(percent), schema), "pairs")
    asked = staged(pairs.selectExpr("x_doc doc_id").union(pairs.selectExpr("y_doc")).distinct(), "asked")
    texts = lookup(docs, asked, ["doc_id"], asked.count(), "inner").select("text")
    held = staged(mapped(texts, whole_sets(words), "s long, n long, shingles binary"), "sets")
    both = pairs.join(held.toDF("y", "yn", "ys"), ["y", "yn"]).join(held.toDF("x", "xn", "xs"), ["x", "xn"])
    schema = "x long, xn long, y long, yn long"
    return staged(mapped(both.select("x", "xn", "xs", "y", "yn", "ys"), verify(percent), schema), "verified")


def linked_sets(docs: DataFrame, words: int, percent: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, s, parts`` of every row, and ``s, n, doc_id, component`` of every set."""
    rows = staged(mapped(docs, describe(words, bits), SETS), "described")
    counts = np.zeros(1 << bits, dtype=np.int64)
    buckets = rows.where("bucket is not null").groupBy("bucket").agg(F.sum("seen").alias("seen")).toPandas()
    counts[buckets["bucket"].to_numpy()] = buckets["seen"].to_numpy()

    rows = rows.where("bucket is null").drop("bucket", "seen")
    known = rows.where("n > 0 and doc_id is not null")
    sets = staged(known.groupBy("s", "n").agg(F.min("doc_id").alias("doc_id"), F.first("parts").alias("parts")), "classes")

    prefix = mapped(docs.where("doc_id is not null"), prefixes(words, bits, percent, counts), "h long, s long, pn long")
    prefix = staged(prefix, "prefixes")
    first = prefix.groupBy("h").agg(F.min("pn").alias("qn"), F.min_by("s", "pn").alias("q"))
    met = staged(prefix.join(first, "h").where("s <> q").distinct(), "met")
    size = "& 4294967295"

    def paired(rows: DataFrame) -> DataFrame:
        rows = rows.where(may_link(percent))
        low, high = f"if(s < q, pn, qn) {size} xn", f"if(s < q, qn, pn) {size} yn"
        return rows.selectExpr("least(s, q) x", low, "greatest(s, q) y", high).distinct()

    pairs = paired(met)
    links = verified(pairs, sets, docs, words, percent)
    parts = staged(set_components(links, sets), "parts")

    # members of one shingle that are still apart, with the pivot as one of them
    label = parts.select(F.col("doc_id").alias("c"), "s", "n", "component")
    members = met.select("h", "s", "pn").union(met.selectExpr("h", "q", "qn")).distinct().withColumn("n", F.expr(f"pn {size}"))
    members = members.join(label, ["s", "n"]).select("h", "s", "pn", "component")
    spread = members.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("h")
    # sets that may link are of one length band or of neighbouring ones
    band = F.floor(F.log(F.expr(f"pn {size}").cast("double")) / math.log(100 / percent + 1e-9)).cast("long")
    members = staged(members.join(spread, "h").withColumn("band", band), "apart")
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
    other = members.select("h", F.col("s").alias("q"), F.col("pn").alias("qn"), F.col("component").alias("other"), near)
    members, other = members.alias("m"), other.alias("o")
    same = (F.col("m.h") == F.col("o.h")) & (F.col("m.band") == F.col("o.band"))
    apart = members.join(other, same & (F.col("component") < F.col("other")) & may_link(percent)).select("m.h", "s", "pn", "q", "qn")
    apart = paired(apart)
    more = verified(apart.join(pairs, ["x", "xn", "y", "yn"], "left_anti"), sets, docs, words, percent)
    parts = set_components(links.union(more), sets)
    return rows, parts


def classes(docs: DataFrame, words: int, percent: int, bits: int = ORDER_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; similar are sets with ``percent`` per cent."""
    with scratch(docs.sparkSession) as keep:
        rows, parts = linked_sets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words, percent, bits)
        rows, parts = keep(rows.select("doc_id", "s", "n"), "described"), keep(parts, "parts")
    out = rows.join(parts.select("s", "n", "component"), ["s", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def set_components(links: DataFrame, sets: DataFrame) -> DataFrame:
    """``s, n, doc_id, component`` of every set; the component is its smallest ``doc_id``."""
    ids = sets.select("s", "n", "doc_id")
    named = links.join(ids.toDF("x", "xn", "a"), ["x", "xn"]).join(ids.toDF("y", "yn", "b"), ["y", "yn"]).select("a", "b")
    found = components(named)
    out = ids.join(found, ids["doc_id"] == found["node"], "left")
    return out.select("s", "n", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns: of each group of alike texts the one with the smallest id.

    Rows are named by id and text, so of rows that share an id each text counts by itself; in a group,
    equal ids are ordered by their texts' hashes. Rows that repeat an id and text are kept once; rows
    without an id all are. Links are looked for under 64-bit names; rows whose names collide all stay.
    """
    ident, mark = free_names(docs.columns, "_doc", "_mark")
    key = [F.col("doc_id").cast("long").alias(ident), F.unhex(F.md5(F.col("text").cast("binary"))).alias(mark)]
    name = F.xxhash64(ident, F.coalesce(mark, F.lit(b"")))
    bare = docs.select(*key, "text").where(F.col(ident).isNotNull()).withColumn(mark, F.coalesce(mark, F.lit(b"")))
    rows = staged(bare.groupBy(ident, mark).agg(F.count("*").alias("rows")).withColumn("name", name), "rows")
    found = classes(bare.select(name.alias("doc_id"), "text"), words, percent)
    found = staged(found.selectExpr("doc_id name", "component_id").distinct(), "components")
    placed = rows.join(found, "name")
    firsts = placed.groupBy("component_id").agg(F.min(F.struct(ident, mark)).alias("first"))
    clash = staged(rows.groupBy("name").count().where("count > 1").select("name"), "clash")
    gone = placed.join(firsts, "component_id").where(F.struct(ident, mark) != F.col("first"))
    gone = staged(lookup(gone, clash, ["name"], clash.count(), "left_anti").select(ident, mark), "gone")
    twice = staged(rows.where("rows > 1").select(ident, mark), "twice")
    named = docs.withColumns({ident: key[0], mark: F.coalesce(key[1], F.lit(b""))})
    left = lookup(named, gone, [ident, mark], gone.count(), "left_anti")
    if twice.isEmpty():
        return left.select(*docs.columns)
    n = twice.count()
    single = lookup(left, twice, [ident, mark], n, "left_anti")
    again = lookup(left, twice, [ident, mark], n, "left_semi").dropDuplicates([ident, mark])
    return single.select(*docs.columns).union(again.select(*docs.columns))
