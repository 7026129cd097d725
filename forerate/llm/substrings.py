"""Operator 9: substring dedup by level-wise doubling.

A word goes if a window of 50 consecutive words that covers it also starts in a document with a
smaller id. Windows are found level by level. At the first level a window is known by the smallest
hash among its 25-word parts, which any copy of the window has too; so few parts stand for all
windows, and parts of one text alone end there. Where a part repeats, the windows around it are
extended to twice its length and compared again, now as a whole, by 128 bits. With more levels this
goes on until no candidates survive. Copies of a whole text are found first, by the hash of their
words, and compared once.

Windows are judged on the input, not on what is left. Results for odd input: a null or blank text
has no words; texts shorter than a window keep all. Rows that share an id are one document and don't
shorten each other; rows without an id neither lose words nor count as earlier documents. Empty
tables give no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.llm.common import Words, blocks, folded, free_names, mapped, mix, packed_lists, signed
from forerate.sources.staging import staged

WINDOW, FIRST = 50, 25
#: Changed texts are sent to every executor up to so many rows, else joined by shuffle.
MAX_BROADCAST_TEXTS = 2_000


def lengths(window: int, first: int) -> list[int]:
    """Lengths of the levels: from ``first`` on each at most twice the one before, up to ``window``."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def part_keys(words: Words, hashes: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For the window from every word on: the least hash of its ``length``-word parts; and if it is one."""
    _, valid = words.windows(hashes, window)
    least = mix(folded(hashes, length))
    span, have = window - length + 1, 1
    while have < span:
        by = min(have, span - have)
        ahead = np.full_like(least, np.iinfo(np.uint64).max)
        ahead[: max(0, len(least) - by)] = least[by:]
        least = np.minimum(least, ahead)
        have += by
    return signed(least), valid


def first_level(window: int, length: int):
    """Per document: number and hash of its words, their SHA-256, distinct keys of its windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            words = Words(batch.column("text"))
            keys, valid = part_keys(words, words.hashes(), length, window)
            found, digest, same, bare = [], [], [], words.data.tobytes()
            for d, n in enumerate(words.counts):
                a = words.bounds[d]
                full = hashlib.sha256(b" ".join(bare[words.offsets[d] : words.offsets[d + 1]].split())).digest()
                digest.append(full.hex())
                same.append(int.from_bytes(full[:8], "little", signed=True))
                found.append(np.unique(keys[a : a + n][valid[a : a + n]]))
            columns = [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(words.counts, pa.int64()),
                pa.array(same, pa.int64()),
                pa.array(digest, pa.string()),
                packed_lists(found, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_words", "same", "kept_sha256", "keys"])

    return work


def candidate_places(batch: pa.RecordBatch, words: Words, hashes: np.ndarray, length: int, window: int) -> list[np.ndarray]:
    """Per document: starts of the windows whose key at ``length`` is among its ``keys``."""
    now, valid = part_keys(words, hashes, length, window)
    values, offsets = np.asarray(batch.column("keys").values), np.asarray(batch.column("keys").offsets)
    out = []
    for d, n in enumerate(words.counts):
        a = words.bounds[d]
        out.append(np.flatnonzero(valid[a : a + n] & np.isin(now[a : a + n], values[offsets[d] : offsets[d + 1]])))
    return out


def next_level(window: int, before: int, length: int):
    """Per document: distinct keys at ``length`` of its candidate windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            words = Words(batch.column("text"))
            hashes = words.hashes()
            new, _ = part_keys(words, hashes, length, window)
            places = candidate_places(batch, words, hashes, before, window)
            keys = [np.unique(new[words.bounds[d] + at]) for d, at in enumerate(places)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), packed_lists(keys, pa.int64())], names=["doc_id", "mark", "keys"]
            )

    return work


def whole_windows(window: int, before: int):
    """A row per candidate window: its 128-bit hash and the place of its first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            words = Words(batch.column("text"))
            hashes = words.hashes()
            places = candidate_places(batch, words, hashes, before, window)
            index = pa.array(np.repeat(np.arange(len(places)), [len(x) for x in places]))
            at = np.concatenate([words.bounds[d] + x for d, x in enumerate(places)])
            one = signed(mix(folded(hashes, window)))
            two = signed(mix(folded(words.hashes(seed=1), window, seed=1)))
            columns = [
                batch.column("doc_id").take(index),
                batch.column("mark").take(index),
                pa.array(one[at], pa.int64()),
                pa.array(two[at], pa.int64()),
                pa.array(np.concatenate(places), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "h1", "h2", "place"])

    return work


def with_small(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Documents with what a staged table has of them, sent to every executor up to eight million numbers."""
    lists = [c for c, t in table.dtypes if t.startswith("array")]
    numbers = sum((F.coalesce(F.sum(F.size(c)), F.lit(0)) for c in lists), F.count("*"))
    return lookup(docs, table, ["doc_id", "mark"], table.agg(numbers).first()[0] // 8, "inner")


def repeated_starts(docs: DataFrame, firsts: DataFrame, window: int, first: int) -> DataFrame:
    """``doc_id, mark, places``: where in a document windows start that also start in an earlier one.

    ``docs`` has ``doc_id, mark, text``, ``firsts`` the first level of one document of every text.
    """
    parts = lengths(window, first)[:-1] or [window]
    keyed = firsts.select("doc_id", "mark", F.explode("keys").alias("key"))
    for before, length in zip(parts, [*parts[1:], None], strict=True):
        shared = keyed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        shared = shared.where("low < high").select("key")
        kept = keyed.join(shared, "key").groupBy("doc_id", "mark").agg(F.collect_set("key").alias("keys"))
        texts = with_small(docs, staged(kept, "repeats")).select("doc_id", "mark", "text", "keys")
        if length:
            keyed = staged(mapped(texts, next_level(window, before, length), "doc_id long, mark long, keys array<long>"), "level")
            keyed = keyed.select("doc_id", "mark", F.explode("keys").alias("key"))
    windows = mapped(texts, whole_windows(window, parts[-1]), "doc_id long, mark long, h1 long, h2 long, place int")
    windows = staged(windows, "windows")
    lowest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    again = windows.join(lowest.where("low < high").select("h1", "h2", "low"), ["h1", "h2"]).where("low < doc_id")
    return again.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))


def covered(places: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``places``."""
    ends = np.zeros(n + 1, dtype=np.int64)
    starts = np.unique(places)
    starts = starts[starts + window <= n]
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + window, -1)
    return np.cumsum(ends[:-1]) > 0


def cutter(window: int):
    """Per document: what is left as text, with the white space after each kept word; counts and SHA-256."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            words = Words(batch.column("text"))
            places = batch.column("places").fill_null([]) if batch.column("places").null_count else batch.column("places")
            values, offsets = np.asarray(places.values), np.asarray(places.offsets)
            bare = words.data.tobytes()
            removed, digest, texts = [], [], []
            for d, n in enumerate(words.counts):
                a, begin, end = words.bounds[d], int(words.offsets[d]), int(words.offsets[d + 1])
                gone = covered(values[offsets[d] : offsets[d + 1]], int(n), window)
                starts, ends = words.starts[a : a + n], words.ends[a : a + n]
                edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))  # runs of kept words
                runs = list(zip(edges[::2], edges[1::2], strict=True))
                cuts = [bare[starts[i] : (starts[j] if j < n else end)] for i, j in runs]
                digest.append(hashlib.sha256(b" ".join(b" ".join(bare[starts[i] : ends[j - 1]].split()) for i, j in runs)).hexdigest())
                left = b"".join(cuts) if gone.any() else bare[begin:end]
                texts.append(left.decode())
                removed.append(int(gone.sum()))
            columns = [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(removed, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array(texts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_removed", "kept_sha256", "text"])

    return work


CUT = "doc_id long, mark long, n_removed long, kept_sha256 string, text string"


def plain(docs: DataFrame) -> DataFrame:
    """Id, text, and the hash of the text, which together with the id names a row."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))


def found(docs: DataFrame, window: int, first: int) -> tuple[DataFrame, DataFrame]:
    """The first level of all rows with ``earliest``, the least id that has their words; repeated starts."""
    work = first_level(window, lengths(window, first)[0])
    schema = "doc_id long, mark long, n_words long, same long, kept_sha256 string, keys array<long>"
    rows = staged(mapped(docs, work, schema), "texts")
    least = staged(rows.groupBy("same", "n_words").agg(F.min("doc_id").alias("earliest")), "earliest")
    marked = lookup(rows, least, ["same", "n_words"], least.count(), "inner")
    firsts = marked.where("size(keys) > 0 and doc_id = earliest")
    starts = repeated_starts(docs.where("doc_id is not null"), firsts, window, first)
    return marked.drop("keys", "same"), staged(starts, "starts")


def cut_texts(docs: DataFrame, starts: DataFrame, window: int) -> DataFrame:
    """The rows that lose words, as ``CUT``; repeated rows once."""
    return mapped(with_small(docs, starts).select("doc_id", "mark", "text", "places"), cutter(window), CUT)


def substring_digest(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    docs = plain(docs)
    rows, starts = found(docs, window, first)
    cut = cut_texts(docs, starts, window).select("doc_id", "mark", F.col("n_removed").alias("cut"), F.col("kept_sha256").alias("left"))
    cut = staged(cut.dropDuplicates(["doc_id", "mark"]), "cut")
    out = lookup(rows, cut, ["doc_id", "mark"], cut.count(), "left")
    copy = (F.col("doc_id") > F.col("earliest")) & (F.col("n_words") >= window)
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("left", "kept_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """The documents, all columns, with the text that is left; ``n_chars``, if there, is counted anew."""
    bare = plain(docs)
    rows, starts = found(bare, window, first)
    ident, mark, text = free_names(docs.columns, "_doc", "_mark", "_text")
    cut = cut_texts(bare, starts, window).select("doc_id", "mark", "text")
    copies = rows.where((F.col("doc_id") > F.col("earliest")) & (F.col("n_words") >= window))
    left = cut.union(copies.select("doc_id", "mark", F.lit("").alias("text"))).dropDuplicates(["doc_id", "mark"])
    left = staged(left.toDF(ident, mark, text), "left")
    if left.count() <= MAX_BROADCAST_TEXTS:
        left = F.broadcast(left)
    out = docs.join(left, (docs["doc_id"] == F.col(ident)) & (F.xxhash64(docs["text"]) == F.col(mark)), "left")
    changed = {"text": F.coalesce(text, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(text).isNotNull(), F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*docs.columns)
