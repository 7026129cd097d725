"""Operator 1: token ids in Parquet list columns that can be read selectively.

Texts are encoded with a public tokenizer file, ordered by id and written as one table: a row holds
``doc_id``, ``n_tokens``, ``part`` (the file's number in id order), ``part_start`` (tokens before the
row in its file) and ``tokens``, a list column with dictionary encoding. Row groups and pages are of
a set size and every page has its minimum and maximum in the page index, so a reader that wants some
documents or only the metadata touches only their pages.

Results for odd input: a null or blank text has just the end id. Rows are ordered by ``doc_id``
(null first), rows of equal id by their text's hash; repeated rows are written as often as they
come. An empty table gives an empty table. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forerate.llm.common import blocks, buffers, mapped
from forerate.sources.staging import new_path, staged

#: Words are encoded so many at a time, with a special token between them.
CHUNK = 4096
#: Words whose ids a worker process remembers from block to block and task to task.
MEMORY = 300_000
ENCODE_BLOCK = 6 << 20
#: Rows of an Arrow batch where whole documents or their ids are sent.
BATCH_ROWS = 1_500
#: Sizes of the written files: a row group, a page (both in bytes), rows of a page at most.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 256 << 10, 512
ROWS = "doc_id long, part int, part_start long, n_tokens long, tokens array<int>"


class WordEncoder:
    """Ids of single words by a tokenizer that drops white space, so that words don't affect each other.

    Most words are letters with punctuation behind them. Their letters are one word to the tokenizer,
    and its lower-casing and splitting leave nothing to do but what is done here; so the distinct
    lower-cased letters go straight to its merges, and the distinct punctuation is encoded apart. All
    other words go through the whole tokenizer.
    """

    #: Punctuation that the tokenizer keeps together and apart from letters.
    TAIL = string.punctuation

    def __init__(self, path: str, separator: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        parts = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, dtype=bool)
        self.ends[[i for t, i in known.items() if t.endswith("</w>")]] = True
        self.separator, self.cut = separator, self.tokenizer.token_to_id(separator)
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256 and on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (i for i in range(256, 512))
        byte = {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}
        self.memory = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.shown = {c: "".join(byte[b] for b in chr(c).encode()) for c in range(128, 384)}

    def letters(self, some: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct lower-cased words of letters and how many each has.

        The first words that a worker sees are remembered: frequent words are soon among them.
        """
        known = pc.index_in(some, value_set=self.memory)
        missing = known.is_null()
        new = some.filter(missing)
        ids, sizes = self.merged(new.to_pylist())
        at = np.array(known.fill_null(0), dtype=np.int64)
        at[np.asarray(missing)] = len(self.sizes) + np.arange(len(new))
        ids, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        kept = min(len(new), MEMORY - len(self.memory))
        if kept > 0:
            self.memory = pa.concat_arrays([self.memory, new[:kept]])
            self.sizes = sizes[: len(self.memory)].copy()
            self.ids = ids[: int(self.sizes.sum())].copy()
        starts = np.cumsum(sizes) - sizes
        return gathered(ids, starts[at], sizes[at]), sizes[at]

    def merged(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters by the tokenizer's merges."""
        texts = [w if w.isascii() else w.translate(self.shown) for w in some]
        chunks = [texts[i : i + CHUNK] for i in range(0, len(texts), CHUNK)]
        coded = self.merges.encode_batch_fast(chunks, is_pretokenized=True, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, dtype=np.int32) for e in coded]) if coded else np.zeros(0, np.int32)
        return flat, np.diff(np.concatenate([[-1], np.flatnonzero(self.ends[flat])]))

    def others(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any words; a special token between them tells where one ends."""
        alone = [w for w in some if self.separator in w]
        if alone:
            coded = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype=np.int32) for w in some]
            return np.concatenate(coded), np.array([len(x) for x in coded], dtype=np.int64)
        chunks = [some[i : i + CHUNK] for i in range(0, len(some), CHUNK)]
        joined = [self.separator.join(c) + self.separator for c in chunks]
        coded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, dtype=np.int32) for e in coded]) if coded else np.zeros(0, np.int32)
        counts = np.diff(np.concatenate([[-1], np.flatnonzero(flat == self.cut)])) - 1
        return flat[flat != self.cut], counts

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each word has."""
        cores = pc.utf8_rtrim(words, self.TAIL)
        data, offsets = buffers(cores)
        plain = np.array(pc.and_not(pc.utf8_is_alpha(cores), pc.match_substring(cores, "\u0130")))
        beyond = np.flatnonzero(data >= 0xC6)  # bytes of letters from U+0180 on
        plain[np.searchsorted(offsets, beyond, side="right") - 1] = False
        lower = pc.utf8_lower(cores.filter(pa.array(plain))).dictionary_encode()
        # what is left: the punctuation behind letters, or the whole word
        done = np.where(plain, np.diff(offsets), 0)
        data, offsets = buffers(words)
        left = np.diff(offsets) - done
        ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
        rest = gathered(data, offsets[:-1] + done, left)
        rest = pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(rest)).dictionary_encode()
        flat, counts = self.letters(lower.dictionary)
        more, more_counts = self.others(rest.dictionary.to_pylist())
        ids = np.concatenate([flat, more])
        sizes = np.concatenate([counts, more_counts, [0]])  # the last for no head
        starts = np.cumsum(sizes) - sizes
        head = np.full(len(words), -1, dtype=np.int64)
        head[plain] = lower.indices
        pairs = np.stack([head, np.asarray(rest.indices, dtype=np.int64) + len(counts)], axis=1).ravel()
        return gathered(ids, starts[pairs], sizes[pairs]), sizes[pairs].reshape(-1, 2).sum(axis=1)


@lru_cache(maxsize=2)  # once per worker process
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[starts[i] : starts[i] + counts[i]]``."""
    total = int(counts.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts - np.cumsum(counts) + counts).astype(kind), counts)
    return flat[at]


def joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Small batches, those of short texts, put together until their texts have ``size`` bytes; others as they come."""
    held, total = [], 0
    for batch in batches:
        more = batch.column("text").nbytes
        if held and more >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += more
        if total >= size:
            yield pa.concat_batches(held) if len(held) > 1 else batch
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def encoder(path: str, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has one core; the library's threads, one for each core of the machine, would each keep memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words_of = word_encoder(path)
        before = 0
        for batch in blocks(joined(batches, ENCODE_BLOCK // 2), ENCODE_BLOCK):
            words = pc.ascii_split_whitespace(batch.column("text").fill_null(""))
            per_text = np.diff(words.offsets.to_numpy())
            coded = words.flatten().dictionary_encode()
            ids, counts = words_of.encode(coded.dictionary)
            # the end id is one more word, behind the words of every text
            ids, counts = np.append(ids, np.int32(end_id)), np.append(counts, 1)
            ends = np.cumsum(per_text)
            index = np.insert(np.asarray(coded.indices), ends, len(counts) - 1)
            starts = np.cumsum(counts) - counts
            word_counts = counts[index]
            tokens = gathered(ids, starts[index], word_counts)
            sums = np.cumsum(word_counts)[ends + np.arange(len(ends))]
            n = np.diff(np.concatenate([[0], sums]))
            offsets = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array(before + offsets[:-1], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.int32())),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "tokens"],
            )
            before += int(offsets[-1])

    return work


def encode(docs: DataFrame, tokenizer: str, end_id: int = 1, parts: int | None = None) -> DataFrame:
    """Token rows in ascending order of ``doc_id``, range partitioned; ``end_id`` ends every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    keys = ["doc_id", "tie"]
    rows = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    rows = rows.sortWithinPartitions(*keys)
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return mapped(rows, encoder(tokenizer, end_id), ROWS)


def write_tokens(encoded: DataFrame, path: str, row_group: int = ROW_GROUP, page: int = PAGE) -> str:
    """Write encoded rows with dictionary coding of the ids, delta coding of the rest and page indexes."""
    (
        encoded.write.option("parquet.block.size", row_group)
        .option("parquet.page.size", page)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#tokens.list.element", "true")
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("compression", "zstd")
        .parquet(path)
    )
    return path


def part_offsets(rows: DataFrame) -> DataFrame:
    """``part, part_offset``: the ids of all files before; files are summed first, so there is a row per file."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_offset"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each document's ids begin among all ids: reads the metadata columns only."""
    rows = spark.read.parquet(path).select("doc_id", "part", "part_start", "n_tokens")
    joined = rows.join(F.broadcast(part_offsets(rows)), "part")
    return joined.selectExpr("doc_id", "part", "part_start", "part_offset + part_start start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Token rows of the documents ``first`` to ``last``; the range reaches the page index."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    return rows if last is None else rows.where(F.col("doc_id") <= last)


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the crc32 of the ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        tokens = batch.column("tokens")
        values = np.asarray(tokens.values).astype("<i4", copy=False)
        offsets = np.asarray(tokens.offsets)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        kept = [batch.column(name) for name in ("doc_id", "part", "part_start", "n_tokens")]
        names = ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], names=names)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of fewer rows while a job runs: its rows are whole documents or all their ids."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written table: start, number and checksum of its ids, as read from the files."""
    schema = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"
    with small_batches(spark):
        rows = staged(mapped(read_tokens(spark, path), checksums, schema), "checksums")
    index = part_offsets(rows)
    return rows.join(F.broadcast(index), "part").selectExpr("doc_id", "part_offset + part_start start", "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str) -> str:
    """Encode and write into the shared folder; the path of the table."""
    with small_batches(docs.sparkSession):
        return write_tokens(encode(docs, tokenizer), new_path(docs.sparkSession, "tokens"))
