"""Operator 6: quality rules with cross-document line frequency.

Base rules look at one document: too few words, or too many of them in repeated three-word windows.
The method looks at lines across the documents of a host. Lines are normalised (A to Z lower-cased,
words joined by one space) and hashed; a line found in ``max_docs`` distinct documents of a host or
more is boilerplate and removed; a document that keeps less than ``min_left`` of its words is
depleted and rejected.

Distinct documents are meant by content, or a clean text would go for being copied often: copies of a
text count once. Near copies of a text are the same case. The lines of a large group of them are all
above the limit, so a text is compared with others if ``MOST`` of its words are in such lines; of texts
linked by a Jaccard similarity of ``ALIKE_PERCENT`` or more of their whole sets of three-word shingles
one counts. Texts less alike count one by one, whatever share of their words the lines make up.

Counting combines on the map side, only lines above the limit are joined back, and no line or host meets
in one task. Results for odd input: a null or blank text has no words and fails the base rules; a null
host is a host of its own; repeated rows get equal results; a null id stays null; a very long text is
measured whole, as a block of its own. Empty tables give no rows; other columns of the input are kept by
``kept_documents`` and ignored by ``judged``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.llm import ngram_join
from forerate.llm.common import U64, Words, blocks, free_names, mapped, mix, packed_lists, signed, span_hashes
from forerate.sources.staging import staged

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line in so many distinct documents of a host is boilerplate; the share of words a document must keep.
MAX_DOCS, MIN_LEFT = 50, 0.3
#: Texts whose sets of so many words' shingles are so similar count as one document.
ALIKE_WORDS, ALIKE_PERCENT = 3, 80
#: Share of a text's words in lines above the limit from which on it may be a near copy of others.
MOST = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
MEASURED = (
    "doc_id long, host_key long, mark binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<long>, line_words array<int>"
)


class Lines:
    """The lines of a block of texts: bounds, whose they are, words in them, normalised hash."""

    def __init__(self, words: Words):
        data, n = words.data, len(words.data)
        breaks = np.flatnonzero(data == 10)
        filled = np.flatnonzero(np.diff(words.offsets) > 0)
        self.starts = np.unique(np.concatenate([words.offsets[filled], breaks + 1]))
        self.starts = self.starts[self.starts < n]
        after = np.append(self.starts[1:], n)
        last_break = (after > 0) & (data[np.maximum(after - 1, 0)] == 10) if n else np.zeros(0, bool)
        self.ends = np.maximum(after - last_break, self.starts)
        self.text_of = np.searchsorted(words.offsets, self.starts, side="right") - 1
        self.first_word = np.searchsorted(words.starts, self.starts)
        self.n_words = np.diff(np.append(self.first_word, len(words.starts)))

    def normalised(self, hashes: np.ndarray) -> np.ndarray:
        """One hash of the words of every line that has words, in their order."""
        has = self.n_words > 0
        firsts, sizes = self.first_word[has], self.n_words[has]
        if not len(firsts):
            return np.zeros(0, U64)
        powers = np.cumprod(np.full(int(sizes.max()), 0xC2B2AE3D27D4EB4F, dtype=U64))
        within = np.arange(len(hashes)) - np.repeat(firsts, sizes)
        return mix(np.add.reduceat(hashes * powers[within], firsts) + sizes.astype(U64))


def repeated(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (group, value) pairs occur more than once, and which of those aren't the first."""
    order = np.lexsort((value, group))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    again, several = np.zeros(len(order), dtype=bool), same.copy()
    several[:-1] |= same[1:]
    again[order], out = same, np.zeros(len(order), dtype=bool)
    out[order] = several
    return out, again


def per_text(words: Words, where: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(where, weights=weights, minlength=len(words.counts)).astype(np.int64)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        words = Words(batch.column("text"))
        text_at = np.repeat(np.arange(len(words.counts)), np.diff(words.offsets))
        in_word = ~words.space & ((words.data & 0xC0) != 0x80)
        lines = Lines(words)
        with_word = lines.n_words > 0
        owner = lines.text_of[with_word]
        _, again = repeated(owner, span_hashes(words.data, lines.starts, lines.ends)[with_word])
        grams, inside = words.windows(words.hashes(), 3)
        several = np.zeros(len(grams), dtype=bool)
        several[inside] = repeated(words.text_of[inside], grams[inside])[0]
        covered = several.copy()
        covered[1:] |= several[:-1]
        covered[2:] |= several[:-2]
        host = np.asarray(batch.column("host_key")).astype(np.int64).view(U64)
        keys = signed(mix(lines.normalised(words.hashes(lower=True)) ^ mix(host[owner])))
        sizes = lines.n_words[with_word]
        order = np.lexsort((keys, owner))
        found, counts = [], []
        bounds = np.searchsorted(owner[order], np.arange(len(words.counts) + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            some = order[a:b]
            distinct, at = np.unique(keys[some], return_index=True)
            found.append(distinct)
            counts.append(np.add.reduceat(sizes[some], at).astype(np.int32) if len(at) else np.zeros(0, np.int32))
        columns = [
            batch.column("doc_id"),
            batch.column("host_key"),
            batch.column("mark"),
            pa.array(words.counts, pa.int64()),
            pa.array(per_text(words, text_at[in_word]), pa.int64()),
            pa.array(per_text(words, text_at[_SYMBOL[words.data]]), pa.int64()),
            pa.array(per_text(words, owner[again]), pa.int64()),
            pa.array(per_text(words, words.text_of[covered]), pa.int64()),
            packed_lists(found, pa.int64()),
            packed_lists(counts, pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MEASURED.split(", ")])


def text_mark() -> Column:
    """128 bits that name a text; a null text is named like an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def measured(docs: DataFrame, host: str) -> DataFrame:
    """Base measures and distinct lines of every row. ``mark`` is the hash of the text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col(host).cast("string")).alias("host_key"),
        text_mark().alias("mark"),
        F.col("text").cast("string").alias("text"),
    )
    return staged(mapped(rows, measure, MEASURED), "measured")


def boilerplate(rows: DataFrame, docs: DataFrame, max_docs: int) -> DataFrame:
    """``host_key, mark, key, size`` of the lines that ``max_docs`` distinct texts of the host or more have.

    Copies fold before they are counted, text by text, so neither a line nor a text meets in one task.
    """
    lines = rows.select("host_key", "mark", "n_words", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    lines = lines.select("host_key", "mark", "n_words", F.col("l.lines").alias("key"), F.col("l.line_words").alias("size"))
    counted = lines.select("key", "mark").distinct().groupBy("key").count()
    often = staged(counted.where(F.col("count") >= max_docs), "often")
    size = often.count()
    held = staged(lookup(lines, often, ["key"], size, "inner").distinct(), "held")
    # near copies lower the count of a line; most of what they have is in lines above the limit
    most = held.groupBy("host_key", "mark", "n_words").agg(F.sum("size").alias("size")).where(F.col("size") >= MOST * F.col("n_words"))
    most = staged(most.select("mark").distinct(), "most")
    n_texts = most.count()
    if not n_texts:
        return held.drop("n_words", "count")
    whole = docs.select(text_mark().alias("mark"), F.col("text").cast("string").alias("text"))
    whole = lookup(whole, most, ["mark"], n_texts, "left_semi").dropDuplicates(["mark"])
    whole = staged(whole.withColumn("doc_id", F.xxhash64("mark")), "compared")
    alike = ngram_join.classes(whole.select("doc_id", "text"), ALIKE_WORDS, ALIKE_PERCENT)
    alike = staged(whole.select("mark", "doc_id").join(alike, "doc_id").select("mark", "component_id"), "alike")
    spare = lookup(held.select("key", "mark").distinct(), alike, ["mark"], n_texts, "inner")
    spare = staged(spare.groupBy("key").agg((F.count("*") - F.count_distinct("component_id")).alias("spare")), "spare")
    often = lookup(often, spare, ["key"], spare.count(), "left").where(F.col("count") - F.coalesce("spare", F.lit(0)) >= max_docs)
    often = staged(often.select("key"), "often")
    return staged(lookup(held.drop("n_words", "count"), often, ["key"], often.count(), "inner"), "cut")


def verdicts(rows: DataFrame, docs: DataFrame, max_docs: int, min_left: float) -> tuple[DataFrame, DataFrame]:
    """Measured rows with ``base_failed``, ``n_cut`` (words in removed lines) and ``kept``; the removed lines."""
    cut = boilerplate(rows, docs, max_docs)
    cut = staged(cut.groupBy("host_key", "mark").agg(F.sum("size").alias("n_cut"), F.collect_set("key").alias("cut_lines")), "cut-lines")
    out = lookup(rows.drop("lines", "line_words"), cut.select("host_key", "mark", "n_cut"), ["host_key", "mark"], cut.count(), "left")
    out = out.withColumn("n_cut", F.coalesce("n_cut", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_cut") < min_left * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted), cut


def judged(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """Measures and verdict of every row."""
    out, _ = verdicts(measured(docs, host), docs, max_docs, min_left)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_cut"
    )


def line_cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines named in ``cut_lines``; the other lines stay as they are."""
    for batch in blocks(batches):
        words = Words(batch.column("text"))
        lines = Lines(words)
        host = np.asarray(batch.column("host_key")).astype(np.int64).view(U64)
        keys = np.zeros(len(lines.starts), dtype=np.int64)
        has = lines.n_words > 0
        keys[has] = signed(mix(lines.normalised(words.hashes(lower=True)) ^ mix(host[lines.text_of[has]])))
        cut = batch.column("cut_lines")
        values, offsets = np.asarray(cut.values), np.asarray(cut.offsets)
        bare = words.data.tobytes()
        bounds = np.searchsorted(lines.text_of, np.arange(len(words.counts) + 1))
        texts = []
        for d in range(len(words.counts)):
            at = np.arange(bounds[d], bounds[d + 1])
            at = at[~(has[at] & np.isin(keys[at], values[offsets[d] : offsets[d + 1]]))]
            texts.append(b"\n".join(bare[lines.starts[i] : lines.ends[i]] for i in at).decode())
        columns = [batch.column("host_key"), batch.column("mark"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["host_key", "mark", "left"])


def kept_documents(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The documents that are kept, all columns, without their boilerplate lines; ``n_chars`` is counted anew."""
    out, cut = verdicts(measured(docs, host), docs, max_docs, min_left)
    key = [F.xxhash64(F.col(host).cast("string")).alias("host_key"), text_mark().alias("mark")]
    texts = docs.select(*key, F.col("text").cast("string").alias("text"))
    texts = lookup(texts, cut.select("host_key", "mark", "cut_lines"), ["host_key", "mark"], cut.count(), "inner")
    left = mapped(texts.select("host_key", "mark", "text", "cut_lines"), line_cutter, "host_key long, mark binary, left string")
    at, mark, text = free_names(docs.columns, "_host", "_mark", "_text")
    left = staged(left.dropDuplicates(["host_key", "mark"]).toDF(at, mark, text), "left")
    dropped = staged(out.where("not kept").select("host_key", "mark").distinct().toDF(at, mark), "dropped")
    rows = docs.withColumns({at: F.xxhash64(F.col(host).cast("string")), mark: text_mark()})
    rows = lookup(rows, dropped, [at, mark], dropped.count(), "left_anti")
    # its size on disk is known, so the planner sends it or shuffles it by bytes
    rows = rows.join(left, [at, mark], "left")
    changed = {"text": F.coalesce(text, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(text).isNotNull(), F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns(changed).select(*docs.columns)
