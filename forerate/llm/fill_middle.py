"""Operator 12: fill-in-middle transformation with a learned rank index.

Texts are cut in two places into prefix, middle and suffix and put together anew with marks between
the parts, so that a model learns to fill gaps. Cuts are drawn as ranks of units (code points, or words
with what follows them), so the rank of a cut must be turned into its place in the bytes. All unit
boundaries of a block are the points (rank, offset) of a rising curve. Line segments are fitted to it
greedily, each as long as one slope keeps every point within ``ERROR`` bytes; what a line is off is
stored as one byte per boundary. A cut is predicted by the line of its segment and corrected exactly
by the stored residual, so the offsets themselves are not kept.

The draw takes four numbers from a hash of seed and id: two cuts, whether a text stays plain, and which
order the parts come in (``psm``: prefix, suffix, middle; ``spm``: suffix, prefix, middle). A text that
holds a mark stays plain, so ``restored`` gives back every text exactly.

Results for odd input: a null or empty text stays plain and empty, with n = 0; rows of one id are cut
at ranks drawn from the same numbers, rows without an id from the numbers of the empty id; repeated
rows give equal results. A very long text is a block of its own, indexed slice by slice at a byte per
unit. Empty tables give no rows; other columns are kept unless they are named like a column that is
added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forerate.llm.common import Words, blocks, buffers, free_names, mapped
from forerate.llm.pieces import replaced

#: How far a line may be off, before rounding; a residual then fits into a signed byte.
ERROR = 126
#: Boundaries are found and fitted in slices of so many bytes.
SLICE = 1 << 20
#: Points that a new segment is tried on first; twice as many each time they fit.
FIRST_TRY = 256
ADDED = {
    "n": T.LongType(),
    "form": T.StringType(),
    "prefix_chars": T.LongType(),
    "middle_chars": T.LongType(),
    "output": T.StringType(),
}


@dataclass(frozen=True)
class Marks:
    """What is written before each part. No mark may hold another's first character further on: then no
    text without marks makes one up at a seam."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        every = (self.prefix, self.suffix, self.middle)
        if len(set(every)) < 3 or not all(every) or any(a[0] in b[1:] for a in every for b in every):
            raise ValueError(f"marks {every} can't be told apart from text at a seam")
        if any(a != b and a.startswith(b) for a in every for b in every):
            raise ValueError(f"a mark of {every} begins with another")


def segment_end(y: np.ndarray, start: int) -> tuple[int, float]:
    """Where the longest line from point ``start`` ends, and its slope: all points are within ``ERROR``.

    Every further point narrows the slopes that pass within reach of it; the line ends where none is left.
    """
    low, high, end, width = -np.inf, np.inf, start + 1, FIRST_TRY
    while end < len(y):
        stop = min(len(y), end + width)
        run = np.arange(end - start, stop - start)
        rise = y[end:stop] - y[start]
        lows = np.maximum(np.maximum.accumulate((rise - ERROR) / run), low)
        highs = np.minimum(np.minimum.accumulate((rise + ERROR) / run), high)
        fits = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(run)
        if fits:
            low, high, end = float(lows[fits - 1]), float(highs[fits - 1]), end + fits
        if fits < len(run):
            break
        width *= 2
    return end, (low + high) / 2 if end > start + 1 else 0.0


class RankIndex:
    """The rising offsets of all boundaries, as line segments and a residual byte for each."""

    def __init__(self, slices: Iterator[np.ndarray]):
        firsts, starts, slopes, residuals, rank = [], [], [], [], 0
        for y in slices:
            at = 0
            while at < len(y):
                end, slope = segment_end(y, at)
                firsts.append(rank + at)
                starts.append(y[at])
                slopes.append(slope)
                line = np.rint(slope * np.arange(end - at)).astype(np.int64)
                residuals.append((y[at:end] - y[at] - line).astype(np.int8))
                at = end
            rank += len(y)
        self.firsts, self.starts = np.array(firsts, dtype=np.int64), np.array(starts, dtype=np.int64)
        self.slopes = np.array(slopes)
        self.residuals = np.concatenate(residuals) if residuals else np.zeros(0, np.int8)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.starts[at] + np.rint(self.slopes[at] * (ranks - self.firsts[at])).astype(np.int64)

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of boundaries."""
        return self.predicted(ranks) + self.residuals[ranks]


def boundaries(texts: pa.Array, units: str) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """Offsets where units begin in the bytes of all texts, in slices, and the rank of each text's first.

    The end of the last text is the last boundary. Units are ``chars`` (code points) or ``words``: a
    word with the white space behind it, the first one with what is before it as well.
    """
    data, offsets = buffers(texts)
    if units == "words":
        words = Words(texts)
        inner = np.ones(len(words.starts), dtype=bool)
        inner[words.bounds[:-1][words.counts > 0]] = False
        filled = np.diff(offsets) > 0
        every = np.union1d(words.starts[inner], offsets[:-1][filled])
    elif units != "chars":
        raise ValueError(f"units are chars or words, not {units}")

    def slices() -> Iterator[np.ndarray]:
        if units == "words":
            yield from (every[i : i + SLICE] for i in range(0, len(every), SLICE))
        else:
            for i in range(0, len(data), SLICE):
                yield np.flatnonzero((data[i : i + SLICE] & 0xC0) != 0x80) + i
        yield np.array([len(data)])

    if units == "words":
        return slices(), np.searchsorted(every, offsets)
    # code points before each text, summed slice by slice
    ranks, before = np.zeros(len(offsets), dtype=np.int64), 0
    for i in range(0, max(1, len(data)), SLICE):
        lead = np.concatenate([[0], np.cumsum((data[i : i + SLICE] & 0xC0) != 0x80)])
        here = (offsets >= i) & (offsets < i + SLICE) if i + SLICE < len(data) else offsets >= i
        ranks[here] = before + lead[offsets[here] - i]
        before += int(lead[-1])
    return slices(), ranks


def drawn(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    seed: int = 1,
    percent: int = 90,
    spm_percent: int = 20,
    units: str = "chars",
    marks: Marks = Marks(),
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    ``percent`` of the texts are cut, ``spm_percent`` of these with the suffix first.
    """
    numbers = free_names(docs.columns, "_h1", "_h2", "_h3", "_h4")
    rows = docs.withColumns(dict(zip(numbers, drawn(F.col(key), seed), strict=True)))
    rows = rows.withColumn("text", F.col("text").cast("string"))
    kept = [f for f in docs.schema.fields if f.name not in ADDED]
    schema = T.StructType([*kept, *(T.StructField(c, kind) for c, kind in ADDED.items())])
    before = {p: [m.encode() for m in order] for p, order in (
        ("psm", (marks.prefix, marks.suffix, marks.middle)),
        ("spm", (marks.suffix, marks.prefix, marks.middle)),
    )}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = batch.column("text").fill_null("")
            data, offsets = buffers(texts)
            slices, ranks = boundaries(texts, units)
            index = RankIndex(slices)
            n = np.diff(ranks)
            h1, h2, h3, h4 = (np.asarray(batch.column(c)) for c in numbers)
            a, b = h1 % (n + 1), h2 % (n + 1)
            a, b = np.minimum(a, b), np.maximum(a, b)
            plain = (n == 0) | (h3 % 100 >= percent)
            for mark in (marks.prefix, marks.suffix, marks.middle):
                plain |= np.asarray(pc.match_substring(texts, mark))
            form = np.where(plain, "plain", np.where(h4 % 100 < spm_percent, "spm", "psm"))
            first, second = index[ranks[:-1] + a], index[ranks[:-1] + b]
            whole, out, sizes = memoryview(data), [], []
            for kind, x, p, q, y in zip(form.tolist(), offsets[:-1].tolist(), first.tolist(), second.tolist(), offsets[1:].tolist()):
                if kind == "plain":
                    out.append(whole[x:y].tobytes())
                    sizes.append((None, None))
                    continue
                prefix, middle, suffix = whole[x:p], whole[p:q], whole[q:y]
                parts = (prefix, suffix, middle) if kind == "psm" else (suffix, prefix, middle)
                out.append(b"".join(t for pair in zip(before[kind], parts) for t in pair))
                if units == "words":
                    sizes.append((len(str(prefix, "utf-8")), len(str(middle, "utf-8"))))
            if units == "chars":
                prefix_chars, middle_chars = pa.array(a, mask=plain), pa.array(b - a, mask=plain)
            else:
                prefix_chars, middle_chars = (pa.array([s[i] for s in sizes], pa.int64()) for i in (0, 1))
            values = [pa.array(n), pa.array(form, pa.string()), prefix_chars, middle_chars, pa.array(out, pa.binary()).cast(pa.string())]
            same = batch.select([f.name for f in kept])
            for name, column in zip(ADDED, values):
                same = replaced(same, name, column)
            yield same

    return mapped(rows, work, schema)


def restored(output: str, form: str, marks: Marks = Marks()) -> Column:
    """The text that was cut, from the columns ``output`` and ``form``."""
    def parts(first: str, second: str) -> Column:
        body = F.substr(F.col(output), F.lit(len(first) + 1))
        return F.split(body, rf"\Q{second}\E|\Q{marks.middle}\E", -1)

    psm, spm = parts(marks.prefix, marks.suffix), parts(marks.suffix, marks.prefix)
    return (
        F.when(F.col(form) == "plain", F.col(output))
        .when(F.col(form) == "psm", F.concat(psm[0], psm[2], psm[1]))
        .otherwise(F.concat(spm[1], spm[2], spm[0]))
    )
