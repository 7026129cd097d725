"""Operator 10: word-piece counts by a linear longest-match automaton.

A word is cut greedily into the longest piece at its start and the longest continuation after that.
The vocabulary is a trie with two roots, for starts and continuations, over UTF-8 bytes. A failure
link leads from a node to the node reached after the longest pieces of its string have been popped,
and each link has the number of pieces it pops. One walk over a word then counts its pieces, without
building any and without going back. Many words are walked side by side, byte by byte, and equal
words of a block once; very long words are walked alone, in time linear in their bytes.

A word that can't be cut completely counts as one unknown piece. Results for odd input: a null or
blank text has no pieces. Repeated rows are counted each. Empty tables give no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.llm.common import blocks, buffers, mapped

ENCODE_BLOCK = 4 << 20
#: Words of more bytes are walked one by one: side by side they would take a step of all words per byte.
LONG_WORD = 256
MARK = "▁"


class Automaton:
    """Trie with failure links and popped-piece counts, as arrays; node 0 starts, node 1 continues."""

    def __init__(self, starts: Iterable[str], continuations: Iterable[str]):
        children: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        for root, texts in ((0, starts), (1, continuations)):
            for text in texts:
                node = root
                for b in text.encode():
                    if b not in children[node]:
                        children[node][b] = len(children)
                        children.append({})
                        piece.append(False)
                    node = children[node][b]
                piece[node] = node > 1
        link, popped = [-1] * len(children), [0] * len(children)
        queue = deque((root, b, child) for root in (0, 1) for b, child in children[root].items())
        while queue:
            parent, b, node = queue.popleft()
            if piece[node]:
                link[node], popped[node] = 1, 1
            else:
                at, count = link[parent], popped[parent]
                while at >= 0 and b not in children[at]:
                    count += popped[at]
                    at = link[at]
                if at >= 0:
                    link[node], popped[node] = children[at][b], count
            queue.extend((node, c, child) for c, child in children[node].items())
        edges = sorted((node << 8 | b, child) for node, below in enumerate(children) for b, child in below.items())
        self.child = dict(edges)
        self.edges = np.array([e for e, _ in edges] or [-1], dtype=np.int64)
        self.targets = np.array([t for _, t in edges] or [0], dtype=np.int64)
        self.links, self.pops = link, popped
        self.link, self.popped = np.array(link, dtype=np.int64), np.array(popped, dtype=np.int64)

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Children by a byte, -1 where there is none."""
        key = nodes << 8 | data
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], -1)

    def walk(self, word: bytes) -> int:
        """Pieces of one word, byte by byte."""
        child, link, popped = self.child, self.links, self.pops
        node = count = 0
        for b in word:
            while True:
                to = child.get(node << 8 | b)
                if to is not None:
                    node = to
                    break
                count += popped[node]
                node = link[node]
                if node < 0:
                    return 1
        while node != 1 and word:
            count += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return count

    def counts(self, words: pa.Array) -> np.ndarray:
        """Pieces of each word: 0 of an empty one, 1 of one that can't be cut."""
        data, offsets = buffers(words)
        lengths = np.diff(offsets)
        long = np.flatnonzero(lengths > LONG_WORD)
        apart = [self.walk(data[offsets[i] : offsets[i + 1]].tobytes()) for i in long]
        lengths[long] = 0
        count, node = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        lost = np.zeros(len(lengths), dtype=bool)
        order = np.argsort(-lengths, kind="stable")
        longest = -lengths[order]
        for j in range(int(lengths.max()) if len(lengths) else 0):
            live = order[: np.searchsorted(longest, -j, side="left")]
            live = live[~lost[live]]
            byte = data[offsets[live] + j].astype(np.int64)
            while len(live):
                to = self.step(node[live], byte)
                there = to >= 0
                node[live[there]] = to[there]
                live, byte = live[~there], byte[~there]
                count[live] += self.popped[node[live]]
                node[live] = self.link[node[live]]
                stuck = node[live] < 0
                lost[live[stuck]] = True
                live, byte = live[~stuck], byte[~stuck]
        live = np.flatnonzero(~lost & (lengths > 0))
        while len(live):
            live = live[node[live] != 1]
            count[live] += self.popped[node[live]]
            node[live] = self.link[node[live]]
            lost[live[node[live] < 0]] = True
            live = live[node[live] >= 0]
        out = np.where(lost, 1, count)
        out[long] = apart
        return out


@lru_cache(maxsize=2)  # once per worker process
def automaton_of(starts: tuple[str, ...], continuations: tuple[str, ...]) -> Automaton:
    return Automaton(starts, continuations)


def pieces_of_model(path: str) -> tuple[list[str], list[str]]:
    """Starts and continuations of a SentencePiece file: marked pieces start a word, any goes on.

    Pieces without a mark also start words, so that a word is unknown only for a character that the
    file lacks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    texts = [model.id_to_piece(i) for i in ids]
    inner = [t for t in texts if MARK not in t]
    marked = [t[1:] for t in texts if t[0] == MARK and len(t) > 1 and MARK not in t[1:]]
    return sorted({*marked, *inner}), sorted(set(inner))


def count_pieces(docs: DataFrame, starts: list[str], continuations: list[str], id_column: str = "doc_id") -> DataFrame:
    """``<id>, n_words, n_pieces`` of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(tuple(starts), tuple(continuations))
        for batch in blocks(batches, ENCODE_BLOCK):
            words = pc.ascii_split_whitespace(batch.column("text").fill_null(""))
            bounds = words.offsets.to_numpy()
            coded = words.flatten().dictionary_encode()
            counts = automaton.counts(coded.dictionary)[np.asarray(coded.indices, dtype=np.int64)]
            full = np.asarray(pc.binary_length(coded.dictionary))[np.asarray(coded.indices, dtype=np.int64)] > 0
            columns = [batch.column(id_column)]
            for values in (full.astype(np.int64), counts):
                sums = np.concatenate([[0], np.cumsum(values)])
                columns.append(pa.array(np.diff(sums[bounds]), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_words", "n_pieces"])

    rows = docs.select(F.col(id_column).cast("long").alias(id_column), F.col("text").cast("string").alias("text"))
    return mapped(rows, work, f"{id_column} long, n_words long, n_pieces long")
