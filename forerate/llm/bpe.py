"""Operator 11: BPE encoding and decoding with a priority queue of merge ranks.

A text is cut into words as the tokenizer file says. A word starts as a doubly linked list of byte
symbols. Every pair of neighbours that may be merged waits in a priority queue under the rank of its
merge and, for equal ranks, its place; the first one is merged, its neighbours form new pairs, and
entries whose symbols have changed since are skipped when they come up. A word of n bytes takes
O(n log n) steps, however long it is. Decoding concatenates the vocabulary strings, joined as the
file's decoder says.

Where the file drops white space, a block's distinct words are encoded once and those seen first are
remembered by the worker; other files are cut as whole texts. Strings of added tokens are cut out
before anything else.

Results for odd input: a null or empty text has no tokens and is decoded as empty; a very long text is
a block of its own, a very long word one linked list; repeated rows are encoded each, rows without an
id too. Empty tables give no rows; other columns are kept as they are unless they are named like the
column that is added, which they lose to it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forerate.llm.common import blocks, mapped
from forerate.llm.pieces import added, replaced
from forerate.llm.token_files import gathered

ENCODE_BLOCK = 4 << 20
#: Words whose ids a worker remembers from block to block and task to task.
MEMORY, MEMORY_OTHERS = 300_000, 50_000
#: Words above so many symbols keep their links in machine arrays instead of lists.
LONG_WORD = 1 << 16
#: Punctuation that never takes part in a split with what is before it.
TAIL = ".,;:!?|"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else 256 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else free))
        free += b not in plain
    return out


class Bpe:
    """Merges, vocabulary and text rules of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        model, decoder = about["model"], about["decoder"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in about["added_tokens"] if any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))]
        if model["type"] != "BPE" or odd or (decoder and decoder["type"] != "ByteLevel"):
            raise ValueError(f"{path} isn't a byte-level BPE file without special rules: {odd}")

        vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + self.suffix] for c in letters]
        # what a symbol may be merged with: the rank, shifted to leave room for a place
        self.pairs: list[dict[int, int]] = [{} for _ in range(max(vocabulary.values()) + 1)]
        self.becomes = []
        for rank, (x, y) in enumerate(model["merges"]):
            self.pairs[vocabulary[x]][vocabulary[y]] = rank << 32
            self.becomes.append(vocabulary[x + y])
        self.added = {t["content"]: t["id"] for t in about["added_tokens"]}
        some = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, some)) + ")") if some else None

        # texts may be cut at white space where that leaves words as they are
        split = lambda s: [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(s)]
        self.drops_space = split(" ab \n b.") == ["ab", "b", "."]
        normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.normal, self.split = normal, split
        self.plain_words = self.drops_space and normal("Ab") == "ab" and split("a.,;:!?|") == ["a", TAIL]

        of_letter = self.byte_of = {c: b for b, c in enumerate(letters)}
        names = [b""] * (max([*vocabulary.values(), *self.added.values()]) + 1)
        for text, i in [*vocabulary.items(), *self.added.items()]:
            inside = decoder and text not in self.added and all(c in of_letter for c in text)
            names[i] = bytes(of_letter[c] for c in text) if inside else text.encode()
        self.joint = "" if decoder else " "
        self.names = pa.array(names, pa.binary())
        self.memory: dict[str, tuple[int, ...]] = {}
        self.others: dict[str, tuple[int, ...]] = {}

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word."""
        pairs, becomes, inner = self.pairs, self.becomes, self.inner
        symbols = [inner[b] for b in word]
        symbols[-1] = self.last[word[-1]]
        n = len(symbols)
        #: the entry that stands for the pair that begins at a place; any other entry of the place is stale
        found = [pairs[x].get(y) for x, y in zip(symbols, symbols[1:], strict=False)]
        valid = [-1 if rank is None else rank | at for at, rank in enumerate(found)]
        queue = [e for e in valid if e >= 0]
        if not queue:
            return symbols
        heapify(queue)
        valid.append(-1)
        before, after = range(-1, n - 1), range(1, n + 1)
        before, after = (array("q", before), array("q", after)) if n > LONG_WORD else (list(before), list(after))
        while queue:
            entry = heappop(queue)
            at = entry & 0xFFFFFFFF
            if valid[at] != entry:
                continue
            new = symbols[at] = becomes[entry >> 32]
            gone = after[at]
            behind = after[at] = after[gone]
            symbols[gone] = valid[gone] = valid[at] = -1
            if behind < n:
                before[behind] = at
                rank = pairs[new].get(symbols[behind])
                if rank is not None:
                    valid[at] = rank | at
                    heappush(queue, rank | at)
            ahead = before[at]
            if ahead >= 0:
                rank = pairs[symbols[ahead]].get(new)
                if rank is not None:
                    valid[ahead] = rank | ahead
                    heappush(queue, rank | ahead)
                else:
                    valid[ahead] = -1
        return [s for s in symbols if s >= 0]

    def word(self, text: str) -> tuple[int, ...]:
        """Ids of a word as the file's rules cut it, remembered for the words seen first."""
        ids = self.memory.get(text)
        if ids is None:
            ids = tuple(self.merged(text.encode()))
            if len(self.memory) < MEMORY and len(text) < 64:
                self.memory[text] = ids
        return ids

    def whole(self, text: str) -> list[int]:
        """Ids of any text, by the file's own rules for cutting it into words."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                for w in self.split(self.normal(part)):
                    out.extend(self.word(bytes([self.byte_of[c] for c in w]).decode()))
        return out

    def spaced(self, word: str) -> tuple[int, ...]:
        """Ids of what stands between white space."""
        ids = self.others.get(word)
        if ids is not None:
            return ids
        core = word.rstrip(TAIL)
        # composed letters that are lower-cased one by one
        if core and core.isalpha() and max(core) < "ƀ" and "İ" not in core:
            ids = self.word(core.lower())
            return ids + self.word(word[len(core) :]) if len(core) < len(word) else ids
        ids = tuple(self.whole(word))
        if len(self.others) < MEMORY_OTHERS and len(word) < 64:
            self.others[word] = ids
        return ids

    def plain(self, words: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Ids of distinct parts, and which two of them make up each word: most are letters and punctuation.

        The last part is empty.
        """
        core = pc.utf8_rtrim(words, TAIL)
        easy = np.asarray(pc.ascii_is_alpha(core))
        letters = pc.ascii_lower(core.filter(pa.array(easy))).dictionary_encode()
        memory, word = self.memory, self.word
        found = [memory.get(w) or word(w) for w in letters.dictionary.to_pylist()]
        head, tail = np.full(len(words), -1, dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
        head[easy] = np.asarray(letters.indices)
        cut = np.asarray(pc.binary_length(core))
        ended = np.flatnonzero(easy & (cut < np.asarray(pc.binary_length(words))))
        known: dict[str, int] = {}
        for i, w, at in zip(ended.tolist(), words.take(pa.array(ended)).to_pylist(), cut[ended].tolist()):
            tail[i] = known.setdefault(w[at:], len(known))
        tail[ended] += len(found)
        found += map(word, known)
        others = np.flatnonzero(~easy)
        head[others] = len(found) + np.arange(len(others))
        found += map(self.spaced, words.take(pa.array(others)).to_pylist())
        return [*found, ()], head, tail

    def lists(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text."""
        texts = texts.fill_null("")
        if self.drops_space:
            cut = pc.ascii_split_whitespace(texts)
            bounds, parts = cut.offsets.to_numpy().astype(np.int64), cut.flatten()
            bounds = bounds - bounds[0]
        else:
            bounds, parts = np.arange(len(texts) + 1), texts
        coded = parts.dictionary_encode()
        if self.plain_words:
            found, head, tail = self.plain(coded.dictionary)
        else:
            found = [*map(self.whole, coded.dictionary.to_pylist()), ()]
            head, tail = np.arange(len(coded.dictionary)), np.full(len(coded.dictionary), -1)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        index = np.asarray(coded.indices, dtype=np.int64)
        both = np.stack([head[index], tail[index]], axis=1).ravel()
        counts = sizes[both]
        ends = np.concatenate([[0], np.cumsum(counts)])[2 * bounds]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(gathered(flat, starts[both], counts), pa.int32()))

    def texts(self, tokens: pa.ListArray) -> pa.Array:
        """The decoded text of every list of ids."""
        joined = pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, self.names.take(tokens.values)), self.joint.encode())
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # byte symbols that make up no text become U+FFFD
            return pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())


@lru_cache(maxsize=2)  # once per worker process
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``tokens``, the ids of ``text`` without special ones; ``path`` is a tokenizers file.

    With ``decoded`` a column of that name holds the text that the ids stand for, made in the same pass.
    """
    schema = added(docs, "tokens", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = T.StructType([f for f in schema.fields if f.name != decoded]).add(decoded, T.StringType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in blocks(batches, ENCODE_BLOCK):
            lists = bpe.lists(batch.column("text"))
            out = replaced(batch, "tokens", lists)
            yield replaced(out, decoded, bpe.texts(lists)) if decoded else out

    return mapped(docs, work, schema)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``tokens``; a null list is decoded as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            lists = batch.column("tokens")
            yield replaced(batch, "decoded", bpe.texts(lists.fill_null([]) if lists.null_count else lists))

    return mapped(rows, work, added(rows, "decoded", T.StringType()))
