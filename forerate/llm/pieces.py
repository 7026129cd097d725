"""Operator 5: SentencePiece encoding and decoding with a shared-prefix Viterbi.

A text is marked (a space before it, every space becomes U+2581) and cut before each run of marks, and
where two characters meet that no piece has side by side (line ends, punctuation behind a word); no
piece crosses such a cut, so the units can be segmented alone. A run of marks stays with the word
behind it, as a model may have pieces for runs; if it has pieces with a mark behind another character,
texts aren't cut at marks at all. The distinct units of a block of texts are
sorted, which is a depth-first walk of their trie, and the best scores of a unit's prefixes are kept
while the next unit shares them: each node of the trie is scored once. The best segmentation
maximises the sum of the piece scores of a public model; a character without a piece costs the least
score less ten and is written as its bytes, and so is a U+2581 of the text itself, which makes
decoding an exact inverse. Ties go to the longer last piece.

Results for odd input: a null or empty text has no pieces and is decoded as empty. Repeated rows are
encoded each. Empty tables give no rows; other columns are kept as they are unless they are named
``pieces`` (encode) or ``decoded`` (decode), which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forerate.llm.common import blocks, mapped
from forerate.llm.token_files import gathered

MARK = "▁"
#: Stands for a U+2581 of the text inside a unit; no text has it, as it isn't valid UTF-8.
OWN_MARK = "\ud800"
ENCODE_BLOCK = 2 << 20
UNKNOWN_PENALTY = 10.0
#: What is cut off behind a word, where no piece forbids it.
PUNCTUATION = ".,;:!?|()[]"


class Vocabulary:
    """Pieces and scores of a model with byte pieces, as a trie of reversed pieces."""

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_ids: Sequence[int], surfaces: Sequence[bytes]):
        """``pieces`` has text and score by id, "" for ids that can't be chosen."""
        self.byte_ids, self.surfaces = list(byte_ids), list(surfaces)
        self.root: dict = {}
        for i, (text, score) in enumerate(pieces):
            if not text:
                continue
            node = self.root
            for c in reversed(text):
                node = node.setdefault(c, {})
            node[None] = (score, i)
        inside = {(t[i], t[i + 1]) for t, _ in pieces for i in range(len(t) - 1)}
        self.inside = inside
        self.splits_lines = not any("\n" in t for t, _ in pieces)
        self.splits_words = not any(b == MARK != a for a, b in inside)
        self.unknown = min((s for t, s in pieces if t), default=0.0) - UNKNOWN_PENALTY

    @classmethod
    @lru_cache(maxsize=2)  # once per worker process
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, surfaces, byte_ids = [], [], [0] * 256
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
                surfaces.append(bytes([int(text[3:5], 16)]))
                pieces.append(("", 0.0))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                surfaces.append(b"")
                pieces.append(("", 0.0))
            else:
                surfaces.append(text.replace(MARK, " ").encode())
                pieces.append((text, model.get_score(i)))
        return cls(pieces, byte_ids, surfaces)

    def surface_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces in one array, where each begins, and how many it has."""
        lengths = np.array([len(x) for x in self.surfaces], dtype=np.int64)
        return np.frombuffer(b"".join(self.surfaces), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths

    def units(self, word: str) -> list[str]:
        """A marked word cut where no piece goes on: strings with ``m`` before a marked unit, else ``u``.

        Spaces in a word are marks, too.
        """
        out, kind = [], "m"
        for part in word.split("\n") if self.splits_lines else (word,):
            if out:
                out.append("u\n")
            core = part.rstrip(PUNCTUATION)
            if core != part and core and (core[-1].replace(" ", MARK), part[len(core)]) not in self.inside:
                out += [kind + core, "u" + part[len(core) :]]
            elif part or kind == "m":
                out.append(kind + part)
            kind = "u"
        return out

    def segment(self, units: Sequence[str]) -> Iterator[list[int]]:
        """Ids of each unit; ``units`` are sorted."""
        root, unknown, byte_ids = self.root, self.unknown, self.byte_ids
        before, was_marked = "", True
        best, origin, chosen = [0.0], [0], [-1]
        for unit in units:
            marked = unit[0] == "m"
            word = unit[1:].replace(MARK, OWN_MARK).replace(" ", MARK)
            word = MARK + word if marked else word
            shared, most = 0, min(len(word), len(before)) if marked == was_marked else 0
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], origin[shared + 1 :], chosen[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                at = start = end - 1
                top, piece, node = best[at] + unknown, -1, root
                while at >= 0:
                    node = node.get(word[at])
                    if node is None:
                        break
                    hit = node.get(None)
                    if hit is not None and best[at] + hit[0] >= top:
                        top, start, piece = best[at] + hit[0], at, hit[1]
                    at -= 1
                best.append(top)
                origin.append(start)
                chosen.append(piece)
            before, was_marked = word, marked
            ids: list[int] = []
            end = len(word)
            while end:
                if chosen[end] >= 0:
                    ids.append(chosen[end])
                else:
                    shown = word[end - 1].replace(MARK, " ").replace(OWN_MARK, MARK)
                    ids.extend(byte_ids[b] for b in reversed(shown.encode()))
                end = origin[end]
            ids.reverse()
            yield ids


def runs_joined(index: np.ndarray, text_of: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers and texts with each run of empty words joined to the word behind it, and all words.

    An empty word is what lies between two spaces; the last word of a text ends its run.
    """
    if "" not in words or not len(index):
        return index, text_of, words
    last = np.append(text_of[1:] != text_of[:-1], True)
    ends = np.flatnonzero((index != words.index("")) | last)
    spaces = np.diff(np.concatenate([[-1], ends])) - 1
    pairs, at = np.unique(spaces * len(words) + index[ends], return_inverse=True)
    return at, text_of[ends], [" " * k + words[w] for k, w in (divmod(p, len(words)) for p in pairs.tolist())]


def piece_lists(texts: pa.Array, vocabulary: Vocabulary) -> pa.ListArray:
    texts = texts.fill_null("")
    empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
    if vocabulary.splits_words:
        words = pc.split_pattern(texts, " ")
        per_text, coded = np.diff(words.offsets.to_numpy()), words.flatten().dictionary_encode()
    else:
        per_text, coded = np.ones(len(texts), dtype=np.int64), texts.dictionary_encode()
    text_of = np.repeat(np.arange(len(texts)), per_text)
    filled = ~empty[text_of]  # an empty text has one empty word
    index, text_of, known = np.asarray(coded.indices, dtype=np.int64)[filled], text_of[filled], coded.dictionary.to_pylist()
    if vocabulary.splits_words:
        index, text_of, known = runs_joined(index, text_of, known)
    cut = [vocabulary.units(w) for w in known]
    distinct = sorted({u for units in cut for u in units})
    ids_of = dict(zip(distinct, vocabulary.segment(distinct), strict=True))
    found = [ids_of[units[0]] if len(units) == 1 else [i for u in units for i in ids_of[u]] for units in cut]
    counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(counts.sum()))
    starts = np.cumsum(counts) - counts
    sums = np.concatenate([[0], np.cumsum(counts[index])])
    ends = sums[np.cumsum(np.bincount(text_of, minlength=len(texts)))]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(gathered(flat, starts[index], counts[index]), pa.int32()))


def replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), values], names=[*(batch.schema.names[i] for i in kept), name])


def added(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name]).add(name, kind)


def texts_of(pieces: pa.ListArray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts of lists of ids, given the bytes of all pieces; the mark before the first word goes."""
    offsets = np.asarray(pieces.offsets, dtype=np.int64)
    ids = np.asarray(pieces.values, dtype=np.int64)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = lengths[ids]
    data = gathered(flat, starts[ids], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    filled = np.diff(ends) > 0
    keep = np.ones(len(data), dtype=bool)
    keep[ends[:-1][filled]] = False
    ends[1:] -= np.cumsum(filled)
    return pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[keep].tobytes())]
    )


def encode(docs: DataFrame, model: str, verified: str | None = None) -> DataFrame:
    """``docs`` with ``pieces``, the ids of ``text``; ``model`` is a SentencePiece file with byte pieces.

    With ``verified`` a column of that name tells whether the ids, decoded, are the text again.
    """
    schema = added(docs, "pieces", T.ArrayType(T.IntegerType()))
    if verified:
        schema = T.StructType([f for f in schema.fields if f.name != verified]).add(verified, T.BooleanType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(model)
        for batch in blocks(batches, ENCODE_BLOCK):
            lists = piece_lists(batch.column("text"), vocabulary)
            out = replaced(batch, "pieces", lists)
            if verified:
                same = pc.equal(texts_of(lists, *vocabulary.surface_bytes()), batch.column("text").fill_null(""))
                out = replaced(out, verified, same)
            yield out

    return mapped(docs, work, schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``pieces``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = Vocabulary.load(model).surface_bytes()
        for batch in batches:
            lists = batch.column("pieces")
            if lists.null_count:
                lists = lists.fill_null([])
            yield replaced(batch, "decoded", texts_of(lists, *surfaces))

    return mapped(rows, work, added(rows, "decoded", T.StringType()))
