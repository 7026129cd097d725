"""Token files, sentence pieces and word-piece counts against the libraries and brute force."""

from __future__ import annotations

import glob
import random
import string
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from forerate.llm import piece_counts, pieces, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def written(docs):
    return token_files.token_table(docs, WORD_BPE)


def test_digest_matches_library(spark, written, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    crc = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    got = token_files.token_digest(spark, written).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == crc
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
    index = token_files.token_index(spark, written).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens) for r in index) == Counter((r.doc_id, r.start, r.n_tokens) for r in got)


def test_selective_reads(spark, written, rows):
    some = token_files.read_tokens(spark, written, 40, 90)
    assert {r.doc_id for r in some.collect()} == {i for i, _ in rows if i and 40 <= i <= 90}
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,40)" in plan and "tokens:array" not in plan.split("ReadSchema")[-1]


def test_file_layout(written):
    found = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{written.removeprefix('file:')}/*.parquet")]
    for group in found:
        columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
        assert any("DICTIONARY" in e for e in columns["tokens"].encodings)
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert found


def test_row_groups_have_the_size_asked_for(spark, tmp_path, make):
    rng = random.Random(15)
    docs = make([(i, " ".join(str(rng.randrange(10**9)) for _ in range(400))) for i in range(400)])
    path = token_files.write_tokens(token_files.encode(docs, WORD_BPE, parts=1), str(tmp_path / "t"), 64 << 10, 8 << 10)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    assert sum(m.num_row_groups for m in files) > 3
    assert token_files.token_digest(spark, path).count() == 400


def block(texts):
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "part": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((range(len(texts)), texts, [0] * len(texts)), kinds.values())], names=[*kinds])


def test_words_of_all_kinds_match_library():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(WORD_BPE), random.Random(8)
    letters = [chr(c) for c in [*range(0x21, 0x250), 0x300, 0x338, 0x3A3, 0x1E9E, 0x2019, 0x212A, 0x4E2D, 0xAC00, 0x1F600]]
    texts = ["", None, " \n", "...", *[" ".join(c + p for c in ("Z", "é", "ÿ")) for p in string.punctuation], *[f"{c} {c}b. a{c}{c}" for c in letters]]
    for _ in range(60):
        words = ["".join(rng.choices(letters, k=rng.randrange(6)) + rng.choices(string.punctuation, k=rng.randrange(4))) for _ in range(100)]
        texts.append(" ".join([*words, "it's", "a's.", "'s", "b<|endoftext|>&", "a\x00 c\x1c."]))
    for some in (texts, [""], [None], ["&"]):
        got = [x for b in token_files.encoder(WORD_BPE, 1)(iter([block(some)])) for x in b.column("tokens").to_pylist()]
        assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in some]


def test_few_words_go_through_the_whole_tokenizer(monkeypatch):
    asked, whole = [], token_files.WordEncoder.others
    monkeypatch.setattr(token_files.WordEncoder, "others", lambda self, some: asked.extend(some) or whole(self, some))
    texts = [f"{c}{d}x{p}" for c in "abcdefgh" for d in "éklmnop" for p in (".", "&&&", "***", ',"', "$)", "")]
    list(token_files.encoder(WORD_BPE, 1)(iter([block([" ".join(texts)])])))
    assert sorted(asked) == sorted(["", ".", "&&&", "***", ',"', "$)"])


def test_known_words_are_not_encoded_again(monkeypatch):
    words, asked, merged = token_files.WordEncoder(WORD_BPE), [], token_files.WordEncoder.merged
    monkeypatch.setattr(token_files, "MEMORY", 3)
    monkeypatch.setattr(token_files.WordEncoder, "merged", lambda self, some: asked.extend(some) or merged(self, some))
    blocks = [pa.array(x.split()) for x in ("One two. 3", "two, one& three four", "FOUR three! one two two;", "4")]
    found = [words.encode(b) for b in blocks]
    for b, (ids, sizes) in zip(blocks, found, strict=True):
        coded = [words.tokenizer.encode(w, add_special_tokens=False).ids for w in b.to_pylist()]
        assert (ids.tolist(), sizes.tolist()) == ([i for x in coded for i in x], [len(x) for x in coded])
    assert asked == ["one", "two", "three", "four", "four"]


def test_small_batches_are_encoded_together():
    texts = [f"Some word{i}, {i}." for i in range(200)] + [None, ""]
    small = [block(texts[i : i + 5]) for i in range(0, len(texts), 5)]
    (one,) = token_files.encoder(WORD_BPE, 1)(iter([block([]), *small]))
    (whole,) = token_files.encoder(WORD_BPE, 1)(iter([block(texts)]))
    assert one.drop_columns("doc_id").equals(whole.drop_columns("doc_id"))
    sizes = [b.num_rows for b in token_files.joined(iter([block(["a" * n]) for n in (9, 10, 99, 30, 60, 200, 3)]), 100)]
    assert sizes == [2, 1, 2, 1, 1]


def test_empty_token_table(spark, no_docs):
    assert token_files.token_digest(spark, token_files.token_table(no_docs, WORD_BPE)).count() == 0


def toy() -> pieces.Vocabulary:
    rng = random.Random(2)
    texts = {"▁", "a", "b", "c", "▁a", "▁b", "ab", "bc", "abc", "▁ab", "cc", "ca", "▁▁", "b▁"}
    scored = [("", 0.0)] * 256 + [(t, round(rng.uniform(-9, -1), 3)) for t in sorted(texts)]
    surfaces = [bytes([i]) for i in range(256)] + [t.replace("▁", " ").encode() for t, _ in scored[256:]]
    return pieces.Vocabulary(scored, range(256), surfaces)


def best_score(v: pieces.Vocabulary, scores: dict[str, tuple[float, int]], word: str, marked: bool) -> float:
    """By trying every cut. A mark of the text itself is written as a character that no piece has."""
    word = "▁" * marked + word.replace("▁", "\ufffe")
    best = [0.0]
    for end in range(1, len(word) + 1):
        ways = [best[end - 1] + v.unknown]
        ways += [best[s] + scores[word[s:end]][0] for s in range(end) if word[s:end] in scores]
        best.append(max(ways))
    return best[-1]


def walk(node: dict, text: str = "") -> dict[str, tuple[float, int]]:
    out = {}
    for c, below in node.items():
        if c is None:
            out[text] = below
        else:
            out |= walk(below, c + text)
    return out


def test_viterbi_is_best_with_and_without_shared_prefixes():
    rng = random.Random(4)
    v = toy()
    scores = walk(v.root)
    some = sorted({"".join(rng.choice("abcd▁") for _ in range(rng.randrange(9))) for _ in range(400)})
    some = sorted([*("m" + w for w in some), *("u" + w for w in some if w)])
    by_id = {i: s for s, i in scores.values()}
    for unit, ids in zip(some, v.segment(some), strict=True):
        marked, word = unit[0] == "m", unit[1:]
        assert ids == next(iter(v.segment([unit])))
        said = b"".join(v.surfaces[i] for i in ids)
        assert said == b" " * marked + word.encode()
        score, run = 0.0, b""
        for i in ids:  # bytes of one unknown character cost once
            if i in by_id:
                score += by_id[i]
            else:
                run += v.surfaces[i]
                try:
                    run.decode()
                    score, run = score + v.unknown, b""
                except UnicodeDecodeError:
                    pass
        assert score == pytest.approx(best_score(v, scores, word, marked))


def test_cuts_do_not_change_the_best_score():
    rng = random.Random(14)
    v = pieces.Vocabulary.load(MODEL)
    scores = walk(v.root)
    by_id = {i: s for s, i in scores.values()}
    for _ in range(300):
        word = "".join(rng.choice(["the", "on", ".", ",", "\n", "a", "B", "7", "(", ")", "ing", "é", "'s", "\n\n"]) for _ in range(rng.randrange(1, 7)))
        units = v.units(word)
        assert "".join(u[1:] for u in units) == word and units[0][0] == "m"
        ids = [i for u in units for i in next(iter(v.segment([u])))]
        total = sum(by_id.get(i, v.unknown) for i in ids)
        assert total == pytest.approx(best_score(v, scores, word, True))


def test_known_segmentation_by_unigram_of_another_library():
    from tokenizers import Tokenizer, models

    v = pieces.Vocabulary.load(MODEL)
    scores = walk(v.root)
    table = [("<unk>", 0.0), *((t, s) for t, (s, _) in sorted(scores.items()))]
    other = Tokenizer(models.Unigram(table, unk_id=0, byte_fallback=False))
    names = {i: t for t, (_, i) in scores.items()}
    some = sorted(set("hello world internationalisation that thereof Straße élève cióntallue the a".split()))
    for word, ids in zip(some, v.segment(["m" + w for w in some]), strict=True):
        theirs = other.encode("▁" + word).tokens
        assert sum(scores[names[i]][0] for i in ids) == sum(scores[t][0] for t in theirs)


def test_round_trip(spark, docs, rows):
    coded = pieces.encode(docs, MODEL)
    assert [c for c in coded.columns if c != "pieces"] == [c for c in docs.columns if c != "pieces"]
    got = pieces.decode(coded, MODEL).collect()
    told = pieces.encode(docs, MODEL, verified="same")
    assert told.columns[-2:] == ["pieces", "same"] and told.where("same").count() == len(rows)
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((i, t or "") for i, t in rows)
    assert all(r.pieces == [] for r in got if not r.text)


def test_pieces_of_no_rows(no_docs):
    assert pieces.decode(pieces.encode(no_docs, MODEL), MODEL).count() == 0


def greedy(word: str, starts: set[str], inner: set[str]) -> int:
    at, n = 0, 0
    while at < len(word):
        known = inner if at else starts
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_automaton_is_greedy():
    rng = random.Random(6)
    texts = lambda n: {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 6))) for _ in range(n)}
    for _ in range(30):
        starts, inner = texts(rng.randrange(12)), texts(rng.randrange(12))
        some = [*sorted(texts(60)), "", "abababababababaé", "c"]
        got = piece_counts.Automaton(starts, inner).counts(pa.array(some))
        assert got.tolist() == [greedy(w, starts, inner) for w in some]


def test_counts_match_word_piece_library(docs, rows):
    from tokenizers import models

    starts, inner = piece_counts.pieces_of_model(MODEL)
    names = ["[UNK]", *starts, *("##" + t for t in inner)]
    model = models.WordPiece({t: i for i, t in enumerate(names)}, unk_token="[UNK]", max_input_chars_per_word=10**6)
    got = piece_counts.count_pieces(docs, starts, inner).collect()
    want = [(i, len(w), sum(len(model.tokenize(x)) for x in w)) for i, w in ((i, brute.words(t)) for i, t in rows)]
    assert Counter(map(tuple, got)) == Counter(want)
    assert piece_counts.count_pieces(docs.limit(0), starts, inner).count() == 0
