"""BPE against the library, cuts against plain slicing, clusters against plain Lloyd's rounds."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forerate.llm import bpe, centroids, fill_middle

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None,
    "",
    " \n\t ",
    "Ünï ▁ <|endoftext|> 😀   \x1c   ends<|startoftext|><|endoftext|>x <|end",
    "ΣΑΣ Σ İstanbul don't DON'T we'll it'S '''s 12345 ½ ² éé Å nb sp\x85x ...",
    "ﬁ ŉ Å ǆ ß ẞ 한국어 각 中文 हिन्दी ง้ ̀abc ́ ſ µ é",
    "x" * 70_000 + " " + "été" * 400,
    "....,,,, !!!| |x| a|b. c,d 'sa 's",
]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_and_texts_are_the_library_s(make, path, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    ranges = ((32, 127), (0x80, 0x250), (0x300, 0x600), (0x1E00, 0x2100), (0xAC00, 0xAD00), (0x1F600, 0x1F640))
    wild = ["".join(chr(rng.randrange(*rng.choice(ranges))) if rng.random() < 0.9 else " " for _ in range(60)) for _ in range(150)]
    known = [*rows, *((5000 + i, t) for i, t in enumerate([*ODD, *wild]))]
    docs = make(known).withColumn("tokens", F.lit(1)).withColumn("decoded", F.lit(2))
    want = Counter()
    for i, t in known:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, t, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    once = bpe.encode(docs, path, decoded="decoded")
    twice = bpe.decode(bpe.encode(docs, path), path)
    for got in (once, twice):
        assert Counter((r.doc_id, r.text, tuple(r.tokens), r.decoded) for r in got.collect()) == want
        assert set(got.columns) == set(docs.columns)


def test_null_tokens_and_empty_table(spark, no_docs):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320])], "doc_id long, tokens array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, WORD_BPE).collect()} == {1: "", 2: "", 3: "a</w>"}
    assert bpe.encode(no_docs, WORD_BPE).collect() == []


def test_other_files_are_refused(tmp_path):
    from tokenizers import Tokenizer, models

    path = str(tmp_path / "t.json")
    Tokenizer(models.WordPiece({"a": 0}, unk_token="a")).save(path)
    with pytest.raises((ValueError, KeyError)):
        bpe.Bpe(path)


def plain_cut(i, text, percent=90, spm=20):
    """The transformation by slicing."""
    t, h = text or "", hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


MARKED = ["<P", "a <S> b", "<M>", "<<<P>>", "ends with <S", "S>starts", "\\Q<S>\\E"]


def test_cuts_are_those_of_slicing(make, rows):
    long = "".join(chr(97 + k % 26) if k % 97 else "é中😀"[k % 3] for k in range(1_500_000))
    known = [*rows, *((7000 + i, t) for i, t in enumerate([*MARKED, *(t for t in MARKED if "<S>" not in t), long, "😀", "\n"]))]
    docs = make(known).withColumn("output", F.lit(1)).withColumn("form", F.lit(True))
    for percent, spm in ((90, 20), (100, 100), (100, 0), (0, 50)):
        cut = fill_middle.transform(docs, percent=percent, spm_percent=spm).withColumn("again", fill_middle.restored("output", "form"))
        got = Counter((r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in cut.collect())
        assert got == Counter((i, t, plain_cut(i, t, percent, spm)) for i, t in known)
        assert cut.where("NOT again <=> coalesce(text, '')").count() == 0
    assert set(docs.columns) < set(cut.columns)


def test_word_units_cut_at_words(docs):
    cut = fill_middle.transform(docs, percent=100, units="words").withColumn("again", fill_middle.restored("output", "form"))
    for r in cut.collect():
        assert r.again == (r.text or "")
        if r.form == "plain":
            continue
        for at in (r.prefix_chars, r.prefix_chars + r.middle_chars):
            assert at in (0, len(r.text)) or (r.text[at - 1] in " \n\t\r\v\f" and r.text[at] not in " \n\t\r\v\f")


def test_cuts_of_an_empty_table_and_marks(no_docs):
    assert fill_middle.transform(no_docs).collect() == []
    for bad in (("<a>", "<a>", "<b>"), ("aba", "x", "y"), ("", "x", "y"), ("xy", "x", "z")):
        with pytest.raises(ValueError):
            fill_middle.Marks(*bad)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=600), st.integers(1, 200))
def test_index_gives_every_offset(steps, size):
    y = np.cumsum([0, *steps])
    index = fill_middle.RankIndex(y[i : i + size] for i in range(0, len(y), size))
    assert (index[np.arange(len(y))] == y).all()
    assert np.abs(index.residuals.astype(int)).max() <= fill_middle.ERROR + 1


def test_segments_are_few():
    """A text of one script is one line; of mixed ones a line lasts as long as its slope does."""
    text = pa.array(["a" * 100_000 + "ü" * 100_000 + "中" * 50_000])
    index = fill_middle.RankIndex(fill_middle.boundaries(text, "chars")[0])
    assert len(index.firsts) <= 6


def lloyd(vectors, k=8, rounds=10, dims=64):
    """Plain rounds in whole numbers; the distances evaluated are all of them."""
    kept = []
    for i, e in vectors:
        if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e):
            kept.append((i, [max(-centroids.LIMIT, min(centroids.LIMIT, math.floor(1024 * float(np.float32(v))))) for v in e]))
    ident = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centres = [x for _, x in sorted(kept, key=lambda r: (ident(r[0]), r[1]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            mine = [x for (_, x), c in zip(kept, of) if c == j]
            if mine:
                centres[j] = [sum(v) // len(mine) for v in zip(*mine)]
    found = [(i, nearest(x)) for i, x in kept]
    sums = Counter()
    for _, (d, j) in found:
        sums[j] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, sums[j], sum(sums.values()), names[j]) for i, (d, j) in found)


VECTORS = "vec_id long, embedding array<float>, x string, cluster string, h int, label int"


def made(rng, n, spread):
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("spread", "history"), [(0.2, centroids.HISTORY_BYTES), (1.5, centroids.HISTORY_BYTES), (1.5, 1)])
def test_clusters_are_lloyd_s(spark, monkeypatch, spread, history):
    """Also when the history is begun anew in every round."""
    monkeypatch.setattr(centroids, "HISTORY_BYTES", history)
    rng = random.Random(int(spread * 10))
    vectors = made(rng, 260, spread)
    vectors += vectors[:20] + [(5, vectors[9][1]), (None, vectors[3][1]), (None, None), (900, []), (901, [0.5] * 63), (902, [None] * 64)]
    vectors += [(903, [float("nan")] * 64), (904, [float("inf")] + [0.0] * 63), (905, [0.0] * 64), (906, [0.0] * 64), (907, [1e30] * 64)]
    df = spark.createDataFrame([(i, e, "x", "c", 1, 2) for i, e in vectors], VECTORS).repartition(3)
    rows = centroids.with_inertia(*centroids.clusters(df)).collect()
    assert Counter(tuple(r) for r in rows) == lloyd(vectors)


def test_ties_and_few_vectors(spark):
    grid = [(i, [float(i % 3)] * 64) for i in range(40)]
    for vectors in (grid, grid[:5], [], [(1, None)]):
        df = spark.createDataFrame([(i, e, "x", "c", 1, 2) for i, e in vectors], VECTORS)
        assert Counter(tuple(r) for r in centroids.with_inertia(*centroids.clusters(df)).collect()) == lloyd(vectors)


def test_bounds_save_distances_and_never_lie():
    """Loosened bounds hold in every round, and most centroids needn't be evaluated."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * (rng.normal(size=(8, 64))[rng.integers(0, 8, 2000)] + 0.3 * rng.normal(size=(2000, 64)))).astype(np.int64)
    history = x[:8][None].copy()
    state = centroids.Bounds.evaluated(x, history[-1], 0)
    evaluated = []
    for now in range(1, 9):
        means = np.stack([x[state.cluster == j].sum(axis=0) // max(1, (state.cluster == j).sum()) if (state.cluster == j).any() else c for j, c in enumerate(history[-1])])
        history = np.concatenate([history, means[None]])
        state.renew(history, 0)
        true = np.sqrt(((x[:, None] - means[None]) ** 2).sum(axis=2))
        gone = centroids.displacement(history)
        lows = state.lows - gone[np.arange(8), state.lows_at]
        others = np.ones(true.shape, dtype=bool)
        others[np.arange(len(x)), state.cluster] = False
        assert (lows[others] <= true[others] + 1e-6).all()
        assert (state.cluster == ((x[:, None] - means[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        evaluated.append((state.lows_at[others.nonzero()] == now).mean())
    assert np.mean(evaluated) < 0.5
