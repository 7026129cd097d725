"""N-gram join, decontamination and substring dedup against brute force."""

from __future__ import annotations

import random
from collections import Counter

import brute
import pytest
from texts import COLUMNS, corpus, edited, prose

from forerate.llm import decontaminate, ngram_join, substrings


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_match_brute_force(docs, rows, k, percent):
    got = ngram_join.classes(docs, k, percent).collect()
    want = brute.components(rows, k, percent)
    sets = [(i, len(brute.shingles(t, k)), None if i is None else want[i]) for i, t in rows]
    assert Counter(map(tuple, got)) == Counter(sets)


def test_hot_group_of_variants_keeps_every_link(spark, make):
    """Hundreds of texts that share most shingles, linked only in part: more than one round of pairs."""
    rng = random.Random(3)
    origin = prose(rng, 90)
    rows = [(i, edited(rng, origin, rng.randrange(6))) for i in range(250)]
    got = {r.doc_id: r.component_id for r in ngram_join.classes(make(rows), 3, 90).collect()}
    assert got == brute.components(rows, 3, 90)
    assert 1 < len(set(got.values())) < 250


def test_chain_of_links_is_one_component(make):
    w = [f"c{i}" for i in range(300)]
    rows = [(i, " ".join(w[3 * i : 3 * i + 150])) for i in range(40)]
    got = ngram_join.classes(make(rows), 3, 90).collect()
    assert {r.component_id for r in got} == {0}


def test_one_of_each_keeps_smallest_and_columns(docs, rows):
    left = ngram_join.one_of_each(docs)
    want = brute.components(rows, 5, 80)
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert left.columns == COLUMNS
    assert Counter(i for i in ids if i is not None) == Counter({i for i in want if want[i] == i})
    assert ids.count(None) == 2


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.classes(no_docs, 3, 90).count() == 0
    assert ngram_join.one_of_each(no_docs).count() == 0
    assert decontaminate.contained(no_docs, items).count() == 0
    assert decontaminate.decontaminated(no_docs, items).count() == 0
    assert substrings.substring_digest(no_docs).count() == 0
    assert substrings.without_repeats(no_docs).columns == COLUMNS


@pytest.fixture(scope="module")
def leaked(rows):
    rng = random.Random(5)
    items = [(j, prose(rng, n)) for j, n in enumerate([5, 6, 9, 14, 20, 33, 60, 61, 130])]
    items += [(90, None), (91, ""), (92, "too short here"), (93, items[3][1]), (93, items[4][1])]
    out = list(rows)
    for j, text in items[:9]:
        for e in range(4):
            out.append((10_000 + 10 * j + e, prose(rng, 400) + " " + edited(rng, text, e) + " " + prose(rng, 2000)))
    return out, items


def test_leaks_match_brute_force(spark, make, leaked):
    rows, items = leaked
    table = spark.createDataFrame([(j, t, 1) for j, t in items], "item_id long, text string, hash int")
    got = decontaminate.contained(make(rows), table).collect()
    want = brute.leaks(rows, [x for x in items if x[0] != 93])
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in got if r.item_id != 93} == want
    assert len(want) >= 9
    left = decontaminate.decontaminated(make(rows), table)
    assert left.columns == COLUMNS
    dirty = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in dirty)


def test_no_items_leave_all(spark, docs, rows):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminated(docs, items).count() == len(rows)


@pytest.mark.parametrize(("window", "first"), [(50, 25), (50, 7), (13, 13), (9, 2), (1, 1)])
def test_substrings_match_brute_force(docs, rows, window, first):
    got = substrings.substring_digest(docs, window, first).collect()
    want = []
    for (i, text), gone in zip(rows, brute.covered(rows, window), strict=True):
        w = brute.words(text)
        want.append((i, len(w), sum(gone), brute.sha([x for x, g in zip(w, gone, strict=True) if not g])))
    assert Counter(map(tuple, got)) == Counter(want)


def test_texts_are_cut(docs, rows):
    left = substrings.without_repeats(docs)
    want = [(i, brute.cut_text(t, gone)) for (i, t), gone in zip(rows, brute.covered(rows, 50), strict=True)]
    assert left.columns == COLUMNS
    got = left.select("doc_id", "text", "n_chars").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(want)
    assert all(r.n_chars == len(r.text or "") for r in got)


def test_one_id_for_several_texts(make):
    rng = random.Random(8)
    passage = prose(rng, 60)
    rows = [(1, passage + " a"), (1, passage + " b"), (2, "c " + passage), (2, prose(rng, 80)), (3, passage)]
    got = substrings.substring_digest(make(rows)).collect()
    want = [(i, len(brute.words(t)), sum(g)) for (i, t), g in zip(rows, brute.covered(rows, 50), strict=True)]
    assert Counter(r[:3] for r in map(tuple, got)) == Counter(want)


def test_levels():
    assert substrings.lengths(50, 25) == [25, 50]
    assert substrings.lengths(50, 7) == [7, 14, 28, 50]
    assert substrings.lengths(9, 20) == [9]
    assert len(corpus(1)) > 100
