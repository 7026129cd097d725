"""Quality rules, URL filter, tool calls and shards."""

from __future__ import annotations

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from texts import COLUMNS, prose

from forerate.llm import quality, queries, slots, tool_calls, url_filter

# ---- quality


def test_base_measures_match_brute_force(docs, rows):
    got = quality.judged(docs).collect()
    want = Counter((i, *brute.base_measures(t), brute.base_failed(t)) for i, t in rows)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def lined(rng: random.Random, n: int) -> str:
    return "\n".join(prose(rng, 12, 10**6).replace("\n", " ") for _ in range(n))


@pytest.fixture(scope="module")
def hosted(spark):
    rng = random.Random(9)
    common, other = prose(rng, 9).replace("\n", " "), prose(rng, 12).replace("\n", " ")
    menu = [prose(rng, 30, 10**6).replace("\n", " ") for _ in range(3)]
    rows = [(i, lined(rng, 8) + "\n" + common.upper() + "\n", "hot") for i in range(60)]
    rows += [(100 + i, "\n".join([*menu, prose(rng, 20, 10**6).replace("\n", " "), other]), "hot") for i in range(70)]
    rows += [(200 + i, lined(rng, 8) + "\n" + common, "cold") for i in range(5)]
    clean = lined(rng, 10)
    rows += [(300 + i, clean, "hot") for i in range(200)]
    base = lined(rng, 12).split("\n")
    for i in range(200):  # variants of one text
        some = list(base)
        some[rng.randrange(12)] = prose(rng, 12, 10**6).replace("\n", " ")
        rows.append((600 + i, "\n".join(some), "hot"))
    rows += [(900, clean, None), (901, None, None), (None, clean, "hot")]
    rng.shuffle(rows)
    return rows, common, spark.createDataFrame([(*r, 1, len(r[1] or ""), 2) for r in rows], "doc_id long, text string, source string, mark long, n_chars long, key int").repartition(5)


def test_boilerplate_and_template_pages_go_and_copies_stay(hosted):
    rows, common, df = hosted
    got = {r.doc_id: r for r in quality.judged(df).collect()}
    for i, r in got.items():
        kind = "none" if i is None else "odd" if i >= 900 else i // 100
        assert r.kept == (i != 901 and kind != 1), (i, kind)
    assert all(got[i].n_cut == 9 for i in range(60))
    assert all(got[200 + i].n_cut == 0 for i in range(5))
    assert all(got[i].n_cut == 0 for i in (*range(300, 500), *range(600, 800), 900))


def test_depleted_documents_are_rejected(spark):
    rng = random.Random(10)
    menu = [prose(rng, 40, 10**6).replace("\n", " ") for _ in range(30)]
    rows = [(i, "\n".join([*rng.sample(menu, 2), prose(rng, 90, 10**6).replace("\n", " ")]), "h") for i in range(400)]
    rows += [(1000 + i, "\n".join(rng.sample(menu, 2)), "h") for i in range(20)]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_docs=15).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(20))


def test_kept_documents_lose_boilerplate_only(hosted):
    rows, common, df = hosted
    left = quality.kept_documents(df)
    assert left.columns == df.columns
    got = Counter((r.doc_id, r.text, r.n_chars) for r in left.collect())
    measured = {r.doc_id: r for r in quality.judged(df).collect()}
    whole = Counter((i, t, len(t or "")) for i, t, _ in rows if measured[i].kept and not measured[i].n_cut)
    assert not whole - got
    for i, t, s in rows:
        if i is not None and i < 60:
            text = t.removesuffix("\n" + common.upper() + "\n")
            assert got[i, text, len(text)] == 1
    assert sum(got.values()) == sum(measured[i].kept for i, *_ in rows)


def test_quality_of_no_rows(no_docs):
    assert quality.judged(no_docs).count() == 0
    assert quality.kept_documents(no_docs).columns == COLUMNS


# ---- URLs

RULES = queries.RULES


def host_path(url: str | None) -> tuple[str, str]:
    m = re.search(r"://", url or "")
    if not m:
        return "", ""
    rest = url[m.end() :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(url: str | None) -> url_filter.Rule | None:
    host, path = host_path(url)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


ODD = [
    None, "", "x", "://", "http://", "http://NET/", "http://net", "http://a.Net?x=/y", "http://notnet/", "http://a.example.net/en/1#?",
    "http://example.net/en", "http://É.org/fr/", "a://b://c.net/x", "http://a.net/\nb?c", "http://u@h.example.com:80/de/?#", "http://x.com/" + "long/" * 2000,
]


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(12)
    urls = list(ODD)
    for _ in range(600):
        tld, lang = rng.choice(["net", "com", "org"]), rng.choice(["en", "de", "fr"])
        bad = tld == "net" or lang == "de"
        name = "".join(rng.choice(["spam", "win", "bet"] if bad else ["news", "info", "lab"]) for _ in range(3))
        urls.append(f"http://{name}.example.{tld}/{lang}/{rng.randrange(999)}")
    urls += urls[20:30]
    rows = [(i, u, "<p>", 1, "g") for i, u in enumerate(urls)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, score int, gram string").repartition(3)


def test_hosts_rules_and_verdicts(pages):
    rows, df = pages
    got = {r.page_id: r for r in url_filter.judged(df, RULES).collect()}
    assert len(got) == len(rows)
    for i, url, *_ in rows:
        rule, r = rule_of(url), got[i]
        assert (r.host, r.path) == host_path(url)
        assert r.rule == (rule and rule.name)
        assert not rule or r.verdict == ("allow" if rule.allow else "block")
    assert got[0].verdict == "allow"


def ratios(train: list[tuple[str, bool]], every: list[str], order: int) -> dict[str, float]:
    """Mean log-likelihood difference per character by plain counting."""
    counts = {c: defaultdict(Counter) for c in (True, False)}
    for url, allowed in train:
        text = url_filter.START * order + url
        for i in range(order, len(text)):
            for k in range(order + 1):
                counts[allowed][text[i - k : i]][text[i]] += 1

    def prob(c: bool, context: str, char: str) -> float:
        seen = counts[c][context]
        total, kinds = sum(seen.values()), len(seen)
        shorter = prob(c, context[1:], char) if context else 1 / 256
        p = (seen[char] + kinds * shorter) / (total + kinds) if total else shorter
        return p if context else 0.999 * p + 0.001 / 256

    out = {}
    for url in every:
        text = url_filter.START * order + url
        logs = [math.log(prob(True, text[i - order : i], text[i])) - math.log(prob(False, text[i - order : i], text[i])) for i in range(order, len(text))]
        out[url] = sum(logs) / len(logs)
    return out


def test_scores_match_plain_counting(spark, pages):
    rows, df = pages
    short = [u for _, u, *_ in rows if u and len(u) < 200]
    ruled = url_filter.ruled(df, RULES).where("length(url) < 200")
    labelled = ruled.where("allowed is not null")
    train = [(r.url, r.allowed) for r in labelled.collect()]
    table = url_filter.gram_ratios(url_filter.windows(labelled, "allowed", order=3), url_filter.windows(ruled, order=3), 3)
    got = {r.key: r.score for r in url_filter.scored(ruled, table, 3).collect()}
    keys = dict(spark.createDataFrame([(u,) for u in set(short)], "url string").selectExpr("url", "xxhash64(url)").collect())
    want = ratios(train, list(keys), 3)
    assert len(got) == len(keys)
    for url, key in keys.items():
        assert got[key] == pytest.approx(want[url], abs=1e-6)


def test_held_out_urls_are_told_apart(pages):
    rows, df = pages
    got = {r.page_id: r for r in url_filter.judged(df, RULES).collect()}
    free = [(u, got[i].verdict) for i, u, *_ in rows[len(ODD) :] if not rule_of(u)]
    right = sum((v == "block") == any(w in u for w in ("spam", "win", "bet")) for u, v in free)
    assert len(free) > 50 and right / len(free) > 0.9


def test_urls_without_a_class(spark, pages):
    one = pages[1].where("url like '%.net/de/%'")
    assert {r.verdict for r in url_filter.judged(one, RULES).collect()} == {"block"}
    assert url_filter.judged(one.limit(0), RULES).count() == 0


# ---- tool calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, key string, level int"
RESULTS = "conv_id long, turn long, call_id string, content string, name string"


def levels(calls: list[tuple]) -> dict[tuple, int | None]:
    first: dict[tuple, tuple] = {}
    for c in sorted(calls, key=lambda c: c[1]):
        first.setdefault((c[0], c[2]), c)
    out: dict[tuple, int | None] = {}
    for _ in range(len(first) + 1):
        for k, c in first.items():
            known = [(k[0], n) for n in c[5] or [] if (k[0], n) in first]
            if k not in out and all(n in out for n in known):
                out[k] = max((out[n] + 1 for n in known), default=0)
    return {k: out.get(k) for k in first}


def test_links_levels_and_checks(spark):
    rng = random.Random(13)
    ok = json.dumps({"query": "some words here", "limit": 3})
    calls = [(c, t, f"i{t}", "search", ok, [f"i{rng.randrange(t + 2)}" for _ in range(rng.randrange(3))], "k", 1) for c in range(6) for t in range(12)]
    calls += [(9, t, f"d{t}", "search", ok, [f"d{t - 1}"], "k", 1) for t in range(25)]  # a chain
    calls += [(10, 1, "a", "search", ok, ["b"], "k", 1), (10, 2, "b", "search", ok, ["a"], "k", 1), (10, 3, "c", "search", ok, ["b"], "k", 1)]
    calls += [(None, 1, "n", "search", ok, None, "k", 1), (11, 5, "x", "search", ok, [], "k", 1), (11, 2, "x", "count", ok, [], "k", 1), (11, 7, None, "search", ok, [], "k", 1)]
    results = [(c, t + 1, f"i{t}", f"r{t}", "z") for c in range(6) for t in range(0, 12, 2)] + [(0, 30, "i0", "late", "z"), (5, 1, "nobody", None, "z"), (None, 2, "n", None, "z")]
    got = tool_calls.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), queries.TOOLS).collect()
    further = [(r.conv_id, r.call_id, r.turn, r.status) for r in got if r.status in ("repeated", "later result")]
    assert sorted(further) == [(0, "i0", 30, "later result"), (11, "x", 5, "repeated")]
    got = [r for r in got if r.status not in ("repeated", "later result")]
    by = {(r.conv_id, r.call_id): r for r in got}
    assert len(by) == len(got)
    want = levels([c for c in calls if c[2]])
    assert {k: r.level for k, r in by.items() if r.status != "orphan"} == want
    answered = {(c, i) for c, _, i, *_ in results}
    for k, r in by.items():
        assert r.status == ("orphan" if k not in want else "cycle" if want[k] is None else "linked" if k in answered else "open")
    assert by[0, "i0"].n_results == 2 and json.loads(by[0, "i0"].message)["result"] == "r0"
    assert by[11, "x"].name == "count" and by[None, "n"].status == "linked"
    message = by[0, "i0"].message
    assert message == json.dumps(json.loads(message), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize(
    ("name", "arguments", "error"),
    [
        ("search", '{"query": "q", "limit": 1}', None),
        ("search", '{"limit": 120 ,"query":""}', None),
        ("search", '{"query": "q", "limit": 121}', "limit is too large"),
        ("search", '{"query": "q", "limit": 0}', "limit is too small"),
        ("search", '{"query": "q", "limit": "1"}', "limit is not integer"),
        ("search", '{"query": null, "limit": 1}', "query is missing"),
        ("search", '{"query": "q"}', "limit is missing"),
        ("search", '{"query": "q", "limit": 1, "more": 2}', "unknown argument"),
        ("search", '{"query": "' + "q" * 201 + '", "limit": 1}', "query is too large"),
        ("search", "[1]", "not an object"),
        ("search", "{", "not JSON"),
        ("search", None, "not JSON"),
        ("count", '{"query": "long enough q", "exact": true}', None),
        ("count", '{"query": "long enough q", "exact": 1}', "exact is not boolean"),
        ("unheard", "{}", "unknown tool"),
        (None, "{}", "unknown tool"),
    ],
)
def test_arguments_are_checked(spark, name, arguments, error):
    df = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    assert df.select(tool_calls.argument_error(df["name"], df["arguments"], queries.TOOLS)).first()[0] == error


def test_no_calls(spark):
    empty = tool_calls.linked(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), queries.TOOLS)
    assert empty.count() == 0


# ---- shards


def test_shards_are_even_and_gapless(docs, rows):
    got = slots.shard(docs, 5, 64).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(5))
    for some in by.values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
    slot_bytes = Counter()
    for r in got:
        slot_bytes[r.vslot] += r.size
    assert all(len({r.shard for r in got if r.vslot == v}) == 1 for v in slot_bytes)
    sums = [sum(r.size for r in some) for some in by.values()]
    assert max(sums) - min(sums) <= max(slot_bytes.values())


def test_map_is_versioned_and_edited(spark, docs, rows, tmp_path):
    folder = str(tmp_path / "map")
    slots.shard(docs, 4, 128, folder)
    records = slots.slot_records(docs, 128)
    sizes = slots.slot_sizes(records, 128)
    old = [r.shard for r in slots.read_map(spark, folder, 1).orderBy("vslot").collect()]
    new = slots.rebalanced(old, sizes, 5)
    slots.store_map(spark, folder, 2, new, sizes)
    moved = [i for i in range(128) if old[i] != new[i]]
    assert 4 in {new[i] for i in moved} and 0 < len(moved) < 64
    held = Counter()
    for i, shard in enumerate(new):
        held[shard] += sizes[i][0]
    whole = max(b for b, _ in sizes)  # one text is larger than all others together
    rest = sorted(b for b in held.values() if b < whole)
    assert len(rest) == 4 and rest[-1] < 1.3 * rest[0]
    fewer = slots.rebalanced(new, sizes, 3)
    assert set(fewer) == {0, 1, 2}
    assert [r.shard for r in slots.read_map(spark, folder, 1).orderBy("vslot").collect()] == old
    path = slots.write_shards(docs, slots.read_map(spark, folder, 2), str(tmp_path / "out"), 128)
    assert spark.read.parquet(path).count() == len(rows)


def test_no_records(no_docs):
    assert slots.shard(no_docs, 3, 16).count() == 0
