"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import json
import random

import public_tokenizers
import pyarrow as pa
import pytest
from texts import prose

from forerate.llm import piece_counts, pieces, quality, queries, tool_calls


def line(rng: random.Random, n: int) -> str:
    return prose(rng, n, 10**6).replace("\n", " ")


def test_template_pages_are_depleted_and_near_copies_count_once(spark):
    rng = random.Random(31)
    menu = [line(rng, 30) for _ in range(3)]
    rows = [(i, "\n".join([*menu, line(rng, 20)]), "h") for i in range(70)]
    body = [line(rng, 12) for _ in range(20)]
    rows += [(100 + i, "\n".join([*body, line(rng, 3)]), "h") for i in range(70)]  # near copies of one text
    rows += [(200 + i, "\n".join([*menu, line(rng, 20)]), "few") for i in range(49)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r.doc_id: r for r in quality.judged(df).collect()}
    assert all(got[i].n_cut == 90 and not got[i].kept for i in range(70))
    assert all(got[i].n_cut == 0 and got[i].kept for i in (*range(100, 170), *range(200, 249)))
    assert {r.doc_id for r in quality.kept_documents(df).collect()} == {*range(100, 170), *range(200, 249)}


TURNS = "conv_id long, turn long, role string, text string"


def chat(spark, turns):
    calls, results, others = queries.calls_and_results(spark.createDataFrame(turns, TURNS))
    return tool_calls.linked(calls, results, queries.TOOLS).unionByName(tool_calls.plain(others)).collect()


def test_every_turn_is_in_a_message_with_its_whole_text(spark):
    long = "word " * 60 + '"quoted" \\ end'
    turns = [
        *[(1, 0, "user", "first"), (1, 1, "assistant", long), (1, 2, "user", "answer"), (1, 3, "assistant", long + "x")],
        *[(None, 0, "user", "hello"), (None, 1, "assistant", long), (None, 2, "user", None)],
        (2, 0, "system", "rules"),
    ]
    got = {(r.conv_id, r.turn): r for r in chat(spark, turns)}
    assert json.loads(got[1, 1].message)["arguments"]["query"] == long and got[1, 1].error == "query is too large"
    assert json.loads(got[1, 3].message)["arguments"]["query"] == long + "x"
    assert got[None, 1].status == "linked" and json.loads(got[None, 1].message)["arguments"]["query"] == long
    plain = {k: json.loads(r.message) for k, r in got.items() if r.status == "message"}
    assert plain == {
        (1, 0): {"content": "first", "role": "user"},
        (None, 0): {"content": "hello", "role": "user"},
        (2, 0): {"content": "rules", "role": "system"},
    }


def test_needs_follow_the_order_of_the_calls(spark):
    roles = ["system", *["user", "assistant"] * 5, "user", "user"]
    turns = [(1, t, r, f"text {t}") for t, r in enumerate(roles)]
    turns += [(2, 3 * t, r, f"text {t}") for t, r in enumerate(["user", "assistant", "assistant", "user"])]
    got = {(r.conv_id, r.turn): r for r in chat(spark, turns)}
    assert [got[1, t].level for t in (2, 4, 6, 8, 10)] == [0, 1, 1, 2, 2]
    assert [got[2, t].level for t in (3, 6)] == [0, 1] and got[2, 3].status == "open"
    assert [json.loads(got[1, t].message)["result"] for t in (2, 10)] == ["text 3", "text 11"]
    assert {k for k, r in got.items() if r.status == "message"} == {(1, 0), (1, 1), (1, 12), (2, 0)}
    assert not any(r.status == "orphan" or "missing need" in (r.error or "") for r in got.values())


def test_missing_needs_are_told(spark):
    ok = json.dumps({"query": "some words here", "limit": 3})
    calls = [(1, 1, "a", "search", ok, ["lost", None]), (1, 2, "b", "search", "{", ["a", "lost", "gone"]), (1, 3, "c", "search", ok, ["a"])]
    calls = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: r for r in tool_calls.linked(calls, results, queries.TOOLS).collect()}
    assert {k: r.error for k, r in got.items()} == {"a": "missing need: lost", "b": "not JSON; missing need: gone, lost", "c": None}
    assert {k: r.level for k, r in got.items()} == {"a": 0, "b": 1, "c": 1}


def best_sum(scores: dict[str, float], unknown: float, text: str) -> float:
    """Over all cuts of a whole text, without cutting it into units first."""
    text = "▁" + text.replace("▁", "\ufffe").replace(" ", "▁")
    longest, best = max(map(len, scores)), [0.0]
    for end in range(1, len(text) + 1):
        starts = [s for s in range(max(0, end - longest), end) if text[s:end] in scores]
        best.append(max([best[end - 1] + unknown, *(best[s] + scores[text[s:end]] for s in starts)]))
    return best[-1]


def checked(v: pieces.Vocabulary, known: list[tuple[str, float]], texts: list[str]) -> list[list[int]]:
    scores, by_id = {t: s for t, s in known if t}, {i: s for i, (t, s) in enumerate(known) if t}
    got = pieces.piece_lists(pa.array(texts), v).to_pylist()
    for text, ids in zip(texts, got, strict=True):
        assert b"".join(v.surfaces[i] for i in ids).decode() == (" " + text if text else "")
        total, run = 0.0, b""
        for i in ids:  # bytes of one unknown character cost once
            run = b"" if i in by_id else run + v.surfaces[i]
            total += by_id.get(i, 0.0)
            if run and len(run.decode(errors="ignore")):
                total, run = total + v.unknown, b""
        assert total == pytest.approx(best_sum(scores, v.unknown, text) if text else 0.0, rel=1e-12)
    return got


def test_runs_of_spaces_use_all_pieces_of_the_model():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, v, rng = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Vocabulary.load(path), random.Random(33)
    skipped = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    known = [("" if skipped(i) else model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    parts = ["the", "def", "\n", ".", "▁", "é", "😀", " ", "  ", "   ", " " * 8, " " * 16, " " * 37]
    texts = ["", " ", "   ", "a    b", "x\n        return", *("".join(rng.choices(parts, k=rng.randrange(1, 8))) for _ in range(200))]
    got = checked(v, known, texts)
    long = {i for i, (t, _) in enumerate(known) if len(t) > 1 and not t.strip("▁")}
    assert len(long) > 10 and long & {i for ids in got for i in ids}


def test_pieces_with_a_mark_behind_a_character():
    texts = ["▁", "a", "b", "▁a", "▁▁", "b▁", "a▁b", "▁▁▁"]
    known = [("", 0.0)] * 256 + [(t, -float(i % 3) - 1) for i, t in enumerate(texts)]
    v = pieces.Vocabulary(known, range(256), [bytes([i]) for i in range(256)] + [t.replace("▁", " ").encode() for t in texts])
    rng = random.Random(34)
    checked(v, known, ["".join(rng.choice("ab  ▁c") for _ in range(rng.randrange(10))) for _ in range(300)])


CALLS = "conv_id string, turn long, call_id string, name string, arguments string, needs array<string>"
RESULTS = "conv_id string, turn long, call_id string, content string"


def test_conversations_don_t_mix_and_nothing_is_left_out(spark):
    ok = '{"query": "q", "limit": 2}'
    calls = [
        ("a/b", 1, "c", "search", ok, []),
        ("a", 1, "b/c", "search", ok, ["x"]),
        ("a", 2, "x", "search", ok, []),
        (None, 1, "k", "search", ok, []),
        ("null", 1, "k", "search", ok, []),
        ("d", 1, "k", "search", ok, []),
        ("d", 1, "k", "search", '{"query": "other", "limit": 2}', []),
        ("d", 1, "k", "search", ok, []),
        ("e", 1, "k", "search", "no \"json\"", []),
    ]
    results = [("a", 2, "b/c", "of a"), ("null", 2, "k", "named"), ("d", 2, "k", "one"), ("d", 3, "k", "two"), ("d", 3, "k", "two")]
    got = tool_calls.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), queries.TOOLS).collect()
    by = {(r.conv_id, r.call_id, r.status): json.loads(r.message) for r in got}
    assert set(by) == {
        *[("a/b", "c", "open"), ("a", "b/c", "linked"), ("a", "x", "open"), (None, "k", "open"), ("null", "k", "linked")],
        *[("d", "k", "linked"), ("d", "k", "repeated"), ("d", "k", "later result"), ("e", "k", "open")],
    }
    assert len(got) == len(by)
    assert by["a", "b/c", "linked"]["result"] == "of a" and by["null", "k", "linked"]["result"] == "named"
    written = {by["d", "k", s]["arguments"]["query"] for s in ("linked", "repeated")}
    assert written == {"q", "other"} and by["d", "k", "later result"]["result"] == "two" and by["d", "k", "linked"]["result"] == "one"
    assert by["e", "k", "open"]["arguments"] == 'no "json"'
    assert {r.level for r in got if (r.conv_id, r.call_id) == ("a", "b/c")} == {1}
    chat_rows = chat(spark, [(1, 0, "user", "u"), (1, 1, "assistant", "one"), (1, 1, "assistant", "two"), (1, 2, "user", "r1"), (1, 2, "user", "r2")])
    told = " ".join(r.message for r in chat_rows)
    assert all(t in told for t in ("one", "two", "r1", "r2"))


def test_long_words_are_walked_like_short_ones(monkeypatch):
    rng = random.Random(17)
    automaton = piece_counts.automaton_of(*map(tuple, piece_counts.pieces_of_model(public_tokenizers.path("piece_bpe_32k.model"))))
    words = pa.array(["".join(rng.choice("abthe中é😀\x01") for _ in range(rng.randrange(0, 400))) for _ in range(200)] + ["", "a" * 100_000])
    got = [automaton.counts(words).tolist()]
    for limit in (0, 1000):
        monkeypatch.setattr(piece_counts, "LONG_WORD", limit)
        got.append(automaton.counts(words.slice(0, 201)).tolist())
    assert got[0][:201] == got[1] == got[2]
