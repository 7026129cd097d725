"""Made texts for the tests of the text operators."""

from __future__ import annotations

import random

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use inside
    "mark long, s long, n int, h string, hash string, key string, part int, tie int, host_key int, pieces int, _left string"
)
COLUMNS = [c.split()[0] for c in DOCS.split(", ")]


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return "".join(f"w{rng.randrange(vocabulary)}{rng.choice([' ', ' ', ' ', '  ', chr(10), ', '])}" for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed: int) -> list[tuple[int | None, str | None]]:
    """Plain texts, copies, near copies of several grades, shared passages, and odd rows."""
    rng = random.Random(seed)
    out: list[str | None] = [prose(rng, rng.randrange(1, 250)) for _ in range(60)]
    for size in (200, 160, 120):
        origin = prose(rng, size)
        out += [origin] * 3 + [edited(rng, origin, e) for e in (0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 5, 6, 8)]
    passage = prose(rng, 70)
    out += [prose(rng, rng.randrange(60)) + " " + passage + " " + prose(rng, rng.randrange(60)) for _ in range(8)]
    out += ["", None, " \n\t ", "one", "One", "one two", "ONE two", "a b c", "A B C", "Ünï çödé Ünï çödé  Ünï çödé", "the " * 300]
    out += ["Ünï ▁ <|endoftext|> 😀   \x1c   ends"] * 2
    out.append(prose(rng, 30_000))
    rng.shuffle(out)
    rows: list[tuple[int | None, str | None]] = [(3 * i + 1, t) for i, t in enumerate(out)]
    return [*rows, rows[5], (None, out[7]), (None, None)]


def frame(spark, rows):
    full = [(i, t, "en", f"src{(i or 0) % 2}", len(t or ""), 1, 2, 3, "h", "x", "k", 4, 5, 6, 7, "l") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(4)
