"""Documents that try the operators: a small corpus with copies, near copies and
shared passages, and rows with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns whose names the operators use themselves.
CLASHING = SCHEMA + ", kept int, row string, d int, t string, size int, taken string, text_ string, verdict int, label int"


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{int(rng.paretovariate(0.6)) % size}" for _ in range(n)]


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    passage = " ".join(words(rng, 70, 5000))
    rows = []
    for i in range(n):
        body = words(rng, rng.randint(30, 200), 5000)
        lines = [" ".join(body[k:k + 9]) for k in range(0, len(body), 9)]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        if i % 5 == 0:
            lines[1:1] = ["one shared line", "and a second", "and the third", "closing it"]
        rows.append((i, "\n".join(lines), ("en", "de")[i % 2], f"s{i % 4}"))
    for i in range(n, n + 12):  # copies
        rows.append((i, rows[i % 7][1], "en", "s0"))
    for i in range(n + 12, n + 24):  # near copies: a word changed
        body = rows[(i % 5) * 3][1].split(" ")
        body[rng.randrange(len(body))] = f"changed{i}"
        rows.append((i, " ".join(body), "en", None))
    return [(*r[:4], len(r[1])) for r in rows]


def odd_rows() -> list[tuple]:
    long_text = " ".join(f"x{k % 997} y{k % 31}" for k in range(30_000))
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\r ", None, None, 5), (4, "one", "en", "a", 3),
        (5, "one", "en", "a", 3), (None, "a text without an id " * 6, "en", "b", 126), (None, None, None, None, None),
        (7, "the same row twice over " * 8, "de", "b", 192), (7, "the same row twice over " * 8, "de", "b", 192),
        (7, "the same id with another text " * 5, "de", "c", 150), (8, long_text, "en", "c", len(long_text)),
        (9, "l1\nl2\nl3\nl1\nl2\nl3\nl4", "en", "c", 21), (10, "café Über \U0001f600   naïve\x1cx", "fr", "c", 20),
        (11, "# * $ % & | < > " * 4, "en", "c", 64), (-12, "a negative id and some words", "en", "c", 28),
    ]


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def frames(spark):
    """(plain rows, odd rows with clashing columns, empty table)."""
    odd = [(*r, 1, "r", 2, "t", 3, "x", "y", 4, 5) for r in odd_rows()]
    return (spark.createDataFrame(corpus(), SCHEMA), spark.createDataFrame(odd, CLASHING), spark.createDataFrame([], SCHEMA))
