"""Periodic runs against all stretches of all periods, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tapeworks.llm import periodic
from tests.llm.fixtures import CLASHING, SCHEMA, corpus, odd_rows, tokens


def brute_runs(w):
    """(start, length, period) of all runs, by trying every period at every place."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        k = 0
        while k + q < len(w):
            if w[k] != w[k + q]:
                k += 1
                continue
            end = k
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            size = end + q - k
            part = w[k:k + size]
            smallest = next(p for p in range(1, q + 1) if all(part[i] == part[i + p] for i in range(size - p)))
            if size >= max(6, 4 * q) and smallest == q:
                out.append((k, size, q))
            k = end + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def brute_row(doc_id, text):
    w = tokens(text)
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    top = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_words(rng):
    w = []
    for _ in range(rng.randint(1, 6)):
        part = [rng.choice("abcdef") + str(rng.randint(0, rng.choice([0, 2, 9]))) for _ in range(rng.randint(1, 9))]
        w += (part * rng.randint(1, 9))[:rng.randint(1, 70)]
    return w


def test_runs_match_brute_force_on_periodic_words():
    rng = random.Random(7)
    docs = [periodic_words(rng) for _ in range(300)] + [["a"] * n for n in range(9)] + [["a", "b"] * 40, list("abaababaabaab") * 6, []]
    seen = 0
    for k in range(0, len(docs), 7):
        some = docs[k:k + 7]
        hashes = np.array([hash(x) & (2**63 - 1) for d in some for x in d], np.uint64)
        doc = np.repeat(np.arange(len(some)), [len(d) for d in some])
        start, length, period = periodic.runs_of(hashes, doc)
        first = np.concatenate([[0], np.cumsum([len(d) for d in some])])
        for i, d in enumerate(some):
            inside = (start >= first[i]) & (start < first[i + 1])
            got = list(zip((start[inside] - first[i]).tolist(), length[inside].tolist(), period[inside].tolist()))
            assert got == brute_runs(d), d
            seen += len(got)
    assert seen > 300


def test_query_matches_brute_force(spark):
    rng = random.Random(8)
    rows = corpus() + [(1000 + i, " ".join(periodic_words(rng)), "en", "s", 1) for i in range(150)] + [(2000, "a \t" * 7, "en", "s", 1)]
    got = periodic.runs_digest(periodic.find_runs(periodic.with_repeats(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert Counter(map(tuple, got)) == Counter(brute_row(r[0], r[1]) for r in rows)
    assert sum(r.n_runs for r in got) > 100
    odd = [(*r, 1, "r", 2, "t", 3, "x", "y", 4, 5) for r in odd_rows() if len(r[1] or "") < 10_000]
    df = spark.createDataFrame(odd, CLASHING).withColumnsRenamed({"kept": "runs", "size": "collapsed", "d": "n_words"})
    got = periodic.runs_digest(periodic.find_runs(periodic.with_repeats(df))).collect()
    assert Counter(map(tuple, got)) == Counter(brute_row(r[0], r[1]) for r in odd)
    assert periodic.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("word, n", [("la la ", 60_000), ("one two three four five ", 30_000)])
def test_very_long_text(spark, word, n):
    row = periodic.find_runs(spark.createDataFrame([(1, word * n + "end")], "doc_id long, text string")).first()
    q = 1 if word.startswith("la") else 5
    assert [tuple(r) for r in row.runs] == [(0, len(word.split()) * n, q)]
    assert row.collapsed == " ".join([*word.split()[:q], "end"])
