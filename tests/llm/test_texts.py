"""Quality rules, line dedup, substring dedup and the Jaccard join against
brute force, and on odd rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from tapeworks.llm import jaccard, line_dedup, quality_rules, substrings
from tests.llm.fixtures import corpus, frames, odd_rows, tokens


@pytest.fixture(scope="module")
def tables(spark):
    return frames(spark)


def test_quality_base_and_verdict(spark, tables):
    plain, odd, empty = tables
    for df, rows in ((plain, corpus()), (odd, odd_rows())):
        got = quality_rules.quality_rules(df).collect()
        expected = Counter()
        for doc_id, text, *_ in rows:
            w = [x.decode() for x in tokens(text)]
            windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            cover = {k + j for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for j in range(5)}
            lines = [x for x in (text or "").split("\n") if x.encode().split()]
            failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
            expected[(doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
                      len(lines) - len(set(lines)), len(cover), failed)] += 1
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                       for r in got) == expected
        assert not any(r.kept and r.base_failed for r in got)
        assert all(r.class_distance is None or 0 <= r.class_distance <= 1 for r in got)
    assert quality_rules.quality_rules(empty).count() == 0
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert quality_rules.keep_good(empty).count() == 0


def test_quality_distances_follow_the_definition(spark):
    prose = "It was the best of times and the worst of times said the old man to his dog. " * 8
    rows = [(i, prose + f"number {i}", "en") for i in range(30)] + [(99, "@@ || ## 12 34 !! " * 40, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality_rules.references(df)
    classes, cells, counts = refs["en"]
    assert classes.sum() == sum(len(r[1]) for r in rows)
    seen = Counter(w for r in rows for w in r[1].encode().split())
    assert [counts[k] for k in cells.values()] == [seen[w] for w in cells]
    assert counts.sum() == sum(seen.values())

    def distance(p, q):
        def kl(a, b):
            return sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
        m = [(x + y) / 2 for x, y in zip(p, q)]
        return math.sqrt((kl(p, m) + kl(q, m)) / 2)

    assert quality_rules.js_distance(classes, counts[: len(classes)]) == pytest.approx(
        distance([x / classes.sum() for x in classes.tolist()], (counts[: len(classes)] / counts[: len(classes)].sum()).tolist()))
    by_id = {r.doc_id: r for r in quality_rules.judge(df, refs).select("row.doc_id", "class_distance", "word_distance").collect()}
    assert by_id[99].class_distance > 0.5 and by_id[99].word_distance > 0.8
    assert by_id[3].class_distance < 0.2


def test_quality_references_do_not_depend_on_shares(spark):
    def text(letters, i, n=80):
        rng = random.Random(i)
        return " ".join(rng.choice(letters) * rng.randint(1, 3) for _ in range(n))

    hot = [(i, text("abcdefghij", i), "en") for i in range(4_000)]
    rare = [(10_000 + i, text("אבגדהוזחטי", i), "he") for i in range(30)] + [(20_000 + i, text("абвгдежзик", i), None) for i in range(30)]
    tiny = [(30_000, text("漢字文章言語学校", 1), "zh"), (30_001, text("漢字文章言語学校", 1)[:20], "zh")]
    odd = [(40_000, "@@ || ## 12 34 !! " * 40, "he")]
    df = spark.createDataFrame(hot + rare + tiny + odd, "doc_id long, text string, lang string")
    assert set(quality_rules.references(df)) == {"en", "he", None}
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert len(got) == df.count()
    assert all(got[i].kept and got[i].word_distance < 0.48 for i, *_ in rare)  # of less than 1% of the documents
    zh = got[30_000]
    assert zh.kept and zh.class_distance is None and zh.word_distance is None
    assert not got[40_000].kept and not got[30_001].kept
    assert quality_rules.keep_good(df).where("lang = 'he' or lang is null").count() == 60


def brute_lines(rows, run=3):
    """doc_id, lines, deleted, text by comparing all runs with all earlier ones."""
    order = sorted({(line_dedup.LAST if r[0] is None else r[0], r[1]) for r in rows if r[1] is not None},
                   key=lambda x: x[0])
    seen, out = set(), {}
    for d, text in order:
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for k in range(len(at) - run + 1):
            key = tuple(lines[j] for j in at[k:k + run])
            if key in seen:
                gone.update(at[k:k + run])
            seen.add(key)
        out[(d, text)] = (len(at), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_dedup(spark, tables):
    plain, odd, empty = tables
    for df, rows in ((plain, corpus()), (odd, odd_rows())):
        expected = brute_lines(rows)
        want = Counter((r[0], *expected[(line_dedup.LAST if r[0] is None else r[0], r[1])]) if r[1] is not None
                       else (r[0], 0, 0, None) for r in rows)
        assert Counter(map(tuple, line_dedup.line_dedup(df).collect())) == want
    assert sum(r[1] for r in brute_lines(corpus()).values()) > 50
    assert line_dedup.line_dedup(empty).count() == 0
    left = line_dedup.drop_repeated_lines(odd)
    assert left.dtypes == odd.dtypes and left.count() == len(odd_rows())
    assert all(r.n_chars == len(r.text) for r in line_dedup.drop_repeated_lines(plain).collect())


def brute_short_runs(rows, run=3, least=20):
    """(doc_id, text left) by comparing all runs of three lines, and of one or
    two lines with 20 words, with all earlier ones."""
    order = sorted({(line_dedup.LAST if r[0] is None else r[0], r[1]) for r in rows if r[1] is not None}, key=lambda x: x[0])
    seen, out = set(), {}
    for d, text in order:
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for size in range(1, run + 1):
            for k in range(len(at) - size + 1):
                key = tuple(lines[j] for j in at[k:k + size])
                if size == run or sum(len(x.encode().split()) for x in key) >= least:
                    if key in seen:
                        gone.update(at[k:k + size])
                    seen.add(key)
        if not gone or len(gone) < len(at):
            out[(d, text)] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_pipeline_deletes_short_runs_with_many_words(spark, tables):
    line = lambda n, tag: " ".join(f"{tag}{k}" for k in range(n))
    short = [(1, f"{line(25, 'a')}\nown one", "en", "s", 1), (2, f"own two\n{line(25, 'a')}", "en", "s", 1),  # one line
             (3, f"{line(12, 'b')}\n\n{line(9, 'c')}\nown three", "en", "s", 1), (4, f"{line(12, 'b')}\n{line(9, 'c')}", "en", "s", 1),
             (5, f"{line(12, 'b')}\nown five", "en", "s", 1), (6, f"{line(25, 'a')}", "en", "s", 1),  # 12 words stay; nothing is left
             (7, f"{line(19, 'd')}\n{line(19, 'd')}", "en", "s", 1), (8, f"{line(20, 'e')}\n{line(20, 'e')}", "en", "s", 1)]
    df = spark.createDataFrame(short, tables[0].schema)
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got == {1: short[0][1], 2: "own two", 3: short[2][1], 5: short[4][1], 7: short[6][1], 8: line(20, "e")}
    for df, rows in ((df, short), (tables[0], corpus()), (tables[1], odd_rows())):
        expected = brute_short_runs(rows)
        want = Counter((r[0], None if r[1] is None else expected[key]) for r in rows
                       if (key := (line_dedup.LAST if r[0] is None else r[0], r[1])) in expected or r[1] is None)
        assert Counter((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(df).collect()) == want


def test_line_dedup_of_short_runs(spark, tables):
    """The query's rule: runs of three lines, and of 20 words in one or two."""
    for df, rows in ((tables[0], corpus()), (tables[1], odd_rows())):
        left = brute_short_runs(rows)
        got = line_dedup.line_dedup(df, min_words=line_dedup.MIN_WORDS).collect()
        assert len(got) == len(rows)
        for r in got:
            keys = [(k, x) for k, x in left.items() if k[0] == (line_dedup.LAST if r.doc_id is None else r.doc_id)]
            if r.n_deleted < r.n_lines or r.n_deleted == 0:
                assert r.text is None or r.text in [x for _, x in keys]
        assert sum(r.n_deleted for r in got) >= sum(r.n_deleted for r in line_dedup.line_dedup(df).collect())
    plan = line_dedup.line_dedup(tables[0], min_words=line_dedup.MIN_WORDS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_uses_no_python(spark, tables):
    plan = line_dedup.line_dedup(tables[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_substrings(rows):
    order = sorted({(substrings.LAST if r[0] is None else r[0], r[1] or "") for r in rows})
    seen, out = set(), {}
    for d, text in order:
        w, gone = tokens(text), set()
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            if key in seen:
                gone.update(range(k, k + 20))
            seen.add(key)
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[(d, text)] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("group", [substrings.GROUP, 3])  # 3: every prefix is split, hot windows are dealt out
def test_substring_dedup(spark, tables, group):
    plain, odd, empty = tables
    for df, rows in ((plain, corpus()), (odd, [r for r in odd_rows() if r[0] != 7 or "same row" in r[1]])):
        df = df if df is plain else df.where("doc_id is null or doc_id <> 7 or text like '%same row%'")
        expected = brute_substrings(rows)
        want = Counter((r[0], *expected[(substrings.LAST if r[0] is None else r[0], r[1] or "")]) for r in rows)
        assert Counter(map(tuple, substrings.remove_repeats(df, group=group).collect())) == want
    assert substrings.remove_repeats(empty).count() == 0


def test_every_repeated_window_shows_a_repeated_sync_point():
    from tapeworks.llm.text import WordHasher
    hasher = WordHasher()
    shared = " ".join(f"k{i}" for i in range(20)).encode()
    a, b = b"left one " + shared + b" right", b"quite another left side here " + shared
    points = [dict(zip(g.tolist(), at.tolist())) for at, g in (substrings.sync_points(hasher(x)) for x in (a, b))]
    assert set(points[0]) & set(points[1])


def brute_jaccard(rows, threshold=0.8):
    docs = sorted({(jaccard.LAST if r[0] is None else r[0], r[1]) for r in rows if tokens(r[1])})
    sets = []
    for _, text in docs:
        w = tokens(text)
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)})
    links, group = Counter(), {x: x for x in docs}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    times = Counter((jaccard.LAST if r[0] is None else r[0], r[1]) for r in rows)
    for i, x in enumerate(docs):
        links[x] += times[x] - 1
        for j in range(i):
            if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[x] += times[docs[j]]
                links[docs[j]] += times[x]
                a, b = find(x), find(docs[j])
                group[max(a, b)] = min(a, b)
    return links, {x: find(x)[0] for x in docs}


def test_jaccard_join(spark, tables):
    plain, odd, empty = tables
    for df, rows in ((plain, corpus()), (odd, odd_rows())):
        links, groups = brute_jaccard(rows)
        null = lambda d: None if d == jaccard.LAST else d
        want = Counter()
        for r in rows:
            key = (jaccard.LAST if r[0] is None else r[0], r[1])
            want[(r[0], links[key], null(groups[key])) if key in groups else (r[0], 0, r[0])] += 1
        got = jaccard.jaccard_join(df).collect()
        assert Counter((r.doc_id, r.n_links, r.group_id) for r in got) == want
    assert jaccard.jaccard_join(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.dtypes == odd.dtypes
    texts = defaultdict(int)
    for r in kept.collect():
        texts[r.text] += 1
    assert texts["one"] == 1 and texts["the same row twice over " * 8] == 1 and texts[None] == 2
    groups = brute_jaccard(corpus())[1]
    assert sorted(r.doc_id for r in jaccard.keep_one(plain).collect()) == sorted(set(groups.values()))


def test_one_of_repeated_rows_stays_with_a_map_column(spark):
    text = "five words and some more of them to compare"
    rows = [(1, text, {"a": 2}), (1, text, {"a": 1}), (2, "quite another text that stands alone here", {}), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>")
    got = sorted((r.doc_id, r.tags) for r in jaccard.keep_one(df).collect())
    assert got == [(1, {"a": 1}), (2, {}), (3, None)]


def test_jaccard_blocks_and_buckets(spark, monkeypatch):
    rows = corpus(3, 12) + [(100 + i, " ".join(f"q{k}" if k != i else f"z{i}" for k in range(80)), "en", "s", 1) for i in range(40)]
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "BUCKET_ROWS", 6)
    links, groups = brute_jaccard(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.n_links, r.group_id) for r in jaccard.jaccard_join(df).collect()}
    assert got == {d: (links[(d, t)], g) for (d, t), g in groups.items()}


def test_bands_reach_their_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.9999, 192)
    assert bands * rows <= 192 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.1, 0.9999, 8)
