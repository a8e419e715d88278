"""Mixing, packing, language model, importance resampling, license scan, vectors
and the pipeline against brute force, and on odd rows."""

import heapq
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline
from tapeworks.llm import importance, licenses, mixing, packing, suffix_lm, vectors
from tests.llm.fixtures import SCHEMA, corpus, frames, odd_rows, tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tables(spark):
    return frames(spark)


# --- mixing -------------------------------------------------------------------

def brute_targets(sizes: dict) -> dict:
    """Share by weight, cut at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, free, rest = {}, set(order), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
    return target


def test_mix_targets_and_quotas(spark, tables):
    for df, rows in ((tables[0], corpus()), (tables[1], odd_rows())):
        got = mixing.mix(df).collect()
        assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(tokens(r[1]))) for r in rows)
        sizes = Counter()
        for r in rows:
            sizes[r[3]] += len(tokens(r[1]))
        targets, taken = brute_targets(sizes), Counter()
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source] += r.taken
        assert all(abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK_WORDS for s in targets)
        again = mixing.mix(df.repartition(3)).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(tables[2]).count() == 0


def test_apportion_is_sainte_lague(spark):
    rng = random.Random(5)
    for trial in range(6):
        parties = [(trial, f"p{k:02}", float(rng.choice([0, 1, 5, 5, 40, 1000])), rng.choice([1, 3, 10**6])) for k in range(rng.randint(1, 9))]
        house = rng.choice([0, 1, 3, 17, 400])
        df = spark.createDataFrame([(*p, house) for p in parties], "g int, key string, votes double, most long, house long")
        got = {r.key: r.seats for r in mixing.apportion(df, ["g"], "key").collect()}
        if all(p[3] > house for p in parties) or house <= 3:
            seats = dict.fromkeys(got, 0)
            queue = [(-p[2], p[1]) for p in parties if p[2] > 0]
            heapq.heapify(queue)
            votes, most = {p[1]: p[2] for p in parties}, {p[1]: p[3] for p in parties}
            for _ in range(house):
                while queue and seats[queue[0][1]] >= most[queue[0][1]]:
                    heapq.heappop(queue)
                if not queue:
                    break
                _, key = heapq.heappop(queue)
                seats[key] += 1
                heapq.heappush(queue, (-votes[key] / (2 * seats[key] + 1), key))
            if all(most[k] > house for k in most):
                assert got == seats
        assert sum(got.values()) <= house and all(got[p[1]] <= p[3] for p in parties)


def test_shards_share_a_hot_source(spark):
    rows = [(i, "word " * (1 + i % 40), "en", "hot" if i % 3 else f"s{i % 9}", 0) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), docs_per_shard=50).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 16 * 13 for s in target)


def test_written_mix_has_the_planned_words(spark, tables):
    for df in tables[:2]:
        plan, written = Counter(), Counter()
        for r in mixing.mix(df).collect():
            plan[r.doc_id] += r.taken
        out = mixing.write_mix(df)
        assert out.dtypes == df.dtypes
        for r in out.collect():
            written[r.doc_id] += len(tokens(r.text))
        assert +written == +plan
    assert mixing.write_mix(tables[2]).count() == 0


def test_pipeline_mix_keeps_texts_whole(spark, tables):
    docs, texts = tables[0], {r[0]: r[1] for r in corpus()}
    cut = [r for r in mixing.write_mix(docs).collect() if r.text != texts[r.doc_id]]
    assert cut
    written = Counter()
    for r in corpus_pipeline.mixture(spark, docs, "").collect():
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
        written[r.doc_id] += 1
    for r in mixing.mix(docs).collect():
        assert written[r.doc_id] == (2 * r.taken + r.size) // (2 * r.size) <= mixing.MAX_REPEATS


# --- packing ------------------------------------------------------------------

def token_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_packing(spark, tables):
    for df, rows in ((tables[0], corpus()), (tables[1], odd_rows())):
        got = packing.pack(df, VOCABULARY).collect()
        want = Counter()
        for r, ids in zip(rows, token_ids([r[1] for r in rows])):
            for k, start in enumerate(range(0, len(ids), 4096)):
                own = ids[start:start + 4096]
                want[(r[0], k, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= 4096
        assert len(sequences) <= math.ceil(sum(r.length for r in got) / 4096) + 1
    assert packing.pack(tables[2], VOCABULARY).count() == 0


def test_sum_of_squares_rule():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 21, 300)
    sequence, offset = packing.pack_lengths(sizes, 20)
    gaps = {}  # the same walk, by the definition
    for s, where, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist()):
        counts = Counter(g for g in gaps.values() if g)

        def squares(gap):
            c = Counter(counts)
            if gap != 20 or True:
                c[gap] -= 1 if gap in counts else 0
            if gap - s:
                c[gap - s] += 1
            return sum(v * v for v in c.values())

        options = {g: squares(g) for g in counts if g >= s}
        fresh = Counter(counts)
        if s < 20:
            fresh[20 - s] += 1
        best = min([*options.values(), sum(v * v for v in fresh.values())])
        chosen = gaps.get(where, 20)
        assert at == 20 - chosen and (options[chosen] if where in gaps else sum(v * v for v in fresh.values())) == best
        gaps[where] = chosen - s


def test_encoder_equals_the_tokenizer():
    rng = random.Random(1)
    parts = ["a", "Bc", "'s", "'S", "0", "9", "٣", "é", "é", "́", ",", ".", "!?", "<|endoftext|>", "<|ENDOFTEXT|>",
             "<", "|", ">", " ", "\x1c", "\x85", "\xa0", "ß", "ΑΣ", "ﬁ", "漢", "\U0001f600", "İ", "K", "-",
             "don't", "\x00", "½", "Ⅷ", "ǅ", "\n", "\t"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    encoder = packing.WordEncoder(VOCABULARY)
    got = [ids.tolist() for k in range(0, len(texts), 500) for ids in encoder.encode([x.encode() for x in texts[k:k + 500]])]
    assert got == [x[:-1] for x in token_ids(texts)]
    assert [x.tolist() for x in encoder.encode([None, b"", b"  ", b"ok"])] == [x[:-1] for x in token_ids([None, "", "  ", "ok"])]


# --- language model -------------------------------------------------------------

def test_language_model(spark, tables):
    for df, rows in ((tables[0], corpus()), (tables[1], odd_rows())):
        held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        texts = [(r[0], [*(r[1] or "").encode().lower().split(), "end"]) for r in rows]
        c = Counter(t for i, w in texts for t in w if not held(i))
        n, v = sum(c.values()), len(c)
        want = sorted((i is None, i or 0, held(i), len(w), sum(c[t] > 0 for t in w), n,
                       sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)) for i, w in texts)
        got = suffix_lm.score_documents(df).collect()
        have = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
        assert [x[:-1] for x in have] == [x[:-1] for x in want]
        assert [x[-1] for x in have] == pytest.approx([x[-1] for x in want])
        assert all(r.score < 0 for r in got)
    assert suffix_lm.score_documents(tables[2]).count() == 0


def chain_rows(docs: int = 200) -> list[tuple]:
    rng = random.Random(4)
    follow = {"the": "cat", "cat": "sat", "sat": "down", "down": "the", "a": "cat", "dog": "ran", "ran": "a"}
    rows = []
    for i in range(docs):
        w = [rng.choice(["the", "a"])]
        for _ in range(60):
            after = follow.get(w[-1], "dog")
            if w[-3:] == ["a", "cat", "sat"]:  # three words decide
                after = "ran"
            w.append(after if rng.random() < 0.9 else rng.choice([*follow, f"rare{rng.randint(0, 400)}"]))
        rows.append((i, " ".join(w)))
    return rows + [(docs, rows[3][1]), (docs, rows[3][1]), (docs + 1, None), (docs + 2, "")]


class BruteTree:
    """The tree of the method, by dictionaries over all contexts."""

    def __init__(self, texts: list[list[str]], min_count: int, min_gain: float, d: float, depth: int = 3):
        self.follow, self.d, self.depth = {}, d, depth
        for w in texts:
            w = ["<s>", *w, "</s>"]
            for i in range(1, len(w)):
                for k in range(0, min(depth, i) + 1):
                    self.follow.setdefault(tuple(w[i - k:i]), Counter())[w[i]] += 1
        self.n = {c: sum(f.values()) for c, f in self.follow.items()}
        self.size = self.n[()] + 0.1 * (len(self.follow[()]) + 1)
        self.listed = {c: {x: m for x, m in f.items() if m >= min_count} for c, f in self.follow.items() if c}
        self.kept = set()
        for c, f in self.listed.items():
            if f:
                q = {x: self.follow[c[1:]][x] / self.n[c[1:]] for x in f}
                gain = sum(m * math.log(m / self.n[c] / q[x]) for x, m in f.items())
                lost = self.n[c] - sum(f.values())
                if lost:
                    gain += lost * math.log(lost / self.n[c] / max(1 - sum(q.values()), 1e-12))
                if gain >= min_gain + len(f):
                    self.kept |= {c[k:] for k in range(len(c))}

    def p(self, c: tuple, x: str) -> float:
        if not c:
            return (self.follow[()][x] + 0.1) / self.size
        f = self.listed[c]
        r = self.n[c] - sum(m - self.d for m in f.values())
        return (max(f.get(x, 0) - self.d, 0) + r * self.p(c[1:], x)) / self.n[c]

    def score(self, words: list[str]) -> float:
        w, total = ["<s>", *words, "</s>"], 0.0
        for i in range(1, len(w)):
            c = next(c for k in range(min(self.depth, i), -1, -1) if (c := tuple(w[i - k:i])) in self.kept or not c)
            total += math.log10(self.p(c, w[i]))
        return total


def test_scores_equal_a_brute_force_tree(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    rows = chain_rows()
    tree = BruteTree([(t or "").split() for i, t in rows if not held(i)], suffix_lm.MIN_COUNT, suffix_lm.MIN_GAIN, suffix_lm.DISCOUNT)
    assert {len(c) for c in tree.kept} == {1, 2, 3} and ("<s>",) in tree.kept
    got = suffix_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = sorted((i, tree.score((t or "").split())) for i, t in rows)
    have = sorted((r.doc_id, r.score) for r in got)
    assert [x[0] for x in have] == [x[0] for x in want]
    assert [x[1] for x in have] == pytest.approx([x[1] for x in want])
    tested = [r for r in got if r.held_out]
    assert tested and sum(r.score for r in tested) > 0.6 * sum(r.base_score for r in tested)
    for c in tree.kept:  # probabilities sum to 1: every seen token and one for all others
        seen = tree.follow[()]
        assert sum(tree.p(c, x) for x in seen) + tree.p(c, "never seen") == pytest.approx(1)


def test_tables_of_the_tree_equal_brute_force(spark, monkeypatch):
    rows = chain_rows(90)
    monkeypatch.setattr(suffix_lm, "COMMON_SHARE", 0.2)  # nearly all words go through the join
    built = []
    plain = suffix_lm.SuffixTree.__init__
    monkeypatch.setattr(suffix_lm.SuffixTree, "__init__", lambda self, *a: (plain(self, *a), built.append(self))[0])
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    texts = [(t or "").split() for i, t in rows if not held(i)]
    got = suffix_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), min_gain=2.0).collect()
    want = BruteTree(texts, suffix_lm.MIN_COUNT, 2.0, suffix_lm.DISCOUNT)
    (tree,) = built
    assert Counter(r["length"] for r in tree.contexts.collect()) == Counter(map(len, want.kept))
    assert sorted(r.p for r in tree.symbols.collect()) == pytest.approx(
        sorted(want.p(c, x) for c in want.kept for x in want.listed[c]))
    assert sorted(r.score for r in got) == pytest.approx(sorted(want.score((t or "").split()) for _, t in rows))


def test_rare_grams_are_sent_by_range_and_common_ones_looked_up(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(48)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(400)]
    monkeypatch.setattr(suffix_lm, "COMMON_SHARE", 0.0205)  # every word has less, but there are fewer than 1 / 0.0205
    sent, written = [], {}
    count, store = suffix_lm.gram_counts, suffix_lm.stored
    monkeypatch.setattr(suffix_lm, "gram_counts", lambda *a: (sent.append(count(*a)), sent[-1])[1])
    monkeypatch.setattr(suffix_lm, "stored", lambda df, name: (written.update({name: store(df, name)}), written[name])[1])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = suffix_lm.score_documents(frame).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tree = BruteTree([t.split() for i, t in rows if not held(i)], suffix_lm.MIN_COUNT, suffix_lm.MIN_GAIN, suffix_lm.DISCOUNT)
    assert sorted(r.score for r in got) == pytest.approx(sorted(tree.score(t.split()) for _, t in rows))
    for df, order in zip(sent, suffix_lm.GRAMS):
        parts = df.collect()
        assert len(parts) <= 2 * 2 ** suffix_lm.RANGE_BITS
        assert order != 3 or sum(len(r.grams) // 15 for r in parts) > 4 * len(parts)  # many grams in a row
    assert written["gains-by-key"].where("n is not null").count() == 0


def test_packed_counts_come_back():
    rng = np.random.default_rng(5)
    key = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    key = np.unique(np.concatenate([key, key + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)]))
    tag = rng.integers(0, 2**32, len(key), dtype=np.uint64)
    m = rng.integers(1, 2**31, len(key))
    for bits in (suffix_lm.range_bits(0), suffix_lm.range_bits(10**11)):
        parts = [r for batch in suffix_lm.packed_counts(key, tag, m, bits) for r in batch.to_pylist()]
        assert [r["range"] for r in parts] == sorted({int(k) >> (64 - bits) for k in key})
        back = [suffix_lm.unpacked_counts(r["range"], [r["grams"]], bits) for r in parts]
        for want, have in zip((key, tag, m), zip(*back)):
            assert (np.concatenate(have) == want).all()


def test_contexts_grow_with_the_corpus(spark, monkeypatch):
    counted = []
    plain = suffix_lm.SuffixTree.__init__
    monkeypatch.setattr(suffix_lm.SuffixTree, "__init__",
                        lambda self, *a: (plain(self, *a), counted.append(self.contexts.count()))[0])
    rng = random.Random(9)
    for docs in (40, 400):
        rows = [(i, " ".join(f"x{rng.randint(0, 9 * docs)} t{i // 20}a t{i // 20}b t{i // 20}c" for _ in range(3))) for i in range(docs)]
        suffix_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counted[1] > 3 * counted[0] > 0


# --- vectors of any magnitude -----------------------------------------------------

def test_vectors_of_extreme_magnitude(spark):
    rows = [(1, [1e200, 0.0, 0.0], "a"), (2, [1e200, 1e190, 0.0], "a"), (3, [1e-200, 0.0, 1e-210], "a"), (4, [1.0, 0.0, 0.0], "a"),
            (5, [0.0, 1e300, 1e300], "a"), (6, [0.0, 1e-320, 1e-320], "a"), (7, [1.7e308, 1.7e308, -1.7e308], "a"), (8, [1e200, 0.0, 0.0], "b"),
            (9, [float("inf"), 0.0, 0.0], "a"), (10, [0.0, 0.0, 0.0], "a"), (11, [-1e200, 0.0, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (0, 11)}


# --- importance resampling --------------------------------------------------------

def test_importance_weights(spark, tables):
    plain, odd, empty = tables
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 60, 2)] + [(None, 1, 0), (10**9, 1, None), (2, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for df, rows in ((plain, corpus()), (odd, odd_rows())):
        got = importance.resample(df, labels).collect()
        assert Counter((r.doc_id, r.n_words) for r in got) == Counter((r[0], len(tokens(r[1]))) for r in rows)
        keyed = sorted((r.key for r in got if r.key is not None), reverse=True)
        share = math.ceil(importance.KEEP_SHARE * len(keyed))
        assert all(r.kept == (r.key is not None and r.key >= keyed[share - 1]) for r in got)
    assert importance.resample(empty, labels).count() == 0
    none = importance.resample(plain, labels.where("quality = 7")).collect()
    assert all(r.log_ratio in (0.0, None) for r in none)


def test_importance_ratio_by_definition(spark):
    good, bad = "alpha beta gamma", "xx yy zz"
    rows = [(i, good if i % 2 else bad) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.log_ratio for r in importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    one = math.log((20 + 1) / (100 + importance.BUCKETS)) - math.log((20 + 1) / (200 + importance.BUCKETS))
    none = math.log(1 / (100 + importance.BUCKETS)) - math.log((20 + 1) / (200 + importance.BUCKETS))
    assert got[1] == pytest.approx(5 * one) and got[2] == pytest.approx(5 * none)


def test_kth_largest_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(importance, "SETTLED", 5)
    monkeypatch.setattr(importance, "CELLS", 4)
    rng = random.Random(3)
    values = [rng.gauss(0, 1) ** 5 for _ in range(400)] + [0.25] * 60 + [None] * 5
    df = spark.createDataFrame([(x,) for x in values], "key double")
    ranked = sorted((x for x in values if x is not None), reverse=True)
    for k in (1, 2, 57, 200, 459, 460):
        assert importance.kth_largest(df, k) == ranked[k - 1]
    assert importance.kth_largest(df, 461) is None and importance.kth_largest(df, 0) is None


# --- license scan -----------------------------------------------------------------

def test_license_scan(spark, tables):
    mit = licenses.TEMPLATES["MIT"]
    reflowed = " ".join(mit.split()).replace(", ", ",\n * ")
    changed = " ".join(mit.split()).replace("restriction", "any limits at all").replace("free of charge", "for free")
    rows = [(1, "Some prose before. " + reflowed + " And after it."), (2, changed), (3, "Nothing to see here."), (4, None), (5, ""),
            (6, "Released under the MIT License. Released under the MIT License.\nMore text"), (None, "Licensed under CC BY-NC 4.0."),
            (8, " ".join(mit.split()[:20]))]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {1, 2, 6, None}
    (r,) = by_doc[1]
    assert r.license == "MIT" and r.coverage == 1.0 and r.start_word == 3
    span = rows[0][1][r.start_char:r.end_char]
    assert span.startswith("Permission") and span.endswith("Software")
    (r,) = by_doc[2]
    assert r.license == "MIT" and 0.85 < r.coverage < 1
    assert [(r.license, r.start_word) for r in by_doc[6]] == [("MIT (notice)", 0), ("MIT (notice)", 5)]
    assert by_doc[None][0].license == "CC-BY-NC-4.0 (notice)"
    assert licenses.scan_licenses(tables[1]).count() == 0 and licenses.scan_licenses(tables[2]).count() == 0


def test_every_template_is_found_in_a_text(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, template in licenses.TEMPLATES.items():
        found = {x[0]: x for x in scanner.scan(("Head, a b c.\n" + template + "\nTail d e").encode(), 0.9)}
        assert name in found and found[name][1] == found[name][2]
    with pytest.raises(ValueError):
        licenses.Scanner({"short": "two words"})


def test_one_license_for_each_notice():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    names = lambda text: [x[0] for x in scanner.scan(text.encode())]
    gnu = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    bsd = " ".join(licenses.TEMPLATES["BSD-3-Clause"].split())
    assert names(bsd) == ["BSD-3-Clause"] and names(bsd[:bsd.index("3. Neither")]) == ["BSD-2-Clause"]
    assert names(gnu.format(2)) == ["GPL-2.0"] and names(gnu.format(3)) == ["GPL-3.0"]
    assert names(gnu.format(3).replace("General", "Affero General")) == ["AGPL-3.0"]
    assert names("Licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0 (notice)"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0 (notice)"]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0 (notice)"]
    assert names("Licensed under the GNU Lesser General Public License, version 2.1.") == ["LGPL-2.1 (notice)"]
    assert names("Distributed under the BSD 2-Clause License.") == ["BSD-2-Clause (notice)"]
    assert names("Licensed under CC BY 4.0. Licensed under CC BY 3.0.") == ["CC-BY-4.0 (notice)", "CC-BY-3.0 (notice)"]
    assert names("// SPDX-License-Identifier: AGPL-3.0-or-later") == ["AGPL-3.0 (SPDX)"]


# --- vectors ----------------------------------------------------------------------

def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows, label = [], ["1", "2"]
    for k in range(12):
        center = rng.standard_normal(16)
        for _ in range(8):
            rows.append((len(rows), (center + 0.04 * rng.standard_normal(16)).tolist(), k % 2))
    rows += [(200 + k, rows[5][1], 0) for k in range(5)]  # copies
    rows += [(300, [2 * x for x in rows[0][1]], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0),
             (304, [None] * 16, 0), (305, rows[0][1], None), (306, [float("inf"), *[1.0] * 15], 0), (307, [], 1),
             (308, rows[0][1][:8], 0), (None, rows[0][1], 0), (5, rows[5][1], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, cls int, cell int")
    good = [k for k, (_, v, lab) in enumerate(rows) if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, group = Counter(), {k: k for k in range(len(rows))}

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    rank = lambda k: vectors.LAST if rows[k][0] is None else rows[k][0]
    for i in good:
        for j in good:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i < j and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= 0.98 * np.linalg.norm(a) * np.linalg.norm(b) - 1e-12:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                if x != y:
                    group[max((rank(x), x), (rank(y), y))[1]] = min((rank(x), x), (rank(y), y))[1]
    want = Counter((rows[k][0], links[k], rows[find(k)][0]) for k in range(len(rows)))
    for block in (2048, 9):
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = vectors.near_vectors(df).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(links.values()) > 200
    assert vectors.near_vectors(df.where("vec_id = -1")).count() == 0


def test_calibrated_count_keeps_the_recall():
    least = vectors.calibrated()
    p = math.erf(vectors.WIDTH / math.sqrt(2))
    reach = sum(math.comb(32, k) * p**k * (1 - p) ** (32 - k) for k in range(least, 33))
    assert reach >= vectors.RECALL and least > 20


# --- pipeline and registration -------------------------------------------------------

def test_pipeline_stages(spark, tables):
    for docs in tables:
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs.count()
            out = stage(spark, docs, "")
            if k < 4:
                assert out.dtypes == docs.dtypes, name
                assert k == 3 or out.count() <= before
                docs = corpus_pipeline.stored(out, "stage")
            else:
                packed = Counter(r.doc_id for r in out.where("piece = 0").collect())
                assert packed == Counter(r.doc_id for r in docs.collect())


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and all(r.offset + r.length <= 4096 for r in rows)


def test_queries_are_registered(spark):
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1


def test_context_follows_from_key_and_suffix():
    context, suffix = (np.random.default_rng(i).integers(0, 2**64, 1000, dtype=np.uint64) for i in (1, 2))
    assert (suffix_lm.contexts_of(suffix_lm.gram_keys(context, suffix), suffix) == context).all()
