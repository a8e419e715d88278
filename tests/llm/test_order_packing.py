"""Order-preserving packing against plain dynamic programming, token ids of the
tokenizer itself, and odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tapeworks.llm import order_packing as O
from tests.llm.fixtures import SCHEMA, corpus, frames, odd_rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def brute_cost(place, penalty, capacity):
    """Least padding plus penalties, trying every pair of cuts."""
    cost = [0.0] + [float("inf")] * (len(place) - 1)
    for j in range(1, len(place)):
        for i in range(j):
            if place[j] - place[i] <= capacity:
                cost[j] = min(cost[j], cost[i] + padding(place[j] - place[i], capacity) + penalty[j] + O.PER_SEQUENCE)
    return cost


def test_plan_is_least():
    rng = random.Random(9)
    for _ in range(150):
        capacity = rng.choice([8, 16, 64])
        gaps = [rng.randint(1, capacity) for _ in range(rng.randint(1, 60))]
        place = np.concatenate([[0], np.cumsum(gaps)])
        penalty = np.array([0.0] + [rng.choice([0, 0, O.SENTENCE_CUT, O.TRUNCATION]) for _ in gaps])
        cost, before = O.plan(place, penalty, capacity)
        assert cost == brute_cost(place.tolist(), penalty.tolist(), capacity)
        for j in range(1, len(place)):
            assert cost[j] == cost[before[j]] + padding(place[j] - place[before[j]], capacity) + penalty[j] + O.PER_SEQUENCE
        cuts = O.chosen_cuts(place, penalty, capacity, last=True)
        assert cuts[0] == 0 and cuts[-1] == place[-1] and np.diff(cuts).max() <= capacity


def test_cuts_stand_behind_documents_and_sentences():
    ends = np.zeros(10, bool)
    ends[7] = True
    ids = np.array([1, 7, 1, 1, 2] + [3] * 300 + [2])
    place, penalty = O.candidate_cuts(ids, np.array([5, 306]), ends, stride=128)
    assert list(zip(place.tolist(), penalty.tolist())) == [(0, 0), (2, O.SENTENCE_CUT), (5, 0), (133, O.TRUNCATION), (261, O.TRUNCATION), (306, 0)]
    encoder = O.kept_encoder(VOCABULARY)
    found = O.sentence_ends(encoder)
    ids = encoder.encode([b"One. Two! three? four, 'five' <|six"])[0]
    assert [encoder.tokenizer.id_to_token(int(k)) for k in ids[found[ids]]] == [".</w>", "!</w>", "?</w>"]


def token_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


@pytest.mark.parametrize("capacity, block", [(O.SEQUENCE, O.BLOCK), (256, 700)])  # many blocks, sequences over them
def test_packing_in_order(spark, capacity, block):
    plain, odd, empty = frames(spark)
    for df, rows in ((plain, corpus()), (odd, odd_rows())):
        got = O.pack_in_order(df.coalesce(2), VOCABULARY, capacity=capacity, block=block).collect()
        documents, pieces = Counter(), defaultdict(list)
        for r, ids in zip(rows, token_ids([r[1] for r in rows])):
            documents[(r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        sequences, cut = defaultdict(list), 0
        texts = defaultdict(list)
        for r, ids in zip(rows, token_ids([r[1] for r in rows])):
            texts[(r[0], len(ids))].append(ids)
        for p in got:
            assert any(zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32
                       for ids in texts[(p.doc_id, p.doc_tokens)])
            sequences[p.sequence_id].append((p.offset, p.length))
            pieces[(p.doc_id, p.doc_tokens)].append((p.start, p.length))
        for key, own in pieces.items():  # repeated rows have equal pieces or not: every id as often as there are rows
            cover = Counter(k for start, length in own for k in range(start, start + length))
            assert cover == Counter({k: len(texts[key]) for k in range(key[1])})
        assert {k: len(v) for k, v in texts.items()}.keys() == pieces.keys()
        waste = 0
        for own in sequences.values():
            own.sort()
            assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:]))
            total = sum(x[1] for x in own)
            assert total <= capacity
            waste += padding(total, capacity)
        total = sum(map(len, token_ids([r[1] for r in rows])))
        # Cuts inside sentences cost a quarter of a short sequence, so these keep more padding.
        assert waste <= (0.01 if capacity == O.SEQUENCE else 0.15) * total + 2 * capacity
    assert O.pack_in_order(empty, VOCABULARY).count() == 0


def test_order_is_kept(spark):
    df = spark.createDataFrame(corpus(), SCHEMA).coalesce(1)
    order = [r.doc_id for r in df.collect()]
    got = sorted(O.pack_in_order(df, VOCABULARY, block=3000).collect(), key=lambda p: (p.sequence_id, p.offset))
    assert list(dict.fromkeys(p.doc_id for p in got)) == order
    starts = Counter()
    for p in got:
        assert p.start == starts[p.doc_id]
        starts[p.doc_id] += p.length


def test_encoder_finds_parts_again():
    """Slots overflow, are dealt out anew, and parts are forgotten."""
    encoder = O.WordEncoder(VOCABULARY)
    encoder.deal(4)
    texts = [f"word{k}. other{k * 7}, {k} end{k}".encode() for k in range(3000)]
    first = encoder.encode(texts)
    again = encoder.encode(texts)
    encoder.forget()
    fresh = encoder.encode(texts[:50])
    for a, b in zip(first, again):
        assert a.tolist() == b.tolist()
    want = [x[:-1] for x in token_ids([t.decode() for t in texts[:50]])]
    assert [x.tolist() for x in fresh] == [x.tolist() for x in first[:50]] == want
