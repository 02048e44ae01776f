"""Packing: every id in one piece, sequences without gaps, next to no padding, steps alike."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from cartwheel.llm import packing
from cartwheel.llm.common import importable

SCHEMA = "doc_id long, text string, start int, raw string"


def corpus():
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("aeionrst é") for _ in range(rng.randint(1, 9))) for _ in range(n))
    texts = [None, "", " ", "One.", "<|endoftext|> don't\r\n\n  x ", "日本語 🙂", text(5000), text(1200), "ab" * 20_000]
    texts += [text(int(rng.lognormvariate(4.5, 1))) for _ in range(150)] + ["the same"] * 90
    return [(i if i != 7 else None, t, 0, "x") for i, t in enumerate(texts)] + [(3, "One.", 0, "x"), (3, "Other.", 0, "x")]


def ids_of(tok, text):
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("parts", [1, 6])
def test_pieces_are_the_documents(spark, parts):
    from tokenizers import Tokenizer
    importable(spark)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus()
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    # documents: pieces by start join to the ids (rows of one id are told apart by their texts' ids)
    want = defaultdict(Counter)
    for doc, text, *_ in rows:
        want[doc][tuple(ids_of(tok, text))] += 1
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.length, p.doc_tokens, tuple(np.frombuffer(p.ids, "<u4").tolist())))
    assert set(by_doc) == set(want)
    for doc, own in by_doc.items():
        if sum(want[doc].values()) == 1:
            own.sort()
            (ids,) = want[doc]
            assert sum((x[3] for x in own), ()) == ids and {x[2] for x in own} == {len(ids)}
            assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
        else:
            assert Counter(x[3] for x in own) == want[doc]
    # sequences: gapless, at most the context, padded once at most
    by_seq = defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append((p.offset, p.length, p.context, p.step))
    assert sorted(by_seq) == list(range(len(by_seq)))
    short = 0
    for own in by_seq.values():
        own.sort()
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
        assert len({x[2:] for x in own}) == 1
        short += sum(x[1] for x in own) != own[0][2]
    assert short <= 1
    digest = {(r.doc_id, r.start, r.sequence_id, r.offset): r.ids_crc32 for r in packing.digests(packing.pack(spark.createDataFrame(rows, SCHEMA))).collect()}
    own = {(p.doc_id, p.start, p.sequence_id, p.offset): zlib.crc32(p.ids) for p in packing.pack(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert digest == own


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_remainder_once(seed):
    rng = random.Random(seed)
    counts = [0] * 2048
    for _ in range(rng.choice([3, 400, 6000])):
        counts[min(2047, max(1, int(rng.lognormvariate(rng.choice([3, 6]), 1.2))))] += 1
    if seed % 2:
        counts[rng.randint(1, 2047)] += 4000  # one length holds most
    plan, seqs, cut = packing.Plan(counts, 5, step_tokens=1 << 15), defaultdict(list), 0
    for length, n in enumerate(counts):
        for k in range(n):
            places = plan.places(length, k)
            assert sum(m for *_, m in places) == length
            cut += len(places) > 1
            for s, o, m in places:
                seqs[s].append((o, m))
    assert sorted(seqs) == list(range(5, plan.total))
    used = {s: sum(m for _, m in x) for s, x in seqs.items()}
    for own in seqs.values():
        own.sort()
        assert all(own[k][0] == sum(m for _, m in own[:k]) for k in range(len(own)))
    assert sum(used[s] != plan.tier_and_step(s)[0] for s in used) <= 1
    steps = defaultdict(Counter)
    for s in range(plan.total):
        context, step = plan.tier_and_step(s)
        steps[step][context] += 1
    assert sorted(steps) == list(range(plan.steps)) or plan.total < plan.steps * 2
    for context in packing.CONTEXTS:  # each step has its share of each tier
        shares = [steps[k][context] for k in range(plan.steps)]
        assert max(shares) - min(shares) <= 1


def test_nothing(spark):
    importable(spark)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, encode, rng = Tokenizer.from_file(path), packing._encoder(path), random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "1", "23", "…", "ß", "日", "🙂", "\x00", "́", "\xa0", " "]) for _ in range(40))
        assert list(encode(text)) == tok.encode(text, add_special_tokens=False).ids
