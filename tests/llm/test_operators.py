"""The training-data operators against brute force, on a table with every odd case."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import (embedding_dedup, exact_dedup, lm_score, minhash_dedup, mixing, quality, queries,
                           sentencepiece_codec, suffix_dedup, token_output, toxicity)
from cartwheel.llm.common import importable, words_of
from cartwheel.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, own int, __n int"


def corpus():
    """Nulls, empty and blank texts, odd spaces, ties, repeated rows, near copies, shared passages, a long text."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "the", "or", "ti", "é", "ß", "on"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    base = text(120).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in (3, 60, 110)]
    texts = [None, "", "   ", " lead", "trail ", "two  spaces   here", "tab\tand\nline", "▁mark", "One", "one", "ONE",
             "x", "a b", text(80), text(80), passage, "Start " + passage + " end", passage.upper(), text(40) + " " + passage,
             "ab" * 400, "ab" * 150, "z" * 99, "z" * 100, "z" * 101, "\x00" * 150 + "q", *near, " ".join(base), text(9000),
             "<|endoftext|> it's 12 don't", "É" * 120, "naïve café", "日本語 テキスト"]
    rows = [(i, t, "en", ["a", "b", None, "c"][i % 4], None, "clash", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[13], rows[13], (900, texts[13], None, "a", None, None, None, None), (None, texts[14], None, None, None, None, None, None)]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    importable(spark)
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_words_split_like_bytes():
    import pyarrow as pa
    texts = [" a\tB\x0bc ", "", None, "É x", "\x1c q"]
    offsets, codes, words = words_of(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert [words[int(c)].as_py().encode() for c in codes[offsets[i]:offsets[i + 1]]] == (t or "").encode().lower().split()


def test_token_blocks_round_trip(spark, docs, nothing, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    token_output.write_token_files(docs, str(tmp_path / "t"), block_tokens=500)
    out = [tuple(r) for r in token_output.read_token_files(spark, str(tmp_path / "t")).collect()]
    want = Counter((r[0], tuple(tok.encode(r[1] or "", add_special_tokens=False).ids + [1])) for r in ROWS)
    assert Counter((d, tuple(ids)) for d, _, ids in out) == want
    at = 0
    for d, start, ids in sorted(out, key=lambda r: r[1]):
        assert start == at
        at += len(ids)
    order = [-1 if d is None else d for d, _, _ in sorted(out, key=lambda r: r[1])]
    assert order == sorted(order)
    token_output.write_token_files(nothing, str(tmp_path / "e"))
    assert token_output.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_token_digests_stay_with_the_decoder(spark, docs, tmp_path, capsys):
    """One Python worker a task: ids are hashed where they are decoded."""
    path = str(tmp_path / "d")
    token_output.write_token_files(docs, path, block_tokens=500)
    out = token_output.read_digests(spark, path)
    cols = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert got(out, *cols) == got(token_output.digests(token_output.read_token_files(spark, path)), *cols)
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_words_reach_the_model_once_and_many_in_a_call():
    """Cores are told apart by the tokens that end a word; case and marks make no new call."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, inner):
            self.inner, self.calls, self.words = inner, 0, 0

        def encode_batch_fast(self, texts, **options):
            self.calls, self.words = self.calls + 1, self.words + sum(len(t.split()) for t in texts)
            return self.inner.encode_batch_fast(texts, **options)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    table = token_output.WordTable(None)
    assert table.plain
    rng = random.Random(4)
    cores = sorted({"".join(rng.choices("abdeinorstéßñ", k=rng.randint(2, 9))) for _ in range(4000)})
    words = [*cores, *(c.capitalize() + "," for c in cores if c[0] != "ß"), *(c.upper() + "***" for c in cores if "ß" not in c), "", "*", "Don't", "a.b",
             "x<|endoftext|>y", "e\u0301t", "12", "日本", "İ", "ΟΔΟΣ", "'s", "--", "\u00ad"]
    table.model = model = Counted(table.model)
    for _ in range(2):
        flat, offs = table.lookup(pa.array(words))
        for k, w in enumerate(words):
            assert flat[offs[k]:offs[k + 1]].tolist() == tok.encode(w, add_special_tokens=False).ids, w
    assert model.words <= len(cores) and model.calls <= 1


def test_flat_table_is_bounded():
    import pyarrow as pa
    from cartwheel.llm.chunks import FlatTable

    calls = []

    def encode(chunks):
        calls.extend(chunks.to_pylist())
        lens = np.array([len(c) for c in chunks.to_pylist()], np.int64)
        return np.array([ord(x) for c in chunks.to_pylist() for x in c], np.int32), lens

    def check(chunks):
        flat, offs = table.lookup(pa.array(chunks, pa.string()))
        assert ["".join(map(chr, flat[a:b])) for a, b in zip(offs[:-1], offs[1:])] == chunks

    table = FlatTable(encode, max_entries=100, max_bytes=5_000)
    for k in range(40):
        check(["", "often", *(f"w{k}-{j}" for j in range(30))])
        assert len(table.names) <= 100 and table.names.nbytes <= 5_000
    check([f"v{j}" for j in range(500)])  # more at once than are kept
    assert calls.count("often") == 1 and "" not in calls and len(table.names) <= 100
    check(["x" * 9_000, "y"])
    assert table.names.nbytes <= 5_000
    check([])
    check(["y", ""])


def test_blocks_end_where_they_are_full(spark):
    """However much text a task takes at once, a block holds one document more than it may at most."""
    docs = spark.createDataFrame([(i, "word " * 90) for i in range(200)], "doc_id long, text string").coalesce(1)
    blocks = token_output.tokenize(docs, block_tokens=1_000).select("part", "seq", "lens").collect()
    assert all(sum(r.lens) <= 2_000 for r in blocks) and sum(map(len, (r.lens for r in blocks))) == 200
    assert len({(r.part, r.seq) for r in blocks}) == len(blocks)


def test_rans_segments_and_damage():
    ids = np.random.default_rng(1).zipf(1.3, 700_001) % 5000
    freq = token_output.scaled_frequencies(np.bincount(ids, minlength=5000))
    assert freq.sum() == 1 << token_output.SCALE
    block, slots = token_output.encode_block(ids, freq), np.repeat(np.arange(len(freq)), freq)
    assert (token_output.decode_block(block, freq, slots) == ids).all()
    broken = bytearray(block)
    broken[len(broken) // 2] ^= 255
    with pytest.raises((ValueError, IndexError)):
        token_output.decode_block(bytes(broken), freq, slots)


def test_sentencepiece_equals_library(docs, nothing):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(docs)).collect()
    want = Counter()
    for r in ROWS:
        ids = sp.encode(r[1] or "", add_eos=True)
        want[r[0], tuple(ids), sp.decode(ids)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in out) == want
    assert sentencepiece_codec.digests(sentencepiece_codec.decode(sentencepiece_codec.encode(nothing))).count() == 0


def test_exact_classes_and_clashing_hashes(spark, docs, nothing, monkeypatch):
    fold = str.maketrans(exact_dedup.UPPER, exact_dedup.LOWER)
    norm = [(r[0], (r[1] or "").translate(fold)) for r in ROWS]
    size, keep = Counter(t for _, t in norm), {}
    for d, t in norm:
        keep[t] = max(keep.get(t, -1), -1 if d is None else d)
    want = sorted({(d, keep[t], size[t], d == keep[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in norm}, key=repr)
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(exact_dedup.classes(docs), *cols) == want
    assert exact_dedup.classes(nothing).count() == 0
    assert exact_dedup.deduplicate(docs).count() == len(size)
    assert exact_dedup.deduplicate(docs).columns == docs.columns
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))  # every chunk hash clashes
    assert got(exact_dedup.classes(docs), *cols) == want


def test_suffix_dedup_equals_brute_force(docs, nothing):
    order = sorted(range(len(ROWS)), key=lambda i: -1 if ROWS[i][0] is None else ROWS[i][0])
    seen, want = set(), set()
    for i in order:
        d, data = ROWS[i][0], (ROWS[i][1] or "").encode()
        if any(x[0] == d for x in want):
            continue  # a repeated row is the same document
        mark = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p:p + 100]
            if w in seen:
                mark[p:p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, m in zip(data, mark) if not m)
        spans = sum(1 for k, m in enumerate(mark) if m and (not k or not mark[k - 1]))
        want.add((d, len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    out = [tuple(r) for r in suffix_dedup.digests(suffix_dedup.deduplicate(docs)).collect()]
    assert set(out) == want and len(out) == len(ROWS)
    assert suffix_dedup.deduplicate(nothing).count() == 0


def test_loser_tree_merge():
    rng = np.random.default_rng(2)
    runs, every = [], []
    for _ in range(5):
        keys = np.sort(np.array([bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(40)], "S12"))
        rows = np.unique(keys).view(np.uint8).reshape(-1, 12)
        lcp, rest = suffix_dedup.front_code(rows)
        assert (suffix_dedup.front_decode(lcp, rest, 12) == rows).all()
        runs.append(([r.tobytes() for r in rows], lcp.tolist()))
        every += runs[-1][0]
    order, prefixes = suffix_dedup.merge_runs(runs)
    heads, out = [0] * 5, []
    for r in order:
        out.append(runs[r][0][heads[r]])
        heads[r] += 1
    assert out == sorted(every)
    for a, b, p in zip(out, out[1:], prefixes[1:]):
        assert a[:p] == b[:p] and (p == 12 or a[p] != b[p])


def test_lm_scores(spark, docs, nothing, monkeypatch):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    cols = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    tokens = [(r[0], zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2, [*(r[1] or "").encode().lower().split(), 0]) for r in ROWS]
    count = Counter(w for _, h, t in tokens if not h for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted(((d, h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6))
                   for d, h, t in tokens), key=repr)
    out = lm_score.score(docs, held)
    assert sorted(((*r[:5], round(r[5], 6)) for r in got(out, *cols)), key=repr) == want
    one = got(out, "doc_id", F.round("score", 6))
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 2000)  # many shards, same result
    assert got(lm_score.score(docs, held), "doc_id", F.round("score", 6)) == one
    assert all(-1e9 < s <= 0 for _, s in one)
    assert lm_score.score(nothing, held).count() == 0


def test_filter_reads_back_codes():
    keys = lm_score.unigram_key(np.arange(5000, dtype=np.uint64))
    counts = np.arange(1, 5001)
    bits, on = lm_score.filter_part(keys, counts)
    shard = {"bits": np.array([bits], np.uint64), "base": np.zeros(1, np.int64), "on": on}
    codes, known = lm_score.probe(keys, shard, 1)
    assert known.all() and (codes >= lm_score.code_of(counts)).all() and (codes == lm_score.code_of(counts)).mean() > 0.95
    unseen, _ = lm_score.probe(lm_score.unigram_key(np.arange(10**6, 10**6 + 5000, dtype=np.uint64)), shard, 1)
    assert (unseen > 0).mean() < 0.03


def test_mix_targets_and_overlap(docs, nothing):
    out = mixing.taken(docs, F.array("source")).collect()
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len((r[1] or "").encode().split())
    target = mixing.targets(dict(sizes))
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    taken = Counter()
    for r in out:
        taken[r.pattern[0]] += r.taken
        assert r.taken <= 3 * r.size and r.by_source[0].target == pytest.approx(target[r.pattern[0]])
    largest = max(len((r[1] or "").split()) for r in ROWS)
    assert all(abs(taken[s] - target[s]) <= largest for s in sizes)
    assert got(mixing.taken(docs, F.array("source")), "doc_id", "taken") == sorted(((r.doc_id, r.taken) for r in out), key=repr)
    assert mixing.taken(nothing, F.array("source")).count() == 0
    mixed = mixing.mix(docs, F.array("source"))
    assert mixed.columns == docs.columns and mixed.count() > 0
    # overlap: the shared pattern fills what the single ones cannot, repeats come last
    flow = mixing.min_cost_flow({("a",): 10, ("b",): 10, ("a", "b"): 20}, {"a": 28, "b": 12})
    assert sum(v for (_, s), v in flow.items() if s == "a") == 28 and sum(v for (_, s), v in flow.items() if s == "b") == 12
    assert all(sum(v for (p, _), v in flow.items() if p == q) <= size for q, size in {("a",): 10, ("b",): 10, ("a", "b"): 20}.items())


def test_minhash_equals_brute_force(docs, nothing):
    for n in (2, 5):
        sets = []
        for r in ROWS:
            w = (r[1] or "").encode().lower().split()
            sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
        ids = [-1 if r[0] is None else r[0] for r in ROWS]
        comp = dict(zip(ids, ids))
        changed = True
        while changed:
            changed = False
            for a, x in zip(ids, sets):
                for b, y in zip(ids, sets):
                    if x and 100 * len(x & y) >= 80 * len(x | y) and comp[a] != comp[b]:
                        comp[a] = comp[b] = min(comp[a], comp[b])
                        changed = True
        none = lambda x: None if x == -1 else x
        want = sorted(((none(a), len(x), none(comp[a]), comp[a] == a) for a, x in zip(ids, sets)), key=repr)
        assert got(minhash_dedup.near_duplicates(docs, shingle=n), "doc_id", "n_shingles", "component_id", "kept") == want
    assert minhash_dedup.near_duplicates(nothing).count() == 0
    assert minhash_dedup.deduplicate(docs).columns == docs.columns


def test_minhash_links_members_that_miss_their_centre(spark):
    """A chain of texts, each like the next only, in one bucket whose centre is like none of them."""
    importable(spark)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[9 * i:9 * i + 200])) for i in range(1, 20)] + [(0, " ".join(words[:60] + [f"x{i}" for i in range(400)]))]
    out = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {0: 0, **{i: 1 for i in range(1, 20)}}


def test_minhash_marks_never_rule_out_a_link(spark):
    """Marks differ in at most as many places as the sets do; a member that links with a centre always passes, most unlike ones do not."""
    rng = np.random.default_rng(11)
    rows, links = [], {}
    for i in range(300):
        size, off = int(rng.integers(1, 400)), float(rng.uniform(0, 0.3))
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        y = np.unique(np.where(rng.uniform(size=size) < off, rng.integers(0, 1 << 63, size, dtype=np.uint64), x))
        x = np.unique(x)
        mx, my = minhash_dedup.marks(x), minhash_dedup.marks(y)
        both = len(np.intersect1d(x, y))
        assert sum(int(a ^ b).bit_count() for a, b in zip(mx.tolist(), my.tolist())) <= len(x) + len(y) - 2 * both
        links[i] = 100 * both >= 80 * (len(x) + len(y) - both)
        rows.append((i, len(x), len(y), mx.view(np.int64).tolist(), my.view(np.int64).tolist()))
    table = spark.createDataFrame(rows, "i int, n int, cn int, marks array<long>, cm array<long>")
    passed = {r.i for r in table.filter(minhash_dedup._may_link(80)).collect()}
    right = {i for i, v in links.items() if v}
    assert right <= passed and len(passed - right) < len(links) // 10 and len(right) > 50


def test_minhash_centres_take_turns(spark):
    """Every member outside its bucket's largest component is a centre once; no member of the largest is."""
    rows = [(1, r, 10, 100 if r < 30 else r) for r in range(20, 60)] + [(2, r, 10, 7) for r in range(5)]
    open_ = minhash_dedup._open_buckets(spark.createDataFrame(rows, "key long, rep long, n int, component long"))
    assert {r.key for r in open_.collect()} == {1}
    waiting, seen, r = open_.filter("component != main"), [], 0
    while not waiting.isEmpty():
        r += 1
        centre = [x.c for x in minhash_dedup._next_centres(waiting, r).collect()]
        seen += centre
        waiting = waiting.filter(~F.col("rep").isin(centre))
    assert sorted(seen) == list(range(30, 60)) and r <= 6


def test_embedding_links(spark):
    importable(spark)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 32))
    for i in range(0, 120, 2):  # pairs with cosines from 0.95 up
        c = 0.95 + 0.05 * rng.random()
        u = x[i] / np.linalg.norm(x[i])
        o = rng.standard_normal(32)
        o -= (o @ u) * u
        x[i + 1] = 3 * (c * u + math.sqrt(1 - c * c) * o / np.linalg.norm(o))
    x[200:205] = x[199]
    bad = [None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [float("inf")] * 32, [1.0, 2.0]]
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x)] + [(1000 + i, v, None) for i, v in enumerate(bad)] + [(199, x[199].tolist(), "again")]
    out = {r.vec_id: r for r in embedding_dedup.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert len(out) == 307
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.95) & ~np.eye(300, dtype=bool)
    links = sum(out[i].n_links for i in range(300))
    assert 0.97 * true.sum() <= links <= true.sum()
    assert all(out[i].component_id == 199 and out[i].n_links == 5 for i in range(199, 205))
    assert all(out[1000 + i].n_links == 0 and out[1000 + i].kept for i in range(len(bad)))
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert embedding_dedup.links(empty).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    comp = {}
    for a, b in edges:
        comp.setdefault(a, a), comp.setdefault(b, b)
    for _ in range(60):
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    want = {k: v for k, v in comp.items() if any(a != b and k in (a, b) for a, b in edges)}
    assert {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def test_classifiers_hold_out(spark):
    """Held-out accuracy on the driver's labels, and odd input."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in queries.op9_quality_rules(spark, sf).collect() if r.doc_id in labels and r.held_out]
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)
    tox = [r for r in queries.op8_toxicity(spark, sf).collect() if r.doc_id in labels]
    assert np.mean([int(r.toxic) == labels[r.doc_id].toxic for r in tox]) > 0.97


def test_classifiers_odd_input(docs, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, label int")
    model = quality.fit(docs, labels)
    assert quality.score(docs, model).count() == len(ROWS) and quality.score(nothing, model).count() == 0
    assert quality.keep(docs, model).columns == docs.columns
    grades = spark.createDataFrame([(i, i % 3) for i in range(20)], "doc_id long, grade int")
    model = toxicity.fit(docs, grades)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.expected_severity <= 2 for r in out)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert all(r.expected_severity == 0 for r in toxicity.score(docs, none).collect())
    x = [np.array([k % 3]) for k in range(300)]
    w, theta = toxicity.fit_cumulative_link(x, np.array([k % 3 for k in range(300)]), 3, 3)
    assert w[0] < w[1] < w[2] and theta[0] < theta[1]


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 50


def test_quality_score_does_not_depend_on_the_cap(spark):
    """Nine in ten labels are good, the statistics tell little: the scores keep that share, sampled or not."""
    importable(spark)
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(4000):
        good = int(rng.random() < 0.9)
        digits = rng.random() < (0.3 if good else 0.7)
        rows.append((i, " ".join(["12345" if digits else "word"] * int(rng.integers(5, 40)))))
        labels.append((i, good))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, label int")
    whole, part = ({r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, known, sample=n)).collect()} for n in (4000, 300))
    assert np.mean(list(whole.values())) == pytest.approx(0.9, abs=0.02)
    assert np.mean(list(part.values())) == pytest.approx(0.9, abs=0.04)
    assert np.mean([abs(whole[i] - part[i]) for i in whole]) < 0.05
    assert np.mean([(whole[i] >= 0.7) != (part[i] >= 0.7) for i in whole]) < 0.05


def test_toxicity_does_not_depend_on_the_cap(spark, monkeypatch):
    """One label in ten is toxic, the words tell little: the probabilities keep that share, sampled or not."""
    importable(spark)
    monkeypatch.setattr(toxicity, "STARTS", ())  # whole words only
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(2000):
        bad = int(rng.random() < 0.1)
        words = [f"w{k}" for k in rng.integers(0, 8, 6)] + ["rude"] * int(rng.random() < (0.5 if bad else 0.1))
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    weak = toxicity.weak_grades(docs, known, sample=150)
    stood_for = weak.groupBy((F.col("grade") > 0).cast("int").alias("bad")).agg(F.sum("weight").alias("n"))
    assert {r.bad: round(r.n) for r in stood_for.collect()} == Counter(b for _, b in labels)

    def toxic(grades, n):
        model = toxicity.fit(docs, grades, sample=n)
        return {r.doc_id: 1 - r.p_grades[0] for r in toxicity.score(docs, model).collect()}

    whole = toxic(known.withColumnRenamed("toxic", "grade"), 2000)
    part = toxic(weak.withColumn("grade", F.least("grade", F.lit(1))), 150)
    assert np.mean(list(whole.values())) == pytest.approx(0.1, abs=0.02)
    assert np.mean(list(part.values())) == pytest.approx(0.1, abs=0.04)
    assert np.mean([(whole[i] > 0.5) != (part[i] > 0.5) for i in whole]) < 0.05


def test_mix_fills_the_gap_behind_a_long_text(spark):
    """A text with half a source's words does not end the partial epoch: no document left over fits."""
    rows = [(i, " ".join(["w"] * (20000 if i % 400 == 0 else 20 + i % 37)), "a" if i < 800 else "b") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in (1, 3, 7):
        out = mixing.taken(docs, F.array("source"), seed=seed).collect()
        for s in ("a", "b"):
            own = [r for r in out if r.pattern[0] == s]
            target, whole = own[0].by_source[0].target, min(r.times for r in own)
            smallest = min(r.size for r in own if r.times == whole)
            assert abs(sum(r.taken for r in own) - target) <= smallest / 2 + 1


def test_mix_splits_rows_that_share_an_id(spark):
    """A source of null ids and many equal rows still meets its target, in both forms, whatever the partitions."""
    rows = [(None, f"{i} " + " ".join(["w"] * (20 + i % 37)), "a") for i in range(600)] + [(5, " ".join(["v"] * 30), "b")] * 700 + [(i, "x y z", "c") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.taken(docs, F.array("source")).collect()
    taken, target, smallest = Counter(), {}, {}
    for r in out:
        s = r.pattern[0]
        taken[s] += r.taken
        target[s] = r.by_source[0].target
        smallest[s] = min(r.size, smallest.get(s, r.size))
    assert all(abs(taken[s] - target[s]) <= smallest[s] / 2 + 1 for s in target)
    mixed = mixing.mix(docs.repartition(5), F.array("source")).groupBy("source").agg(F.sum(mixing.size_of(F.col("text"))).alias("n")).collect()
    assert {r.source: r.n for r in mixed} == dict(taken)


def test_minhash_texts_that_share_an_id(spark):
    """Nodes are sets: an id with two texts, or no id, neither joins groups nor hides one."""
    rng = random.Random(8)
    words = lambda: [f"w{rng.randint(0, 10**6)}" for _ in range(80)]
    near = lambda w: " ".join([*w[:-1], "changed"])
    a, b, c, d = words(), words(), words(), words()
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (None, " ".join(c)), (None, near(c)), (9, " ".join(d)), (8, near(d))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got_ = {(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got_ == {(1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (8, 8, True), (9, 8, False)}
    kept = sorted((tuple(r) for r in minhash_dedup.deduplicate(docs).collect()), key=repr)
    assert len(kept) == 4 and {" ".join(a), " ".join(b), near(d)} < {t for _, t in kept}


def test_embeddings_without_ids_do_not_join_groups(spark):
    """Two unrelated vectors without id stay apart, with exact links of every vector."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 64))
    rows = [(None, base[0]), (None, base[1]), (5, base[0] + 0.02 * rng.normal(size=64)), (7, base[1] + 0.02 * rng.normal(size=64)),
            (11, base[2]), (12, base[2] * 3), (13, base[2] + 0.02 * rng.normal(size=64)), (14, base[3])]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    importable(spark)
    got_ = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.links(table).collect()), key=repr)
    assert got_ == sorted([(None, 1, None, True), (None, 1, None, True), (5, 1, None, False), (7, 1, None, False),
                           (11, 2, 11, True), (12, 2, 11, False), (13, 2, 11, False), (14, 0, 14, True)], key=repr)


def test_mix_takes_from_the_null_source(spark):
    """Null is a source like any other, last in order; overlapping patterns that hold it route to it too."""
    rows = [(i, " ".join(["w"] * (20 + i % 37)), [["a"], [None], ["b", None], ["b"]][i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got_ = mixing.taken(docs, F.col("source")).collect()
    total, target = Counter(), {}
    for r in got_:
        total[tuple(r.pattern)] += r.taken
        target.update({s.source: s.target for s in r.by_source})
    assert abs(total["a",] - target["a"]) <= 12
    assert abs(sum(total.values()) - sum(target.values())) <= 40
    assert total[None,] + total["b", None] >= target[None] - 40  # whichever of its patterns the words come from
