"""Collocations and unary paths against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cartwheel.llm import collocations, queries
from cartwheel.llm.common import importable

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, words int"


def corpus():
    """Few words, so that phrases repeat; passages copied whole; odd separators, nulls, clashing columns."""
    rng = random.Random(4)
    vocab = ["the", "of", "an", "É", "x-y", "日本", "zz", "a\x01b", "a", "\xa0", "don't", "\x1c"]
    passage = " ".join(f"w{k}" for k in range(40))
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" "] * 9 + ["\t", "  ", ". ", "\n", ", ", "!?", "\x0b"]) for _ in range(n))
    rows = [(i, text(rng.randint(1, 120)).title() if i % 9 == 0 else text(rng.randint(1, 120)), ["en", "fr", None, "l\nx"][i % 4], "p", 1, 2) for i in range(400)]
    rows += [(1000 + i, text(3) + passage + (" tail" if i % 2 else ". the"), "en", "p", 1, 2) for i in range(45)]
    rows += [(2000, t, "en", None, None, None) for t in (None, "", "  ", "...", "One", "x " * 3000)]
    rows += [(7, "same row of words", "fr", None, None, None)] * 40
    rows += [(None, "one word", "und", None, None, None)] * 35
    return rows


def plain(rows, least, share=80, factor=2_000_000, top=2000):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3, 4):
                f[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        over = defaultdict(int)
        for p, a in cands.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    over[p[i:i + n]] = max(over[p[i:i + n]], a)
        best = []
        for p, a in cands.items():
            if 100 * over[p] >= share * a:
                continue
            score, k = min((factor * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("least,top,parts", [(30, 2000, 3), (2, 50, 1)])
def test_collocations_equal_plain_counts(spark, least, top, parts):
    importable(spark)
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(parts)
    got = collocations.collocations(docs, least=least, top=top)
    assert sorted(tuple(r) for r in got.select(*COLS).collect()) == plain(corpus(), least, top=top)


def test_query_reads_the_table(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_collocations(spark, str(tmp_path))
    rows = got.collect()
    assert sorted(tuple(r[c] for c in COLS) for r in rows) == plain(corpus(), 30)
    # the copied passage is one path of all its words
    inner = [r.path_words for r in rows if re.fullmatch(r"w\d+ w\d+ w\d+ w\d+", r.phrase)]
    assert len(inner) == 37 and set(inner) == {40}


def test_small_blocks_and_many_ranges(spark, monkeypatch):
    """Phrases across blocks, Arrow batches and ranges are counted whole."""
    importable(spark)
    docs = spark.createDataFrame(corpus(), SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = collocations.phrase_counts(docs, least=5)
        counts = {(r.lang, r.phrase): r.n for r in got.filter("words > 0").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    f = Counter()
    for _, text, lang, *_ in corpus():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for n in (1, 2, 3, 4):
                f.update((lang or "und", " ".join(words[i:i + n])) for i in range(len(words) - n + 1))
    assert counts == {k: n for k, n in f.items() if n >= 5}


def test_edges_in_blocks(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 7)
    codes, words, end = collocations._words([b"a b c d. a b", b"c a b c d a b"])
    total = Counter()
    for matrix, counts in collocations._edges(codes, end):
        for row, n in zip(matrix, counts):
            total[" ".join(words[int(c)].as_py() for c in row)] += int(n)
    assert total == Counter({"a b c d": 2, "b c d .": 1, "c d . .": 1, "d . . .": 1, "a b . .": 2, "b . . .": 2,
                             "c a b c": 1, "b c d a": 1, "c d a b": 1, "d a b .": 1})


def test_circle_has_no_first_edge(spark):
    importable(spark)
    counts = spark.createDataFrame([("en", 4, p, 30) for p in ("a b c a", "b c a b", "c a b c")] + [("en", 3, p, 30) for p in ("a b c", "b c a", "c a b")]
                                   + [("en", 4, p, 9) for p in ("p q r s", "q r s t")] + [("en", 3, "q r s", 9)], "lang string, words int, phrase string, n long")
    got = {r.phrase: (r.path, r.step, r.path_words) for r in collocations.paths(counts).collect()}
    assert got == {"p q r s": ("p q r s", 0, 5), "q r s t": ("p q r s", 1, 5)}


def test_nothing(spark):
    importable(spark)
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
