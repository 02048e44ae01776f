"""Phrase collocations from a weighted de Bruijn graph of words (operator 11).

Nodes are three-word sequences and an edge joins two nodes that overlap in two
words, so that an edge is a four-word sequence; its weight is how often it occurs. A
piece of text that ends earlier gives edges into the end mark. Tasks count the
edges of their texts first; then edges are dealt to ranges of the sorted order and
each range is read as one sorted stream, in which all occurrences that begin with
the same one, two or three words stand together: the count of a shorter phrase is
the flow through it, edges into the end mark included. A phrase that lies across two
ranges gives one partial sum in each, so a hot phrase never meets in one task.
Range borders come from a bounded sample and decide only what goes where.

Counts below the least are forgotten: parts of a candidate occur as often at least.
Cuts, scores and containment are joins among the frequent phrases. Edges that all of
a node's flow enters and leaves through are compacted to paths by pointer jumping;
a path is a passage that repeats as a whole.

Defined results: null and empty texts hold no pieces; a null language is ``und``;
repeated rows count each; ids and extra columns are not read; an empty table gives no
rows. A word is never cut, so it may be as long as the text.
"""

from __future__ import annotations

import bisect
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import slices, stored

#: A-Z, what separates words and what ends a piece.
UPPER, LOWER, BLANK, ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"\t", b".,;:!?\n\x0b\x0c\r"
#: The end mark is a character that no word holds.
END = "."
_TABLE = bytes.maketrans(UPPER + BLANK + ENDS, LOWER + b" " * len(BLANK) + END.encode() * len(ENDS))
LONGEST = 4
LEAST, SHARE, FACTOR, TOP = 30, 80, 2_000_000, 2000
SLICE_BYTES, BLOCK = 16 << 20, 1 << 21
SAMPLE_DOCS, SAMPLE_STEP, SAMPLE_MOST = 2000, 64, 1000
SALTS = 64


# --- edges -----------------------------------------------------------------------------
def _words(texts: list[bytes]) -> tuple[np.ndarray, list[str], int]:
    """(codes of all words and end marks in order, words in ascending order, code of the end mark).

    Words ascend as they do with a space behind them, so that edges ascend like their keys.
    """
    joined = b".".join([b"", *texts, b""]).translate(_TABLE).replace(b".", b" . ")
    enc = pc.ascii_split_whitespace(pa.array([joined], pa.binary()).cast(pa.string())).flatten().dictionary_encode()
    words = enc.dictionary
    order = pc.sort_indices(pc.binary_join_element_wise(words, "", " ")).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    words = words.take(pa.array(order))
    codes = rank[enc.indices.to_numpy()]
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        codes = codes[codes != empty]
    return codes, words, pc.index(words, END).as_py()


def _edges(codes: np.ndarray, end: int):
    """(matrix of distinct edges, ascending; their counts), block by block; after an end mark only end marks follow."""
    padded = np.concatenate((codes, np.full(LONGEST - 1, end)))
    for lo in range(0, len(codes), BLOCK):
        n = min(BLOCK, len(codes) - lo)
        cols = [padded[lo + k:lo + k + n] for k in range(LONGEST)]
        real = cols[0] != end
        cols = [c[real] for c in cols]
        for k in range(1, LONGEST):
            cols[k] = np.where(cols[k - 1] == end, end, cols[k])
        pair, at = zip(*(np.unique(cols[k] << 32 | cols[k + 1], return_inverse=True) for k in (0, 2)))
        edges, counts = np.unique(at[0].astype(np.int64) << 32 | at[1], return_counts=True)
        first, second = pair[0][edges >> 32], pair[1][edges & 0xFFFFFFFF]
        low = 0xFFFFFFFF
        yield np.stack([first >> 32, first & low, second >> 32, second & low], axis=1), counts


def _by_language(batch):
    """lang -> its texts as bytes."""
    out: dict = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        if text:
            out.setdefault(lang, []).append(text.encode())
    return out


def _key(lang: str, words: pa.Array, matrix: np.ndarray) -> pa.Array:
    """``lang``, a line feed (in no word) and the edge's words, a space behind each."""
    parts = [words.take(pa.array(matrix[:, k])) for k in range(LONGEST)]
    first = pc.binary_join_element_wise(pa.scalar(lang), parts[0], "\n")
    return pc.binary_join_element_wise(first, *parts[1:], "", " ")


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text")).filter("length(text) > 0")


def _borders(src: DataFrame, parts: int) -> list[bytes]:
    """At most ``parts`` - 1 keys that split the sample evenly."""

    def run(batches):
        for b in batches:
            for lang, texts in _by_language(b).items():
                for text in texts:
                    codes, words, end = _words([text])
                    keys = []
                    for matrix, _ in _edges(codes, end):
                        step = max(SAMPLE_STEP, len(matrix) // SAMPLE_MOST)
                        keys += _key(lang, words, matrix[zlib.crc32(text) % step::step]).to_pylist()  # short texts give one by chance
                    yield pa.RecordBatch.from_arrays([pa.array(keys[:SAMPLE_MOST], pa.string())], ["key"])

    n = src.count()
    sample = src.sample(min(1.0, SAMPLE_DOCS / n), seed=1) if n else src
    keys = sorted(r.key.encode() for r in sample.mapInArrow(run, "key string").collect())
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """lang, words (0: all of the language), phrase, n of all phrases up to LONGEST words that occur ``least`` times."""
    spark, src = docs.sparkSession, _source(docs, text_col, lang_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(_borders(src, parts))  # at most parts - 1 edges

    def edges(batches):
        borders = shared.value
        for b in slices(batches, "text", SLICE_BYTES):
            for lang, texts in _by_language(b).items():
                codes, words, end = _words(texts)
                for matrix, counts in _edges(codes, end):
                    whole = lambda i: _key(lang, words, matrix[i:i + 1])[0].as_py().encode()  # noqa: B023, E731
                    cuts = [bisect.bisect_left(range(len(matrix)), x, key=whole) for x in borders]
                    part = np.searchsorted(cuts, np.arange(len(matrix)), "right")
                    for lo in range(0, len(matrix), 50_000):
                        some = slice(lo, lo + 50_000)
                        yield pa.RecordBatch.from_arrays(
                            [_key(lang, words, matrix[some]), pa.array(counts[some], pa.int64()), pa.array(part[some], pa.int32())],
                            ["key", "n", "part"])

    dealt = src.mapInArrow(edges, "key string, n long, part int").repartitionById(parts, "part")
    partial = dealt.select("key", "n").sortWithinPartitions("key") \
        .mapInArrow(lambda batches: _flows(batches, least), "lang string, words int, phrase string, n long")
    summed = stored(partial, "phrase-flows").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return stored(summed.filter((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")


def _flows(batches, least: int):
    """Counts of all beginnings in a stream of sorted edges: ``least`` or more, and what lies at either end of the stream."""
    open_: list = [None] * (LONGEST + 1)  # per level: [beginning, count, at the stream's start]
    out: list[tuple] = []

    def close(level, last):
        group = open_[level]
        if group and (level == 0 or last or group[2] or group[1] >= least):
            lang, *words = group[0]
            if not words or words[-1] != END:
                out.append((lang, level, " ".join(words), group[1]))

    def batch():
        cols = list(zip(*out))
        out.clear()
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["lang", "words", "phrase", "n"])

    for b in batches:
        if not b.num_rows:
            continue
        n = b.column("n").to_numpy()
        tokens = pc.split_pattern(_gram_column(b.column("key")), " ").flatten().dictionary_encode()
        codes = tokens.indices.to_numpy().reshape(len(n), LONGEST)
        heads = _language_column(b.column("key")).dictionary_encode()
        codes = np.column_stack((heads.indices.to_numpy(), codes))
        names = [heads.dictionary, *[tokens.dictionary] * LONGEST]
        end = pc.index(tokens.dictionary, END).as_py()
        new = np.zeros(len(n), bool)
        for level in range(LONGEST + 1):
            new[1:] |= codes[1:, level] != codes[:-1, level]
            starts = np.flatnonzero(new | (np.arange(len(n)) == 0))
            sums = np.add.reduceat(n, starts)
            begin = lambda i: tuple(names[k][int(codes[i, k])].as_py() for k in range(level + 1))  # noqa: B023, E731
            first, final = begin(0), len(starts) - 1
            if open_[level] and open_[level][0] == first:
                open_[level][1] += int(sums[0])
            else:
                at_start = open_[level] is None
                close(level, False)
                open_[level] = [first, int(sums[0]), at_start]
            if final:
                close(level, False)
                enough = np.flatnonzero(sums[1:final] >= (0 if level == 0 else least)) + 1
                if level:
                    enough = enough[codes[starts[enough], level] != end]
                for g in enough:
                    lang, *words = begin(starts[g])
                    out.append((lang, level, " ".join(words), int(sums[g])))
                open_[level] = [begin(starts[final]), int(sums[final]), False]
        if len(out) > 20_000:
            yield batch()
    for level in range(LONGEST + 1):
        close(level, True)
    if out:
        yield batch()


def _line_feed(keys: pa.Array) -> pa.Array:
    """Where the last line feed of each key is: the language before it may hold others."""
    plain = pc.find_substring(keys, "\n")
    odd = np.flatnonzero(pc.greater(pc.count_substring(keys, "\n"), 1).to_numpy(zero_copy_only=False))
    if not len(odd):
        return plain
    at = plain.to_numpy().copy()
    at[odd] = [keys[int(i)].as_py().encode().rindex(b"\n") for i in odd]
    return pa.array(at)


def _cut(keys: pa.Array, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Bytes lo to hi of each key, without a Python loop."""
    buffers, offsets = keys.buffers(), np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1]
    data = np.frombuffer(buffers[2], np.uint8)
    size = hi - lo
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(offsets[:-1] + lo - ends[:-1], size) + np.arange(ends[-1])
    return pa.StringArray.from_buffers(len(keys), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes()))


def _language_column(keys: pa.Array) -> pa.Array:
    return _cut(keys, np.zeros(len(keys), np.int64), _line_feed(keys).to_numpy().astype(np.int64))


def _gram_column(keys: pa.Array) -> pa.Array:
    return _cut(keys, _line_feed(keys).to_numpy().astype(np.int64) + 1, pc.binary_length(keys).to_numpy().astype(np.int64) - 1)


# --- scores ------------------------------------------------------------------------------
def _part(first: int | Column, n: int | Column) -> Column:
    """``n`` words of the phrase, from word ``first`` (1 for the first)."""
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def scored(counts: DataFrame, factor: int = FACTOR, share: int = SHARE) -> DataFrame:
    """lang, phrase, words, a, l, r, cut, score of the candidates that no longer one stands for."""
    phrases = counts.filter("words > 0").select("lang", "phrase", "words", F.col("n").alias("a"))
    candidates = phrases.filter("words > 1")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")) \
        .select("*", _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    both = cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
        .join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"cast({factor} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = both.select("lang", "phrase", "words", "a", F.struct(score.cast("long").alias("score"), "cut", "l", "r").alias("x")) \
        .groupBy("lang", "phrase", "words", "a").agg(F.min("x").alias("x")).select("lang", "phrase", "words", "a", "x.*")
    # every run of words inside a longer candidate, with the most frequent one that holds it
    inside = candidates.filter("words > 2").select("lang", F.col("a").alias("f"), "phrase", "words") \
        .select("*", F.explode(F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> struct(i, n))))")).alias("at")) \
        .select("lang", _part(F.col("at.i"), F.col("at.n")).alias("phrase"), "f") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = least.join(inside, ["lang", "phrase"], "left") \
        .filter(F.col("f").isNull() | (_exact(F.col("f")) * 100 < _exact(F.col("a")) * share))
    return kept.drop("f")


def paths(counts: DataFrame) -> DataFrame:
    """lang, phrase (an edge), path (its first edge), step, path_words: edges of unary paths.

    Two edges are one path where the node between them has no other flow: their
    counts and its own are equal. Pointer jumping doubles what an edge knows of its
    path each round. Edges of a circle have no first one: each is a path of its own.
    """
    edge = counts.filter(f"words = {LONGEST}").select("lang", "phrase", "n")
    node = counts.filter(f"words = {LONGEST - 1}").select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    into = edge.select("lang", _part(2, LONGEST - 1).alias("node"), F.col("phrase").alias("before"), F.col("n").alias("m"))
    out = edge.select("lang", _part(1, LONGEST - 1).alias("node"), "phrase", "n")
    links = into.join(node, ["lang", "node"]).filter("m = flow").join(out, ["lang", "node"]).filter("n = flow and phrase != before") \
        .select("lang", "phrase", "before")
    links = stored(links, "unary-links")
    heads = links.select("lang", F.col("before").alias("phrase")).join(links.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    # at: the edge reached backwards, step: how far it is, done: it is the path's first
    now = stored(links.select("lang", "phrase", F.col("before").alias("at"), F.lit(1).cast("long").alias("step"), F.lit(False).alias("done"))
                 .unionByName(heads.select("lang", "phrase", F.col("phrase").alias("at"), F.lit(0).cast("long").alias("step"), F.lit(True).alias("done"))), "unary-paths")
    total = now.count()
    for _ in range(max(1, math.ceil(math.log2(total + 1))) + 1):
        if not now.filter("not done").limit(1).count():
            break
        known = now.select("lang", F.col("phrase").alias("at"), F.col("at").alias("at2"), F.col("step").alias("step2"), F.col("done").alias("done2"))
        now = stored(now.filter("done").unionByName(
            now.filter("not done").join(known, ["lang", "at"]).select(
                "lang", "phrase", F.col("at2").alias("at"), (F.col("step") + F.col("step2")).alias("step"), F.col("done2").alias("done"))), "unary-paths")
    ends = now.filter("done").groupBy("lang", "at").agg((F.max("step") + LONGEST).alias("path_words"))
    return now.filter("done").join(ends, ["lang", "at"]).select("lang", "phrase", F.col("at").alias("path"), "step", "path_words")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, share: int = SHARE,
                 factor: int = FACTOR, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, path_words: each language's ``top`` phrases."""
    counts = phrase_counts(docs, text_col, lang_col, least)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of each share of a language first, so that no task ranks a whole language
    share_of = Window.partitionBy("lang", "salt").orderBy(*best)
    some = scored(counts, factor, share).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))) \
        .withColumn("rank", F.row_number().over(share_of)).filter(F.col("rank") <= top).drop("salt", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")) \
        .filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").join(paths(counts).select("lang", "phrase", "path_words"), ["lang", "phrase"], "left") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.coalesce("path_words", F.col("words").cast("long")).alias("path_words"))
