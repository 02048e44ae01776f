"""MinHash near-dedup: one permutation, optimal densification, star candidates (operator 7).

A document's set holds the 64-bit hashes of its distinct word shingles. Equal
sets form a class first (a group of copies becomes one representative), so the
search runs over different sets only. One permutation of the hash space is cut
into BINS ranges; the smallest hash of each range is the sketch, and an empty
range borrows from a range picked by its own hash sequence (optimal
densification). ROWS bins make a band key. Inside a bucket only star edges to
a centre are looked at, in the first round at most as many as the rows.

A star can miss two members that are alike but both unlike their centre. So
while a bucket holds several components, members outside its largest one
become centres in turn, GROWTH times as many a round, until each of them has been a
centre there. Of two members in different components one at least was then
held against the other, so no pair that shares a bucket is missed. At a
similarity of 0.8 a pair shares no bucket with probability (1 - 0.8**5)**32 = 3e-6.

An edge becomes a candidate row, to be confirmed on the full sets, only if its
ends lie in different components and neither the set sizes nor the marks rule a
link out. A set's marks are 64 * MARKS parities: each shingle flips one of them.
Two sets' marks differ in at most as many places as the sets differ in shingles,
so a pair whose marks differ too much has no link: nothing is lost, and unlike
members of a hot bucket cost a comparison inside the join, not a row.

Links: 100 * |intersection| >= PERCENT * |union|.

Defined results: null, empty and blank texts have the empty set, link with
nothing and are their own component; texts with fewer words than a shingle have
one shingle, the whole sequence; repeated rows share their set and component
(one result row per row); a null id is compared like any other and counts as
the smallest; an id with several texts is as many documents: nodes are sets, and
only their components are named by ids; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import mix64, slices, stored, words_of
from cartwheel.llm.components import components

SHINGLE = 5
PERCENT = 80
ROWS, BANDS = 5, 32
BINS = ROWS * BANDS
TRIES = 512
CENTRES, GROWTH = 8, 16
MARKS = 16
SIEVE = 19


def _word_hashes(dictionary: pa.Array) -> np.ndarray:
    import xxhash
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w) for w in dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(dictionary))


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    offsets, codes, dictionary = words_of(texts)
    h = _word_hashes(dictionary)[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = mix64(h)
    for k in range(1, shingle):
        nxt = np.zeros_like(rolled)
        nxt[:len(h) - k] = h[k:]
        rolled = mix64(rolled + nxt * np.uint64(0x9E3779B97F4A7C15))
    out = []
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if hi - lo >= shingle:
            out.append(np.unique(rolled[lo:hi - shingle + 1]))
        elif hi > lo:  # the whole sequence as one shingle; its length keeps it apart from longer ones
            x = np.array([hi - lo], np.uint64)
            for v in h[lo:hi]:
                x = mix64(x + v)
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _borrow_order() -> np.ndarray:
    """Bin that bin j looks at on its t-th try: an independent sequence per bin."""
    j, t = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(TRIES, dtype=np.uint64), indexing="ij")
    return (mix64(j * np.uint64(1_000_003) + t + np.uint64(17)) % np.uint64(BINS)).astype(np.int64)


_EDGES = np.array([(i << 64) // BINS for i in range(BINS)], np.uint64)
_BORROW = _borrow_order()


def sketch(values: np.ndarray) -> np.ndarray:
    """Smallest hash of each range of the hash space, empty ranges densified (``values`` not empty)."""
    first = np.searchsorted(values, _EDGES)
    upto = np.append(first[1:], len(values))
    full = first < upto
    out = values[np.minimum(first, len(values) - 1)].copy()
    todo = np.flatnonzero(~full)
    for t in range(TRIES):
        if not len(todo):
            return out
        pick = _BORROW[todo, t]
        good = full[pick]
        out[todo[good]] = values[first[pick[good]]]
        todo = todo[~good]
    out[todo] = values[0]
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = sketch(values).reshape(BANDS, ROWS)
    key = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(101))
    for r in range(ROWS):
        key = mix64(key + rows[:, r] * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, own, tk (these two tell texts of one id apart), n_shingles, digest (128 bits of the set), bands array<long>."""

    def run(batches):
        import xxhash
        for b in slices(batches, "text"):
            sets = shingle_sets(b.column("text"), shingle)
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            bands = _lists([band_keys(s) if len(s) else np.zeros(0, np.int64) for s in sets])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "own", "tk")), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(digest, pa.binary()), bands], ["doc_id", "own", "tk", "n_shingles", "digest", "bands"])

    return docs.mapInArrow(run, "doc_id long, own long, tk long, n_shingles long, digest binary, bands array<long>")


def marks(values: np.ndarray) -> np.ndarray:
    """64 * MARKS parities as uint64 words: bit j tells whether an odd number of the hashes end in j."""
    odd = np.bincount((values % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """rep, items array<long> (the whole set), marks array<long>."""

    def run(batches):
        for b in slices(batches, "text"):
            sets = shingle_sets(b.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([b.column("rep"), _lists(sets), _lists([marks(s) for s in sets])], ["rep", "items", "marks"])

    return docs.mapInArrow(run, "rep long, items array<long>, marks array<long>")


def _may_link(percent: int) -> Column:
    """False only where the sizes or the marks of a member (n, marks) and a centre (cn, cm) rule a link out.

    A link leaves at most (100 - percent) / (100 + percent) of both sizes together unshared.
    """
    sizes = F.lit(100) * F.least("n", "cn") >= F.lit(percent) * F.greatest("n", "cn")
    differ = sum((F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("cm")[i])) for i in range(MARKS)), F.lit(0))
    return sizes & (F.lit(100 + percent) * differ <= F.lit(100 - percent) * (F.col("n") + F.col("cn")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """ca, cb (the components) of the pairs (a, b) whose full sets pass; the sets move to the pairs, not the other way round."""
    side = lambda c: sets.join(pairs.select(F.col(c).alias("rep")), "rep", "left_semi")  # noqa: E731  a round of few pairs moves few sets
    one = pairs.join(side("b").select(F.col("rep").alias("b"), F.col("items").alias("y")), "b")
    two = one.join(side("a").select(F.col("rep").alias("a"), F.col("items").alias("x")), "a")
    both = F.size(F.array_intersect("x", "y"))
    return two.filter(F.lit(100) * both >= F.lit(percent) * (F.size("x") + F.size("y") - both)).select("ca", "cb").distinct()


def _open_buckets(bucket: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with the bucket's most frequent one as ``main``."""
    parts = bucket.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    main = parts.groupBy("key").agg(F.max(F.struct("m", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts"))
    return bucket.join(main.filter("parts > 1").select("key", "main"), "key")


def _first_centres(bucket: DataFrame) -> DataFrame:
    """key, c, cc, cn: each bucket's smallest id, its component and set size."""
    low = bucket.groupBy("key").agg(F.min(F.struct("rep", "component", "n")).alias("p"))
    return low.select("key", F.col("p.rep").alias("c"), F.col("p.component").alias("cc"), F.col("p.n").alias("cn"))


def _next_centres(waiting: DataFrame, r: int) -> DataFrame:
    """The same for about CENTRES * GROWTH**(r-1) seeded picks a bucket of the members that wait, all of them when they are fewer."""
    left = waiting.groupBy("key").agg(F.count(F.lit(1)).alias("left"))
    turn = F.pmod(F.xxhash64(F.lit(r), "rep"), F.col("left"))
    return waiting.join(left, "key").filter(turn < F.lit(CENTRES * GROWTH ** (r - 1)).cast("long")) \
        .select("key", F.col("rep").alias("c"), F.col("component").alias("cc"), F.col("n").alias("cn"))


def _merged(comp: DataFrame, new: DataFrame) -> DataFrame:
    """Components after the links ``new`` (ca, cb) between components."""
    step = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).withColumnRenamed("component", "to")
    return comp.join(step, comp["component"] == step["id"], "left").select("rep", "n", F.coalesce("to", "component").alias("component"))


NULL_ID = -(1 << 63)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID).cast("long")).alias("own"), F.xxhash64("text").alias("tk"), "text")


def _sieved(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``src`` whose (own, tk) may be in ``wanted``: texts that surely are not are never exchanged.

    One bit per key in 2**SIEVE words of 64, so the broadcast has a fixed bound (16 bytes a word);
    a full sieve lets every row through, and the exact join follows in any case.
    """
    h = F.xxhash64(F.lit("sieve"), "own", "tk")
    word, bit = F.shiftrightunsigned(h, 64 - SIEVE).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    sieve = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return src.withColumn("word", word).join(F.broadcast(sieve), "word").filter(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    got = _grouped(_source(docs, id_col, text_col), shingle, percent)
    return got.select("doc_id", "n_shingles", F.when(F.col("low") != NULL_ID, F.col("low")).alias("component_id"),
                      (F.col("low") == F.col("own")).alias("kept"))


def _grouped(src: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, own, tk, n_shingles, low (smallest id of the component), stays (one set and id of each component)."""
    named = stored(sketches(src, shingle), "sketches")
    # classes of equal sets, numbered once: the numbers are the nodes, whatever ids the texts share
    cls = stored(named.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("own", "tk", "bands")).alias("low"))
                 .select("digest", F.struct("low.own", "low.tk").alias("first"), "low.bands", F.monotonically_increasing_id().alias("rep")), "classes")
    rows = cls.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    rows = stored(rows.join(shared, "key"), "buckets")
    wanted = stored(rows.select("rep").distinct().join(cls.select("rep", "first.*"), "rep"), "wanted")
    once = _sieved(src, wanted).dropDuplicates(["own", "tk"])  # repeated rows combine before they move
    sets = stored(full_sets(once.join(wanted, ["own", "tk"]).select("rep", "text"), shingle), "sets")

    comp = stored(sets.select("rep", F.size("items").alias("n"), F.col("rep").alias("component")), "components")
    seen = sets.select("rep", "marks")
    done = None
    r = 0
    while True:
        bucket = rows.join(comp, "rep")
        if not r:
            centre = _first_centres(bucket)
        else:
            bucket = stored(_open_buckets(bucket), "open-buckets")
            waiting = bucket.filter("component != main")
            if r > 1:
                waiting = waiting.join(done, ["key", "rep"], "left_anti")
            if waiting.isEmpty():
                break
            centre = _next_centres(waiting, r)
        centre = stored(centre.join(seen.select(F.col("rep").alias("c"), F.col("marks").alias("cm")), "c"), "centres")
        if r:
            used = centre.select("key", F.col("c").alias("rep"))
            done = used if done is None else done.unionByName(used)
            bucket = bucket.join(used.select("key").distinct(), "key", "left_semi")
        pairs = bucket.join(seen, "rep").join(centre, "key").filter((F.col("component") != F.col("cc")) & _may_link(percent)) \
            .select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b"),
                    F.least("component", "cc").alias("ca"), F.greatest("component", "cc").alias("cb")).distinct()
        pairs = stored(pairs, "pairs")
        new = stored(_confirmed(pairs, sets, percent), "confirmed")
        if not new.isEmpty():
            comp = stored(_merged(comp, new), "components")
        r += 1
    member = cls.join(comp.select("rep", "component"), "rep", "left").select("digest", "first", F.coalesce("component", "rep").alias("component"))
    lowest = member.groupBy("component").agg(F.min(F.struct(F.col("first.own").alias("own"), F.col("digest").alias("digest"))).alias("top"))
    member = member.join(lowest, "component").select("digest", "top")
    return named.join(member, "digest", "left").select(
        "doc_id", "own", "tk", "n_shingles", F.coalesce("top.own", "own").alias("low"),
        (F.col("top").isNull() | ((F.col("top.own") == F.col("own")) & (F.col("top.digest") == F.col("digest")))).alias("stays"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, all columns kept.

    Repeated rows of the document that stays stay with it (there are none after exact dedup).
    """
    gone = _grouped(_source(docs, id_col, text_col), shingle, percent).filter("not stays").select("own", "tk").distinct()
    id_, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    d = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(id_, F.lit(NULL_ID).cast("long")).alias("own"), F.xxhash64(text).alias("tk"))
    return d.join(gone, ["own", "tk"], "left_anti").select("row.*")  # as a struct no column can clash
