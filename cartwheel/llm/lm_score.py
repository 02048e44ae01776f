"""Language-model scores from a log-frequency Bloom filter (operator 4).

Counts of all words and word pairs of the training documents are quantised to
powers of two, and a Bloom filter holds (n-gram, 1) ... (n-gram, code), so the
code of an n-gram is read back by repeated membership probes. The filter is
built in parts, one per bucket of the n-gram hash, each with BITS bits per entry,
so its size follows the corpus and its error rate does not. Parts are broadcast
to the workers in shards of SHARD_BYTES at most: one pass over the coded texts
per shard, with the codes found so far carried along, so memory is bounded at
every corpus size and nothing is dropped.

Model: interpolated bigrams, p(w|v) = l(v) * c(v w) / c(v) + (1 - l(v)) * p(w) with
p(w) add-one smoothed over the training words, l(v) by the code of c(v), 0 for an
unseen v; a pair with an unseen word counts as unseen. The first word follows the
end of the text before it. ``base_score`` beside it uses exact counts and no filter.

Words are told apart by 64-bit hashes: two of n distinct words share one with a
probability of about n*n / 2**65.

Defined results: null, empty and blank texts hold the end only; an empty table,
or one without training rows, gives N = 0 and V = 0 and probabilities 1 / (N + V + 1);
repeated rows are counted and scored each; a null id folds like the empty text;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import mix64, slices, stored, words_of

BITS, PROBES = 10, 7
SHARD_BYTES = 128 << 20
STEP = 1 << 17
END_HASH = np.uint64(0x5851F42D4C957F2D)
#: (largest code of the history's count, weight of the pair's own estimate)
LAMBDAS = ((4, 0.5), (8, 0.3), (64, 0.15))
_K = np.uint64(0x9E3779B97F4A7C15)


def _zip(a: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(1).compress(a.tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def coded(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Batches of documents: local vocabulary as hashes (entry 0: the end), tokens as local codes."""

    def run(batches):
        import xxhash
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        one = xxhash.xxh3_64_intdigest
        for b in slices(batches, "text", 8 << 20):
            offsets, codes, dictionary = words_of(b.column("text").cast(pa.string()))
            vocab = np.empty(len(dictionary) + 1, np.uint64)
            vocab[0] = END_HASH
            vocab[1:] = np.fromiter((one(w) for w in dictionary.to_pylist()), np.uint64, len(dictionary))
            n = b.num_rows
            tokens = np.zeros(len(codes) + n, np.uint32)
            body = np.ones(len(tokens), bool)
            body[offsets[1:] + np.arange(n)] = False
            tokens[body] = codes + 1
            held = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
            lens = np.diff(offsets) + 1
            counts = np.bincount(tokens[np.repeat(~held, lens)], minlength=len(vocab)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | seq], pa.int64()), pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([lens.tolist()], pa.list_(pa.int32())),
                 pa.array([vocab.tobytes()]), pa.array([_zip(tokens)]), pa.array([_zip(counts)])],
                ["batch", "doc_ids", "held", "lens", "vocab", "tokens", "counts"])
            seq += 1

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held"))
    return src.mapInArrow(run, "batch long, doc_ids array<long>, held array<boolean>, lens array<int>, vocab binary, tokens binary, counts binary")


def exact_totals(table: DataFrame, buckets: int) -> DataFrame:
    """batch, bucket, totals (training counts of the batch's words in the bucket, in order), n, v."""

    def spread(batches):
        for b in batches:
            for batch, vocab, counts in zip(*(b.column(c).to_pylist() for c in ("batch", "vocab", "counts"))):
                h, c = np.frombuffer(vocab, np.uint64), _unzip(counts, np.uint32)
                at = (h % np.uint64(buckets)).astype(np.int64)
                for k in np.unique(at):
                    m = at == k
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([batch], pa.int64()),
                                                      pa.array([h[m].tobytes()]), pa.array([_zip(c[m])])],
                                                     ["bucket", "batch", "hashes", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        hs = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
        cs = np.concatenate([_unzip(x, np.uint32) for x in pdf["counts"]])
        _, inverse = np.unique(np.concatenate(hs), return_inverse=True)
        sums = np.bincount(inverse, cs).astype(np.uint64)
        mine = np.split(sums[inverse], np.cumsum([len(x) for x in hs])[:-1])
        first = np.arange(len(pdf)) == 0
        return pd.DataFrame({"batch": pdf["batch"].to_numpy(), "bucket": pdf["bucket"].to_numpy(), "totals": [_zip(x) for x in mine],
                             "n": np.where(first, int(sums.sum()), 0), "v": np.where(first, int((sums > 0).sum()), 0)})

    rows = table.select("batch", "vocab", "counts").mapInArrow(spread, "bucket int, batch long, hashes binary, counts binary")
    return rows.groupBy("bucket").applyInPandas(total, "batch long, bucket int, totals binary, n long, v long")


# --- the filter ----------------------------------------------------------------------

def unigram_key(h: np.ndarray) -> np.ndarray:
    return mix64(h ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(16)


def bigram_key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return mix64(mix64(h1) + h2 * _K) >> np.uint64(16)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a 48-bit key, by range."""
    return (((key >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def code_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count))."""
    return np.floor(np.log2(counts.astype(np.float64))).astype(np.int64) + 1


def value_of(codes: np.ndarray) -> np.ndarray:
    """Count that a code stands for: exact for 0 and 1, else inside [2**(code-1), 2**code)."""
    c = codes.astype(np.float64)
    return np.where(c <= 1, c, 1.4 * np.exp2(c - 1))


def _position(key: np.ndarray, code, probe: int, bits: np.ndarray) -> np.ndarray:
    x = mix64(key * _K + np.uint64(code * 131 + probe + 1) * np.uint64(0xC2B2AE3D27D4EB4F))
    return x % bits


def filter_part(keys: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """(bits, packed bytes) of the part that holds ``keys``."""
    codes = code_of(counts) if len(keys) else np.zeros(0, np.int64)
    bits = np.uint64(max(64, int(codes.sum()) * BITS))
    on = np.zeros(-(-int(bits) // 8), np.uint8)
    level = 1
    while len(keys):
        for probe in range(PROBES):
            at = _position(keys, level, probe, bits)
            np.bitwise_or.at(on, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        level += 1
        more = codes >= level
        keys, codes = keys[more], codes[more]
    return int(bits), on


def probe(keys: np.ndarray, shard: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, known): codes read from the shard's parts; known marks keys whose part it holds."""
    at = bucket_of(keys, buckets)
    bits, base = shard["bits"][at], shard["base"][at]
    known = bits > 0
    codes = np.zeros(len(keys), np.uint8)
    alive = np.flatnonzero(known)
    on, level = shard["on"], 1
    while len(alive):
        for p in range(PROBES):
            pos = _position(keys[alive], level, p, bits[alive])
            byte = on[base[alive] + (pos >> np.uint64(3)).astype(np.int64)]
            alive = alive[(byte >> (pos & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            if not len(alive):
                break
        codes[alive] = level
        level += 1
    return codes, known


def build_filter(table: DataFrame, buckets: int) -> DataFrame:
    """bucket, bits, part: the filter over all training n-grams, one row per part."""

    def spread(batches):
        for b in batches:
            for vocab, tokens, counts, held, lens in zip(*(b.column(c).to_pylist() for c in ("vocab", "tokens", "counts", "held", "lens"))):
                h, t, c = np.frombuffer(vocab, np.uint64), _unzip(tokens, np.uint32).astype(np.int64), _unzip(counts, np.uint32)
                prev = np.concatenate(([0], t[:-1]))  # every document follows an end
                train = np.repeat(~np.asarray(held, bool), lens)
                pair, times = np.unique(prev[train] * len(h) + t[train], return_counts=True)
                seen = c > 0
                keys = np.concatenate([unigram_key(h[seen]), bigram_key(h[pair // len(h)], h[pair % len(h)])])
                times = np.concatenate([c[seen], times]).astype(np.uint32)
                at = bucket_of(keys, buckets)
                order = np.argsort(at, kind="stable")
                keys, times, at = keys[order], times[order], at[order]
                cuts = np.searchsorted(at, np.arange(buckets + 1))
                for k in np.unique(at):
                    lo, hi = cuts[k], cuts[k + 1]
                    six = np.ascontiguousarray(keys[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([six.tobytes()]), pa.array([_zip(times[lo:hi])])],
                                                     ["bucket", "keys", "times"])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        six = np.frombuffer(b"".join(pdf["keys"]), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(six), 8), np.uint8)
        wide[:, :6] = six
        times = np.concatenate([_unzip(x, np.uint32) for x in pdf["times"]])
        keys, inverse = np.unique(wide.view("<u8").reshape(-1), return_inverse=True)
        bits, on = filter_part(keys, np.bincount(inverse, times))
        return pd.DataFrame({"bucket": [pdf["bucket"].iat[0]], "bits": [bits], "part": [on.tobytes()]})

    rows = table.select("vocab", "tokens", "counts", "held", "lens").mapInArrow(spread, "bucket int, keys binary, times binary")
    return rows.groupBy("bucket").applyInPandas(build, "bucket int, bits long, part binary")


def _shards(parts: DataFrame) -> list[list[int]]:
    """Buckets in groups of SHARD_BYTES at most (one part at least)."""
    out, size = [], SHARD_BYTES
    for r in parts.select("bucket", "bits").orderBy("bucket").collect():
        if size + r.bits // 8 > SHARD_BYTES:
            out.append([])
            size = 0
        out[-1].append(r.bucket)
        size += r.bits // 8
    return out or [[]]


def _load(parts: DataFrame, wanted: list[int], buckets: int) -> dict:
    """The shard's parts side by side; they come one file at a time, straight into their place."""
    bits, base = np.zeros(buckets, np.uint64), np.zeros(buckets, np.int64)
    mine = parts.filter(F.col("bucket").isin(wanted))
    on, at = np.zeros(mine.agg(F.sum(F.octet_length("part"))).first()[0] or 0, np.uint8), 0
    for r in mine.toLocalIterator():
        bits[r.bucket], base[r.bucket] = r.bits, at
        on[at:at + len(r.part)] = np.frombuffer(r.part, np.uint8)
        at += len(r.part)
    return {"bits": bits, "base": base, "on": on}


# --- scoring -------------------------------------------------------------------------

STATE = "batch long, doc_ids array<long>, held array<boolean>, lens array<int>, vocab binary, tokens binary, totals binary, uni binary, bi binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _totals_of(vocab: bytes, right: pd.DataFrame, buckets: int) -> np.ndarray:
    """Exact training counts of a batch's words, from the rows of its buckets."""
    h = np.frombuffer(vocab, np.uint64)
    at, c = (h % np.uint64(buckets)).astype(np.int64), np.zeros(len(h), np.uint64)
    for k, blob in zip(right["bucket"], right["totals"]):
        c[at == k] = _unzip(blob, np.uint64)
    return c


def _read_codes(vocab, tokens, uni, bi, shard, buckets):
    """(tokens, the words before them, codes of the words, codes of the pairs), codes completed by ``shard``."""
    h, t = np.frombuffer(vocab, np.uint64), _unzip(tokens, np.uint32)
    prev = np.concatenate((np.zeros(1, np.uint32), t[:-1]))
    u = _unzip(uni, np.uint8).copy() if uni else np.zeros(len(h), np.uint8)
    w = _unzip(bi, np.uint8).copy() if bi else np.zeros(len(t), np.uint8)
    got, known = probe(unigram_key(h), shard, buckets)
    u[known] = got[known]
    for lo in range(0, len(t), STEP):
        s = slice(lo, lo + STEP)
        got, known = probe(bigram_key(h[prev[s]], h[t[s]]), shard, buckets)
        w[s][known] = got[known]
    return t, prev, u, w


def _scores(row: dict, exact: np.ndarray, shard: dict, buckets: int, n: int, v: int) -> dict:
    """The result columns of one batch."""
    t, prev, u, w = _read_codes(row["vocab"], row["tokens"], row["uni"], row["bi"], shard, buckets)
    lens = np.asarray(row["lens"], np.int64)
    starts = np.cumsum(lens) - lens
    c = value_of(u)
    p_word = (c + 1.0) / (n + v + 1.0)
    weight = np.select([u == 0, *(u <= code for code, _ in LAMBDAS)], [0.0, *(x for _, x in LAMBDAS)], 0.0)
    model = np.empty(len(t))
    for lo in range(0, len(t), STEP):
        s = slice(lo, lo + STEP)
        now, before = t[s], prev[s]
        code = np.where((u[now] > 0) & (u[before] > 0), w[s], 0)
        pair = np.minimum(1.0, value_of(code) / np.maximum(c[before], 1.0))
        lam = weight[before]
        model[s] = np.log10(lam * pair + (1 - lam) * p_word[now])
    sums = lambda x: np.add.reduceat(x, starts) if len(starts) else x[:0]
    out = {"doc_id": row["doc_ids"], "held_out": row["held"], "n_tokens": lens, "train_tokens": [n] * len(lens), "score": sums(model)}
    out["n_known"] = sums((exact > 0).astype(np.int32)[t]).astype(np.int64)
    out["base_score"] = sums((np.log10(exact + 1.0) - np.log10(n + v + 1.0))[t])
    return {name: out[name] for name in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")}


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    The model learns from the rows where ``held_out`` is false.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = stored(coded(docs, held_out, id_col, text_col), "lm-coded")
    totals = stored(exact_totals(table, buckets), "lm-totals")
    n, v = totals.agg(F.sum("n"), F.sum("v")).first()
    n, v = n or 0, v or 0
    parts = stored(build_filter(table, buckets), "lm-filter")
    both = table.groupBy("batch").cogroup(totals.select("batch", "bucket", "totals").groupBy("batch"))
    shards = _shards(parts)
    if len(shards) == 1:  # the usual case: join and score in one step
        only = spark.sparkContext.broadcast(_load(parts, shards[0], buckets))  # SHARD_BYTES at most

        def at_once(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            row = left.iloc[0].to_dict() | {"uni": b"", "bi": b""}
            out = _scores(row, _totals_of(row["vocab"], right, buckets), only.value, buckets, n, v)
            return pd.DataFrame(out | {"doc_id": pd.array(out["doc_id"], "Int64")})

        return both.applyInPandas(at_once, RESULT)

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return left.drop(columns=["counts"]).assign(totals=[_zip(_totals_of(left["vocab"].iat[0], right, buckets))], uni=[b""], bi=[b""])

    state = both.applyInPandas(join, STATE)
    for wanted in shards:
        shared = spark.sparkContext.broadcast(_load(parts, wanted, buckets))  # SHARD_BYTES at most

        def add(batches, shared=shared):
            for b in batches:
                cols = {name: b.column(name).to_pylist() for name in ("vocab", "tokens", "uni", "bi")}
                new = [_read_codes(*x, shared.value, buckets)[2:] for x in zip(*cols.values())]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("batch", "doc_ids", "held", "lens", "vocab", "tokens", "totals")),
                     pa.array([_zip(x) for x, _ in new], pa.binary()), pa.array([_zip(x) for _, x in new], pa.binary())], b.schema.names)

        state = stored(state.mapInArrow(add, STATE), "lm-codes")

    def finish(batches):
        nothing = {"bits": np.zeros(buckets, np.uint64), "base": np.zeros(buckets, np.int64), "on": np.zeros(0, np.uint8)}
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(name)[i].as_py() for name in b.schema.names}
                out = _scores(row, _unzip(row["totals"], np.uint64), nothing, buckets, n, v)
                yield pa.RecordBatch.from_pydict(out, pa.schema(
                    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]))

    return state.mapInArrow(finish, RESULT)
