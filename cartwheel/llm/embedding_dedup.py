"""Embedding near-dedup with spherical-cap filters (operator 6).

Vectors are scaled to unit length and turned by a seeded rotation. The filter
directions are a structured random product code: the axes are cut into BLOCKS
blocks, each block has ``codes`` random directions of its own, and a filter is
one choice per block, so codes**BLOCKS directions need only BLOCKS * codes inner
products. A vector belongs to every filter whose direction exceeds the cap's
height; they are listed by list decoding (partial sums over the blocks that
cannot reach the height any more are dropped). Vectors are joined on filters
and every pair of a filter is verified in double precision.

The number of codes follows the number of vectors, so that a filter holds a few
vectors at any size. The height follows the number of filters; a vector that is
in fewer than LIST filters is decoded again with a lower height of its own, so
every vector is in LIST filters at least. ``recall`` measures against brute force.

Equal vectors form one class first, searched once. A filter with many classes
is dealt out as blocks of BLOCK_ROWS against BLOCK_ROWS, so no task gets a whole
hot filter.

Links: cosine >= threshold in double precision, components by star rounds.

Defined results: null, zero or empty vectors and vectors with null or non-finite
components link with nothing and are their own component; vectors of different
lengths are never compared; repeated rows are one vector (one result row, no
link with themselves) when their id is the same, and link when ids differ; a
null id counts as the smallest id; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored
from cartwheel.llm.components import components

THRESHOLD = 0.95
BLOCKS = 4
LIST = 20
BLOCK_ROWS = 1000
SEED = 20


def _codes_for(n: int) -> int:
    """Codes per block: about 16 filters a vector."""
    return max(4, math.ceil((16 * max(1, n)) ** (1 / BLOCKS)))


def _height(codes: int, dim: int, listed: int) -> float:
    """Cap height at which a random unit vector is in about ``listed`` filters."""
    share = min(0.5, listed / codes ** BLOCKS)
    lo, hi = 0.0, 10.0
    for _ in range(60):  # tail of the normal distribution that an inner product follows
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 0.5 * math.erfc(mid / math.sqrt(2)) > share else (lo, mid)
    return lo / math.sqrt(dim)


def _directions(dim: int, codes: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rotation, per block its code directions scaled so that a filter has unit length)."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    out = []
    for cols in np.array_split(np.arange(dim), min(BLOCKS, dim)):
        d = rng.standard_normal((codes, len(cols)))
        d /= np.linalg.norm(d, axis=1, keepdims=True)
        out.append(d * math.sqrt(len(cols) / dim))
    return rotation, out


def list_decode_at_least(x: np.ndarray, rotation, directions, height: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) with ``least`` filters a row or more (all there are, if fewer): the height falls where needed."""
    least = min(least, math.prod(len(d) for d in directions))
    todo, rows, codes = np.arange(len(x)), [], []
    while len(todo):
        row, code = list_decode(x[todo], rotation, directions, height)
        enough = np.bincount(row, minlength=len(todo)) >= least
        rows.append(todo[row[enough[row]]])
        codes.append(code[enough[row]])
        todo = todo[~enough]
        height -= 0.07 * abs(height) + 1e-3
    return np.concatenate(rows or [todo]), np.concatenate(codes or [todo])


def list_decode(x: np.ndarray, rotation: np.ndarray, directions: list[np.ndarray], height: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter whose inner product with the unit row exceeds ``height``."""
    codes = len(directions[0])
    y, at, parts = x @ rotation, 0, []
    for d in directions:
        parts.append(y[:, at:at + d.shape[1]] @ d.T)
        at += d.shape[1]
    best = [p.max(axis=1) for p in parts]
    rest = [sum(best[k + 1:]) if k + 1 < len(best) else np.zeros(len(x)) for k in range(len(best))]
    row, code, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
    for k, p in enumerate(parts):
        sums = total[:, None] + p[row]
        i, c = np.nonzero(sums + rest[k][row][:, None] > height)
        row, code, total = row[i], code[i] * codes + c, sums[i, c]
    return row, code


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, ok, dim, key (128 bits of the components), raw (their bytes, as exact as the column)."""
    kind = np.float32 if "float" in table.schema[vec_col].dataType.simpleString() else np.float64

    def run(batches):
        import xxhash
        for b in batches:
            ids, ok, dims, keys, raws = b.column("id"), [], [], [], []
            for cell in b.column("vec"):
                v = cell.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0 if cell.is_valid else np.zeros(0)
                good = bool(len(v)) and bool(np.isfinite(v).all()) and bool(v.any())
                raw = v.astype(kind).tobytes() if good else None
                ok.append(good)
                dims.append(len(v))
                keys.append(xxhash.xxh3_128_digest(raw) if good else None)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([ids, pa.array(ok), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()),
                                              pa.array(raws, pa.binary())], ["id", "ok", "dim", "key", "raw"])

    src = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return src.mapInArrow(run, "id long, ok boolean, dim int, key binary, raw binary")


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    kind = np.float32 if len(raw[0]) == 4 * dim else np.float64
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filters(classes: DataFrame, codes: int, listed: int, seed: int) -> DataFrame:
    """key, f (filter of the class's dimension), raw: one row per class and exceeding filter."""

    def run(batches):
        known: dict = {}
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims):
                    if dim not in known:
                        known[dim] = (*_directions(int(dim), codes, seed), _height(codes, int(dim), listed))
                    sub = part.take(pa.array(np.flatnonzero(dims == dim)))
                    x = _units(sub.column("raw").to_pylist(), int(dim))
                    row, code = list_decode_at_least(x, *known[dim], listed)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [sub.column("key").take(at), pa.array(code * 65536 + dim, pa.int64()), sub.column("raw").take(at)], ["key", "f", "raw"])

    return classes.select("key", "dim", "raw").mapInArrow(run, "key binary, f long, raw binary")


def _dealt(rows: DataFrame) -> DataFrame:
    """rows with the block pairs of their filter: (f, i, j, side), where block i meets block j >= i."""
    n = rows.groupBy("f").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select("f", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("g"))
    got = rows.join(n, "f").withColumn("own", F.pmod(F.xxhash64("key"), F.col("g")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o")
    return got.select("f", "key", "raw", "own", other).select(
        "f", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), F.col("own"), "key", "raw")


def _pairs_of(x: np.ndarray, own: np.ndarray, starts: np.ndarray, same: np.ndarray, threshold: float):
    """(row, row) of the pairs that pass, inside groups of rows ``starts[k]:starts[k+1]``.

    In a group with ``same`` every pair counts, else only pairs of different ``own``.
    """
    out = []
    sizes = np.diff(starts)
    small = same & (sizes <= 32)
    last = np.repeat(np.where(small, starts[1:], 0), sizes)  # end of the row's group, 0: not small
    at = np.flatnonzero(last)
    step = 1
    while True:
        at = at[at + step < last[at]]
        if not len(at):
            break
        hit = np.einsum("ij,ij->i", x[at], x[at + step]) >= threshold
        out.append(np.stack([at[hit], at[hit] + step]))
        step += 1
    for k in np.flatnonzero(~small & (sizes > 1)):
        rows = np.arange(starts[k], starts[k + 1])
        left, right = (rows, rows) if same[k] else (rows[own[rows] == own[rows].min()], rows[own[rows] == own[rows].max()])
        for lo in range(0, len(left), 256):
            i, j = np.nonzero(x[left[lo:lo + 256]] @ x[right].T >= threshold)
            p, q = left[lo + i], right[j]
            keep = p < q if same[k] else p != q
            out.append(np.stack([p[keep], q[keep]]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def verified_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """a, b (keys, a < b): the pairs of a filter whose cosine reaches the threshold."""

    def groups(batches):
        """Tables of whole groups (sorted by f, i, j): the open group waits for the next batch."""
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None and held.num_rows else t
            ids = np.stack([t.column(c).to_numpy() for c in ("f", "i", "j")])
            cut = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            if not len(cut):
                held = t
                continue
            yield t.slice(0, cut[-1]), np.concatenate(([0], cut))
            held = t.slice(cut[-1])
        if held is not None and held.num_rows:
            yield held, np.array([0, held.num_rows])

    def run(batches):
        for t, starts in groups(batches):
            keys, raws, own = t.column("key").to_pylist(), t.column("raw").to_pylist(), t.column("own").to_numpy()
            first = starts[:-1]
            same = t.column("i").to_numpy()[first] == t.column("j").to_numpy()[first]
            dims = t.column("f").to_numpy()[first] % 65536  # a filter holds one dimension
            for dim in np.unique(dims):
                mine = dims == dim
                size = np.where(mine, np.diff(starts), 0)
                rows_ = np.flatnonzero(np.repeat(mine, np.diff(starts)))
                x = _units([raws[r] for r in rows_], int(dim))
                at = np.concatenate(([0], np.cumsum(size[mine])))
                i, j = _pairs_of(x, own[rows_], at, same[mine], threshold)
                pairs = {(min(p, q), max(p, q)) for p, q in ((keys[a], keys[b]) for a, b in zip(rows_[i], rows_[j]))}
                if pairs:
                    a, b = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    dealt = _dealt(rows)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "f", "i", "j").sortWithinPartitions("f", "i", "j").mapInArrow(run, "a binary, b binary").distinct()


def links(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
          listed: int = LIST, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    all_ = stored(vectors(table, id_col, vec_col).dropDuplicates(["id", "ok", "key"]), "vectors")
    null_id = F.lit(-(1 << 63)).cast("long")
    named = all_.withColumn("own", F.coalesce("id", null_id))
    cls = stored(named.filter("ok").groupBy("key", "dim").agg(F.min("own").alias("rep"), F.count(F.lit(1)).alias("m"),
                                                              F.any_value("raw").alias("raw")), "classes")
    n = cls.count()
    pairs = stored(verified_pairs(filters(cls, _codes_for(n), listed, seed), threshold), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    info = cls.select("key", "rep", "m")
    near = both.join(info.select(F.col("key").alias("b"), "m"), "b").groupBy("a").agg(F.sum("m").alias("near"))
    # nodes are the vectors themselves: an id, or none, may stand for several
    comp = components(pairs.select("a", "b")).select(F.col("id").alias("key"), F.col("component").alias("node"))
    member = info.join(comp, "key", "left").select("key", "rep", "m", F.coalesce("node", "key").alias("node"))
    lowest = member.groupBy("node").agg(F.min("rep").alias("component"))
    known = member.join(lowest, "node").join(near, F.col("key") == F.col("a"), "left").select(
        "key", (F.col("m") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component")
    got = named.join(known, "key", "left")
    component = F.coalesce("component", "own")
    return got.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(component != null_id, component).alias("component_id"), (component == F.col("own")).alias("kept"))


def recall(vectors_: np.ndarray, found: set, threshold: float = THRESHOLD) -> float:
    """Share of the brute-force pairs (row numbers, smaller first) that ``found`` holds."""
    x = vectors_ / np.linalg.norm(vectors_, axis=1, keepdims=True)
    true = {(int(i), int(j)) for i, j in zip(*np.nonzero(x @ x.T >= threshold)) if i < j}
    return len(true & found) / len(true) if true else 1.0
