"""Suffix-array dedup by a common-prefix-aware distributed merge sort (operator 2).

Removes every byte that lies in a WINDOW-byte string which also starts earlier
(smaller id, or same document and earlier start); strings are judged on the
input and never cross documents.

Only suffixes that can matter are sorted. Every window owns one anchor, the
leftmost smallest hash among its GRAM-byte substrings, so two equal windows own
anchors at the same offset; an anchor owns a short run of windows.

1. Anchors whose gram occurs once in the corpus are dropped (an exact filter).
   A gram that repeats inside a slice is known to repeat, so the exchange gets
   one marker for it from each slice, however hot it is.
2. The suffix at each remaining anchor (up to WINDOW bytes, then the bytes to its
   left, backwards) is sorted into runs. Equal contexts of a run collapse: all
   but the first are repeats. Runs are front-coded (length of the prefix shared
   with the entry before, and the rest) and written to the shared folder.
3. Runs are cut at sampled splitters and exchanged by range of the sorted
   order, so suffixes that share a hot gram spread over tasks. A loser tree merges
   the pieces of a task: a contender keeps the length of its common prefix with
   the last output, the longer one wins, and only on equality are bytes after
   the known prefix compared.
4. In the merged order, windows of equal offset are equal if their anchors share
   WINDOW - offset bytes to the right (one stretch of the order) and offset bytes
   to the left. The first of each class stays. Classes that touch a splitter are
   settled across tasks by the window's 128-bit digest, one row per task and class.

Defined results: null texts are empty; documents shorter than WINDOW lose
nothing; a null id sorts first; rows that share an id are ordered by a hash of
their text, and rows that share id and text are one document (each of them gets
its result); overlapping repeats inside one document count; extra columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import mix64, slices, stored

WINDOW, GRAM = 100, 32
REACH = WINDOW - GRAM  # largest offset of an anchor in its window
KEY = WINDOW + REACH + 2  # right bytes, left bytes backwards, both lengths + 1
PIECE_BYTES, SLICE_BYTES = 1 << 20, 24 << 20  # hashed at a time; sent at a time
RUN_KEYS = 150_000
SAMPLE_KEYS = 20_000
NULL_ID = -(1 << 63)


def _zip(a: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a).tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


# --- anchors -------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes that start at each position (GRAM is a power of two)."""
    h, size, base = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(0x100000001B3)
    while size < GRAM:
        nxt = np.zeros_like(h)
        nxt[:-size] = h[size:]
        h = h * base + nxt
        base = base * base * np.uint64(3) + np.uint64(2)
        size *= 2
    return mix64(h)


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(hash, document row, position in it, smallest and largest offset) of each anchor in ``data``.

    ``offsets`` are the documents' bounds in the concatenated bytes.
    """
    none = [np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64, np.int64)]
    if len(data) < WINDOW:
        return none
    h, w = gram_hashes(data), REACH + 1
    low = np.uint64((1 << len(data).bit_length()) - 1)
    order = (h & ~low) | np.arange(len(data), dtype=np.uint64)  # ties: leftmost
    pad = -len(order) % w
    grid = np.concatenate([order, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, w)
    head = np.minimum.accumulate(grid, axis=1).reshape(-1)
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - WINDOW + 1
    best = (np.minimum(tail[:n], head[w - 1:w - 1 + n]) & low).astype(np.int64)
    sizes = np.diff(offsets)
    starts = np.concatenate([np.arange(lo, hi - WINDOW + 1) for lo, hi in zip(offsets[:-1][sizes >= WINDOW], offsets[1:][sizes >= WINDOW])]
                            or [np.zeros(0, np.int64)]).astype(np.int64)
    if not len(starts):
        return none
    at = best[starts]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    first, last = starts[new], starts[np.append(new[1:] - 1, len(starts) - 1)]
    pos = at[new]
    doc = np.searchsorted(offsets, pos, side="right") - 1
    return h[pos], doc, pos - offsets[doc], pos - last, pos - first


ANCHOR_COLS = ("own", "sub", "at", "lo", "hi")


def candidates(docs: DataFrame, buckets: int) -> DataFrame:
    """own, sub, at, lo, hi: anchors whose gram occurs at least twice."""

    def spread(batches):
        from pyspark import TaskContext
        turn = TaskContext.get().partitionId()
        held, size = [], 0
        for b in slices(batches, "text", PIECE_BYTES):
            text = b.column("text").cast(pa.binary())
            bounds = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
            h, doc, at, lo, hi = anchors(data, bounds - bounds[0])
            held.append((h, b.column("own").to_numpy()[doc], b.column("sub").to_numpy()[doc],
                         at.astype(np.int32), lo.astype(np.uint8), hi.astype(np.uint8)))
            size += len(data)
            if size >= SLICE_BYTES:
                turn += 1
                yield from send(held, turn)
                held, size = [], 0
        if held:
            yield from send(held, turn + 1)

    def send(held, turn):
        """Grams seen once in the slice with their anchors, a marker for the others; the others' anchors apart."""
        h, own, sub, at, lo, hi = (np.concatenate(x) for x in zip(*held))
        _, first, inverse, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        again = times[inverse] > 1
        marker = np.zeros(len(h), bool)
        marker[first[times > 1]] = True
        where = np.where(~again | marker, (h % np.uint64(buckets)).astype(np.int64), buckets)
        order = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[order], np.arange(buckets + 1))
        groups = [(0, k, order[cuts[k]:cuts[k + 1]]) for k in range(buckets)]
        for kind, k, rows in [*groups, (1, turn % buckets, np.flatnonzero(again))]:
            if len(rows):
                place = np.where(marker[rows] & (kind == 0), -1, at[rows]).astype(np.int32)
                cells = [h[rows].tobytes() if kind == 0 else b"", *(_zip(x) for x in (own[rows], sub[rows], place, lo[rows], hi[rows]))]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)],
                                                 ["bucket", "kind", "h", *ANCHOR_COLS])

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = dict(own=np.int64, sub=np.int64, at=np.int32, lo=np.uint8, hi=np.uint8)
        out = []
        for kind in (0, 1):
            part = pdf[pdf["kind"] == kind]
            if not len(part):
                continue
            cols = {c: np.concatenate([_unzip(x, k) for x in part[c]]) for c, k in kinds.items()}
            if kind == 0:
                h = np.frombuffer(b"".join(part["h"]), np.uint64)
                _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
                keep = (times[inverse] > 1) & (cols["at"] >= 0)
                cols = {c: v[keep] for c, v in cols.items()}
            out.append(pd.DataFrame(cols).astype({"lo": "int16", "hi": "int16"}))
        return pd.concat(out)

    rows = docs.mapInArrow(spread, "bucket int, kind int, h binary, own binary, sub binary, at binary, lo binary, hi binary")
    return rows.groupBy("bucket").applyInPandas(repeated, "own long, sub long, at int, lo short, hi short")


# --- sorted front-coded runs ---------------------------------------------------------

def context_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(n, KEY) bytes that order the anchors of one document."""
    n = len(data)
    key = np.zeros((len(at), KEY), np.uint8)
    right = at[:, None] + np.arange(WINDOW)[None, :]
    key[:, :WINDOW] = np.where(right < n, data[np.minimum(right, n - 1)], 0)
    left = at[:, None] - 1 - np.arange(REACH)[None, :]
    key[:, WINDOW:-2] = np.where(left >= 0, data[np.maximum(left, 0)], 0)
    key[:, -2] = np.minimum(WINDOW, n - at) + 1
    key[:, -1] = np.minimum(REACH, at) + 1
    return key


def shared_prefix(keys: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the row before (0 for the first)."""
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        differ = keys[1:] != keys[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
    return out


def front_code(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(prefix lengths, rest of every key back to back)."""
    lcp = shared_prefix(keys)
    rest = keys[np.arange(keys.shape[1])[None, :] >= lcp[:, None]]
    return lcp.astype(np.uint8), rest.tobytes()


def front_decode(lcp: np.ndarray, rest: bytes, width: int = KEY) -> np.ndarray:
    keys = np.zeros((len(lcp), width), np.uint8)
    own = np.arange(width)[None, :] >= lcp[:, None].astype(np.int64)
    keys[own] = np.frombuffer(rest, np.uint8)
    # a byte that is not the row's own comes from the last row above that has it
    last = np.maximum.accumulate(np.where(own, np.arange(len(lcp))[:, None], 0), axis=0)
    return np.take_along_axis(keys, last, axis=0)


def _text_order(own, sub, at):
    return np.lexsort((at, sub, own))


def _sorted_run(keys, own, sub, at, lo, hi):
    """(run, repeats): the run in key order without equal keys, and the entries that repeat an earlier one."""
    order = _text_order(own, sub, at)
    flat = np.ascontiguousarray(keys[order]).view(f"S{KEY}").reshape(-1)
    order = order[np.argsort(flat, kind="stable")]  # equal keys: earliest first
    first = shared_prefix(keys[order]) < KEY
    if len(first):
        first[0] = True
    keep, gone = order[first], order[~first]
    return (keys[keep], own[keep], sub[keep], at[keep], lo[keep], hi[keep]), (own[gone], sub[gone], at[gone], lo[gone], hi[gone])


RUN_COLS = ("lcp", "rest", "own", "sub", "at", "lo", "hi")
RUN_SCHEMA = "kind int, part int, lcp binary, rest binary, own binary, sub binary, at binary, lo binary, hi binary"


def _pack_run(kind, part, keys, own, sub, at, lo, hi):
    lcp, rest = front_code(keys) if keys is not None else (np.zeros(0, np.uint8), b"")
    cells = [_zip(lcp), _zip(np.frombuffer(rest, np.uint8)), *(_zip(np.asarray(x, k)) for x, k in
             ((own, np.int64), (sub, np.int64), (at, np.int32), (lo, np.uint8), (hi, np.uint8)))]
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)],
                                      ["kind", "part", *RUN_COLS])


def _unpack_run(row):
    own, sub, at, lo, hi = (_unzip(row[c], k) for c, k in (("own", np.int64), ("sub", np.int64), ("at", np.int32), ("lo", np.uint8), ("hi", np.uint8)))
    lcp = _unzip(row["lcp"], np.uint8)
    keys = front_decode(lcp, _unzip(row["rest"], np.uint8).tobytes()) if len(lcp) else np.zeros((0, KEY), np.uint8)
    return keys, own, sub, at.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64)


def sorted_runs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Kind 0: a sorted front-coded run of anchor contexts. Kind 1: anchors that repeat an earlier one of their run."""

    def run(batches):
        held, size = [], 0

        def out():
            keys, own, sub, at, lo, hi = (np.concatenate(x) for x in zip(*held))
            kept, gone = _sorted_run(keys, own, sub, at, lo, hi)
            yield _pack_run(0, 0, *kept)
            if len(gone[0]):
                yield _pack_run(1, 0, None, *gone)

        for b in batches:
            for i in range(b.num_rows):
                data = np.frombuffer(b.column("text")[i].as_buffer(), np.uint8)
                cell = b.column("found")[i].values
                at, lo, hi = (cell.field(c).to_numpy().astype(np.int64) for c in ("at", "lo", "hi"))
                n = len(at)
                held.append((context_keys(data, at), np.full(n, b.column("own")[i].as_py()), np.full(n, b.column("sub")[i].as_py()), at, lo, hi))
                size += n
                if size >= RUN_KEYS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    per_doc = found.distinct().groupBy("own", "sub").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("found"))
    # rows that repeat an id and a text are one document; the join has brought them together already
    once = docs.join(per_doc, ["own", "sub"]).dropDuplicates(["own", "sub"])
    return once.select("own", "sub", "text", "found").mapInArrow(run, RUN_SCHEMA)


def splitters(runs: DataFrame, parts: int) -> list[bytes]:
    """``parts`` - 1 keys that cut the sorted order evenly, from about SAMPLE_KEYS sampled keys."""

    def pick(batches):
        for b in batches:
            for row in b.to_pylist():
                lcp = _unzip(row["lcp"], np.uint8)
                keys = front_decode(lcp, _unzip(row["rest"], np.uint8).tobytes())[::64]
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary())], ["key"])

    drawn = runs.filter("kind = 0").select("lcp", "rest").mapInArrow(pick, "key binary")
    share = min(1.0, SAMPLE_KEYS / max(1, drawn.count()))  # so that about SAMPLE_KEYS reach the driver, from any number of runs
    few = sorted(bytes(r.key) for r in drawn.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20))).collect())
    return sorted({few[len(few) * k // parts] for k in range(1, parts)}) if few else []


# --- merge ---------------------------------------------------------------------------

def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Loser-tree merge of front-coded runs: (run of each output, common prefix with the output before).

    ``runs`` are (keys, common prefix of each key with the one before). A
    contender's known prefix is its common prefix with the last output; bytes
    inside a known prefix are never compared again.
    """
    k = len(runs)
    heads, known = [0] * k, [0 if keys else -1 for keys, _ in runs]  # -1: exhausted
    current = [keys[0] if keys else b"" for keys, _ in runs]
    size = 1
    while size < k:
        size *= 2

    def play(a, b):
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        ha, hb = known[a], known[b]
        if ha > hb:
            return a, b
        if hb > ha:
            return b, a
        if ha < 0:
            return a, b
        x, y = current[a], current[b]
        p, q = x[ha:], y[ha:]
        if p == q:
            known[b] = len(x)
            return a, b
        diff = int.from_bytes(p, "big") ^ int.from_bytes(q, "big")
        common = len(x) - (diff.bit_length() + 7) // 8
        if p < q:
            known[b] = common
            return a, b
        known[a] = common
        return b, a

    known += [-1] * (size - k)
    current += [b""] * (size - k)
    losers, level = [0] * size, list(range(size))
    base = size
    while len(level) > 1:
        base //= 2
        nxt = []
        for i in range(0, len(level), 2):
            w, loser = play(level[i], level[i + 1])
            losers[base + i // 2] = loser
            nxt.append(w)
        level = nxt
    winner, out, prefixes = level[0], [], []
    while known[winner] >= 0:
        out.append(winner)
        prefixes.append(known[winner])
        keys, lcp = runs[winner]
        heads[winner] += 1
        at = heads[winner]
        if at < len(keys):
            current[winner], known[winner] = keys[at], lcp[at]
        else:
            known[winner] = -1
        node = (winner + size) // 2
        while node:
            rival = losers[node]
            if known[rival] > known[winner]:
                losers[node], winner = winner, rival
            elif known[rival] == known[winner] and known[winner] >= 0:
                winner, losers[node] = play(winner, rival)
            node //= 2
    return out, prefixes


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows, and each one's common prefix with the row before it."""
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").reshape(-1), kind="stable")
    return order, shared_prefix(keys[order])


def repeats(keys, lcp, own, sub, at, lo, hi, low: bytes | None, high: bytes | None):
    """In merged order: (flags[row, offset] of repeated windows, list of (row, offset) to be settled across tasks).

    ``low`` and ``high`` are the splitters around the task.
    """
    n = len(keys)
    rank = np.empty(n, np.int64)
    rank[_text_order(own, sub, at)] = np.arange(n)
    by_rank = np.argsort(rank)
    left = np.zeros((n, REACH + 1), np.uint8)
    left[:, :REACH] = keys[:, WINDOW:WINDOW + REACH]
    left[:, REACH] = keys[:, -1]  # keeps real zero bytes apart from none
    lorder, llcp = _classes(left)
    edge = np.zeros(n, np.int64)
    for s in (low, high):
        if s is not None and n:
            differ = keys[:, :WINDOW] != np.frombuffer(s, np.uint8)[None, :WINDOW]
            edge = np.maximum(edge, np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW))
    flags, open_ = np.zeros((n, REACH + 1), bool), []
    for o in range(REACH + 1):
        rows = by_rank[(lo[by_rank] <= o) & (o <= hi[by_rank])]
        if not len(rows):
            continue
        right_class = np.cumsum(lcp < WINDOW - o)
        left_class = np.empty(n, np.int64)
        left_class[lorder] = np.cumsum(llcp < o)
        _, first, inverse = np.unique(right_class[rows] * np.int64(n + 1) + left_class[rows], return_index=True, return_inverse=True)
        again = first[inverse] != np.arange(len(rows))
        flags[rows[again], o] = True
        ask = rows[~again & (edge[rows] >= WINDOW - o)]
        open_ += [(int(r), o) for r in ask]
    return flags, open_


def _spans(flags, own, sub, at):
    """own, sub, s, e: byte ranges covered by the flagged windows, one per stretch of offsets."""
    f = np.zeros((len(flags), flags.shape[1] + 2), np.int8)
    f[:, 1:-1] = flags
    d = np.diff(f, axis=1)
    r, begin = np.nonzero(d == 1)
    _, end = np.nonzero(d == -1)  # offsets begin..end-1
    return pd.DataFrame({"own": own[r], "sub": sub[r], "s": at[r] - (end - 1), "e": at[r] - begin + WINDOW})


MERGED = "key binary, own long, sub long, s long, e long"


def merged(runs: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Spans of repeated windows (key null), and windows to settle across tasks (key: digest of the window)."""

    def deal(batches):
        for b in batches:
            for row in b.to_pylist():
                keys, own, sub, at, lo, hi = _unpack_run(row)
                flat = np.ascontiguousarray(keys).view(f"S{KEY}").reshape(-1)
                edges = [0, *(int(np.searchsorted(flat, np.frombuffer(c, f"S{KEY}")[0])) for c in cuts), len(keys)]
                for part, (a, z) in enumerate(zip(edges[:-1], edges[1:])):
                    if a < z:
                        yield _pack_run(0, part, keys[a:z], own[a:z], sub[a:z], at[a:z], lo[a:z], hi[a:z])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        import xxhash
        part = int(pdf["part"].iat[0])
        pieces = [_unpack_run(row) for row in pdf.to_dict("records")]
        runs_ = [([k.tobytes() for k in p[0]], shared_prefix(p[0]).tolist()) for p in pieces]
        order, prefixes = merge_runs(runs_)
        base = np.cumsum([0, *(len(p[0]) for p in pieces)])[:-1]
        order = np.array(order, np.int64)
        within = np.zeros(len(order), np.int64)
        for k in range(len(pieces)):
            m = order == k
            within[m] = np.arange(m.sum())
        rows = base[order] + within
        keys, own, sub, at, lo, hi = (np.concatenate([p[c] for p in pieces])[rows] for c in range(6))
        lcp = np.array(prefixes, np.int64)
        if len(lcp):
            lcp[0] = 0
        # equal contexts: only the earliest goes on, the others repeat it
        new = lcp < KEY
        group = np.cumsum(new) - 1
        rank = np.empty(len(rows), np.int64)
        rank[_text_order(own, sub, at)] = np.arange(len(rows))
        first = np.full(group[-1] + 1, len(rows))
        np.minimum.at(first, group, rank)
        keep = first[group] == rank
        gone = ~keep
        out = [pd.DataFrame({"own": own[gone], "sub": sub[gone], "s": at[gone] - hi[gone], "e": at[gone] - lo[gone] + WINDOW})]
        keys, own, sub, at, lo, hi = (x[keep] for x in (keys, own, sub, at, lo, hi))
        low, high = cuts[part - 1] if part else None, cuts[part] if part < len(cuts) else None
        flags, open_ = repeats(keys, lcp[new], own, sub, at, lo, hi, low, high)
        out.append(_spans(flags, own, sub, at))
        if open_:
            digest = [xxhash.xxh3_128_digest(keys[r, WINDOW:WINDOW + o][::-1].tobytes() + keys[r, :WINDOW - o].tobytes()) for r, o in open_]
            r, o = (np.array(x) for x in zip(*open_))
            out.append(pd.DataFrame({"key": digest, "own": own[r], "sub": sub[r], "s": at[r] - o, "e": at[r] - o + WINDOW}))
        return pd.concat([x if "key" in x else x.assign(key=None) for x in out])[["key", "own", "sub", "s", "e"]]

    dealt = runs.filter("kind = 0").mapInArrow(deal, RUN_SCHEMA)
    return dealt.groupBy("part").applyInPandas(merge, MERGED)


def repeated_spans(docs: DataFrame, parts: int) -> DataFrame:
    """own, sub, s, e: byte ranges to remove (they may overlap). ``docs`` has own, sub, text (bytes)."""
    found = stored(candidates(docs, parts), "anchors")
    runs = stored(sorted_runs(docs, found), "runs")
    got = stored(merged(runs, splitters(runs, parts)), "merged")

    def inside(batches):
        for b in batches:
            for row in b.to_pylist():
                own, sub, at, lo, hi = (_unzip(row[c], k).astype(np.int64) for c, k in
                                        (("own", np.int64), ("sub", np.int64), ("at", np.int32), ("lo", np.uint8), ("hi", np.uint8)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, sub, at - hi, at - lo + WINDOW)], ["own", "sub", "s", "e"])

    local = runs.filter("kind = 1").mapInArrow(inside, "own long, sub long, s long, e long")
    # windows at the splitters: at most one row per task and window, the earliest of all stays
    asked = got.filter("key is not null")
    firsts = asked.groupBy("key").agg(F.min(F.struct("own", "sub", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    late = asked.join(firsts.select("key", "first"), "key").filter(F.struct("own", "sub", "s") != F.col("first"))
    return got.filter("key is null").select("own", "sub", "s", "e").unionByName(local).unionByName(late.select("own", "sub", "s", "e"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans array<struct<s, e>> (removed, maximal, in order), kept binary: one row per row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID).cast("long")).alias("own"),
                      F.xxhash64(text).alias("sub"), text.cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = repeated_spans(src.select("own", "sub", "text"), parts)
    per_doc = spans.groupBy("own", "sub").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    def cut(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                sizes, removed, kept = [], [], []
                for cell, spans_ in zip(part.column("text"), part.column("spans").to_pylist()):
                    data = memoryview(cell.as_buffer())
                    runs: list[list[int]] = []
                    for x in sorted((x["s"], x["e"]) for x in spans_ or []):
                        if runs and x[0] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], x[1])
                        else:
                            runs.append(list(x))
                    edges = [0, *(e for r in runs for e in r), len(data)]
                    sizes.append(len(data))
                    removed.append([{"s": s, "e": e} for s, e in runs])
                    kept.append(b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()),
                                                  pa.array(removed, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                                                  pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return src.join(per_doc, ["own", "sub"], "left").select("doc_id", "text", "spans") \
        .mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<s:long,e:long>>, kept binary")


def digests(result: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return result.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                         F.sha2("kept", 256).alias("kept_sha256"))
