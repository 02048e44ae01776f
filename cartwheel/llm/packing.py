"""Hierarchical packing of token ids into windows of several context sizes (operator 12).

A document's ids are cut at each multiple of the longest context: those pieces fill
windows of their own. What is left of it, its remainder, goes by its length to the
tier of the smallest context that holds it, and each tier is packed best fit first:
a window opened by a remainder takes the longest shorter ones that still fit, which
come from the same or a shorter tier. Gaps that no whole remainder fills are filled
with cut ones: the emptiest windows of the shortest tiers are dissolved into a
stream, which runs through the gaps of all others. So every window is exactly as long
as its context, but for one at most, which is padded.

All of this depends on lengths only. A remainder's length is below the longest
context, so the plan is made on the driver from that many counts, whatever the corpus
size, and has a few thousand entries: ranges of equal windows, in which the n-th
remainder of a length has its place by arithmetic. Documents find their number by a
count within their task and a running sum over (length, task); ids are shuffled once.

Step groups take an equal share of each tier, so that steps are alike in tokens and
in context sizes.

Defined results: null and empty texts hold the end id only and are packed like any
other; rows of equal id are documents of their own; a null id is carried through; an
empty table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import slices, stored

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
#: context sizes of the tiers; a power of two needs no padding
CONTEXTS = (256, 512, 1024, 2048)
STEP_TOKENS = 64 * 2048
_MODELS: dict = {}
_PROBES = ["It's  a test,\n\nisn't it? 12 of 1,000 — naïve ça ß\t…   ", "<|endoftext|>x", "don't  won't\r\n", "日本語 текст 🙂 x́"]


# --- token ids -----------------------------------------------------------------------
def _path(tokenizer: str | None) -> str:
    if tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_ranks(path: str) -> tuple[dict, dict]:
    """(ranks of byte strings, special tokens) of a byte-level vocabulary whose ids ascend with its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    as_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return {bytes(as_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}, special


def _encoder(path: str):
    """text -> ids as the tokenizers library gives them.

    A byte-level vocabulary is run by tiktoken, which takes a third of the time, if
    both agree on a few probes; else the tokenizers library does it.
    """
    if path not in _MODELS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        slow = lambda text: tok.encode(text, add_special_tokens=False).ids
        _MODELS[path] = slow
        try:
            import public_tokenizers
            import tiktoken

            ranks, special = _byte_ranks(path)
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            fast = lambda text: own.encode(text, allowed_special="all")
            if [fast(p) for p in _PROBES] == [slow(p) for p in _PROBES]:
                _MODELS[path] = fast
        except (ImportError, KeyError, ValueError):
            pass
    return _MODELS[path]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
             end_id: int = END_ID, longest: int = CONTEXTS[-1]) -> DataFrame:
    """One row per document: its ids (packed), how many, and its place among those of equal remainder in its task.

    ``part`` is the task, ``rest`` the remainder's length, ``place`` the documents
    of equal (part, rest) before it and ``full_before`` their full windows.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part int, rest int, place long, full_before long, n long, raw binary"

    def run(batches):
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), _encoder(_path(tokenizer))
        places, fulls = [0] * longest, [0] * longest  # bounded by the context
        for b in slices(batches, "text", 4 << 20):
            rows = []
            for text in b.column("text").to_pylist():
                ids = np.array([*encode(text), end_id] if text else [end_id], np.uint32)
                full, rest = divmod(len(ids), longest)
                rows.append((part, rest, places[rest], fulls[rest], len(ids), _pack(ids)))
                places[rest] += 1
                fulls[rest] += full
            cols = zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in cols)],
                                             ["doc_id", "part", "rest", "place", "full_before", "n", "raw"])

    return src.mapInArrow(run, schema)


def _pack(ids: np.ndarray) -> bytes:
    import zstandard

    narrow = ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids.astype("<u4")
    return bytes([narrow.itemsize]) + zstandard.ZstdCompressor(1).compress(narrow.tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), f"<u{raw[0]}").astype("<u4")


# --- the plan --------------------------------------------------------------------------
class Plan:
    """Where the n-th remainder of each length goes; made from ``counts[length]`` alone.

    ``slots`` are ranges of remainders (length, first number) with their windows,
    ``gaps`` ranges of equal gaps in the order in which the stream fills them.
    """

    def __init__(self, counts, full: int, contexts=CONTEXTS, step_tokens: int = STEP_TOKENS):
        self.longest = contexts[-1]
        windows = self._best_fit([int(c) for c in counts], contexts)
        kept, gone, spare = self._dissolve(windows)
        tail = []
        for c in reversed(contexts):
            n, spare = divmod(spare, c)
            tail += [(c, 0, n, [])] * bool(n)
        padded = (self.longest, 0, 1, []) if spare else None
        # sequence ids ascend tier by tier from the longest, full documents' windows first
        placed = sorted([*kept, *tail, *[padded] * bool(padded)], key=lambda w: -w[0])
        self.total = full + sum(n for _, _, n, _ in placed)
        slots, gaps, at, tiers = [], [], full, {self.longest: [0, full]}
        for window in placed:
            context, used, n, items = window
            first = tiers.setdefault(context, [at, 0])
            first[1] += n
            for length, number, offset in items:
                slots.append((length, number, at, offset, 0, 0))
            if used < context:
                gaps.append((window is padded, at, used, context - used, n))
            at += n
        gaps = [g[1:] for g in sorted(gaps, key=lambda g: g[0])]  # the padded window takes what is left
        stream = 0
        for _, used, n, items in gone:
            for length, number, offset in items:
                slots.append((length, number, stream, offset, used, 1))
            stream += n * used
        slots.sort()
        self.slot_keys = np.array([(s[0] << 48) + s[1] for s in slots], np.int64)
        self.slots = slots
        self.gaps = gaps
        self.gap_from = np.concatenate(([0], np.cumsum([g[2] * g[3] for g in gaps], dtype=np.int64))).astype(np.int64)
        tokens = full * self.longest + sum(int(c) * k for k, c in enumerate(counts))
        self.steps = max(1, tokens // step_tokens)
        self.tiers = sorted((first, n, context) for context, (first, n) in tiers.items())

    @staticmethod
    def _best_fit(left: list[int], contexts) -> list[tuple]:
        """(context, used, windows, [(length, first number, offset)]): ranges of windows packed alike."""
        taken = [0] * len(left)
        available = sorted(k for k, c in enumerate(left) if k and c)
        out = []
        while available:
            length = available[-1]
            context = next(c for c in contexts if c >= length)
            work = [(-(-left[length] // (context // length)), 0, [])]
            while work:
                n, used, items = work.pop()
                fits = _last(available, context - used)
                if fits is None:
                    out.append((context, used, n, items))
                    continue
                m = min(n, left[fits])
                if m < n:  # this length ends here: the other windows look for another one
                    work.append((n - m, used, [(a, b + m, c) for a, b, c in items]))
                work.append((m, used + fits, [*items, (fits, taken[fits], used)]))
                left[fits] -= m
                taken[fits] += m
                if not left[fits]:
                    available.remove(fits)
        return [w for w in out if w[1]]

    @staticmethod
    def _dissolve(windows: list[tuple]) -> tuple[list, list, int]:
        """(windows that stay, windows whose remainders fill their gaps, tokens beyond those gaps)."""
        order = sorted(windows, key=lambda w: (w[0] > w[1], -w[0], -w[1]))
        supply = sum(u * n for _, u, n, _ in order)
        need, kept, gone = 0, [], []
        for context, used, n, items in order:
            stay = n if used == context else max(0, min(n, (supply - need) // context)) if not gone else 0
            need, supply = need + stay * (context - used), supply - stay * used
            if stay:
                kept.append((context, used, stay, items))
            if stay < n:
                gone.append((context, used, n - stay, [(a, b + stay, c) for a, b, c in items]))
        return kept, gone, supply - need

    def places(self, length: int, number: int):
        """(sequence, offset, tokens) for each piece of the ``number``-th remainder of ``length``."""
        k = int(np.searchsorted(self.slot_keys, (length << 48) + number, "right")) - 1
        _, first, base, offset, used, cut = self.slots[k]
        if not cut:
            return [(base + number - first, offset, length)]
        at, out = base + (number - first) * used + offset, []
        while length:
            g = int(np.searchsorted(self.gap_from, at, "right")) - 1
            sequence, start, gap, _ = self.gaps[g]
            window, inside = divmod(at - int(self.gap_from[g]), gap)
            m = min(gap - inside, length)
            out.append((sequence + window, start + inside, m))
            at, length = at + m, length - m
        return out

    def tier_and_step(self, sequence: int) -> tuple[int, int]:
        first, n, context = next(t for t in reversed(self.tiers) if t[0] <= sequence and t[1])
        return context, (sequence - first) * self.steps // n


def _last(ascending: list[int], limit: int):
    import bisect

    k = bisect.bisect_right(ascending, limit)
    return ascending[k - 1] if k else None


# --- pieces ------------------------------------------------------------------------------
def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
         contexts=CONTEXTS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, context, step, ids.

    ``ids`` are little-endian 32-bit integers; a sequence is its pieces by offset.
    """
    spark, longest = docs.sparkSession, contexts[-1]
    tokens = stored(tokenize(docs, id_col, text_col, tokenizer, end_id, longest), "packing-ids")
    counts = tokens.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n") / longest)).alias("full"))
    counts = stored(counts, "packing-counts")
    by_rest = {r.rest: r for r in counts.groupBy("rest").agg(F.sum("docs").alias("docs"), F.sum("full").alias("full")).collect()}
    lengths = [by_rest[k].docs if k in by_rest else 0 for k in range(longest)]
    fulls = [by_rest[k].full if k in by_rest else 0 for k in range(longest)]
    shared = spark.sparkContext.broadcast((Plan([0, *lengths[1:]], sum(fulls), contexts, step_tokens), np.cumsum([0, *fulls]).tolist()))

    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "rest", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
                           F.coalesce(F.sum("full").over(before), F.lit(0)).alias("fulls_before"))
    numbered = tokens.join(starts, ["part", "rest"]).select(
        "doc_id", "rest", "n", (F.col("place") + F.col("docs_before")).alias("number"),
        (F.col("full_before") + F.col("fulls_before")).alias("full"), "raw")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, context int, step long, "
              "ids binary")

    def run(batches):
        plan, full_base = shared.value
        long, names = pa.int64(), [x.split()[0] for x in schema.split(", ")]
        for b in slices(batches, "raw", 2 << 20):
            rows = []
            for doc, rest, n, number, full, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "rest", "n", "number", "full", "raw"))):
                ids = _unpack(raw)
                pieces = [(full_base[rest] + full + k, 0, longest) for k in range(n // longest)]
                pieces += plan.places(rest, number) if rest else []
                start = 0
                for sequence, offset, m in pieces:
                    rows.append((doc, start, m, n, sequence, offset, *plan.tier_and_step(sequence), ids[start:start + m].tobytes()))
                    start += m
                if len(rows) > 2000:
                    yield _batch(rows, names, b.schema.field("doc_id").type, long)
                    rows = []
            if rows:
                yield _batch(rows, names, b.schema.field("doc_id").type, long)

    return numbered.mapInArrow(run, schema)


def _batch(rows, names, kind, long):
    types = [kind, long, long, long, long, long, pa.int32(), long, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def digests(pieces: DataFrame) -> DataFrame:
    """The contract's columns; the crc32 is Spark's own."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "context", "step")
