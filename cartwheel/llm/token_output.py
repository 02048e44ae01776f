"""Token ids in rANS-coded block files (operator 1).

Documents are tokenized in ascending id order, packed into blocks of whole
documents, and each block is entropy-coded by itself with one frequency table
that is shared by all blocks: exact counts over the whole corpus, scaled to
2**SCALE. Inside a block ``lanes`` independent coder states are interleaved
(token i belongs to lane i mod lanes), so numpy codes one step of all lanes at
a time. Every SEGMENT steps the block stores a checkpoint (all lane states and
the word position) and a crc32, so segments of a block decode independently
and in parallel, and damage is found where it is.

The file format is a Parquet folder, one row per block (columns in
``BLOCK_SCHEMA``) under ``part=N`` folders that ascend with doc_id, beside a
small folder ``table`` with the shared frequencies. Only Spark reads and writes
it, so any shared store works.

Defined results: null and empty texts hold the end id only; ids of equal rank
(repeated rows) keep any order among themselves, each with its own ids; a null
doc_id sorts first; extra columns are not read; an empty table writes no blocks.
"""

from __future__ import annotations

import codecs
import os
import string
import struct
import zlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.chunks import FlatTable, gather, join_by_position, table_for
from cartwheel.llm.common import slices, stored

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SCALE = 20
LOW = np.uint64(1 << 31)
LANES, SEGMENT = 1024, 256
BLOCK_TOKENS = 1 << 20
RAW_SCHEMA = "part int, seq long, doc_ids array<long>, lens array<int>, raw binary"
BLOCK_SCHEMA = "part int, seq long, start long, doc_ids array<long>, lens array<int>, payload binary"
DIGEST_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
PROBES = ["Word", "the,", "Merge.", "S", "tokenizers", "AND", "don,", "Éléphant.", "straße", "ñandÚ,", "Àÿ", "ªº", "µm", "***", "Ðe(%)."]
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
#: how the vocabulary spells each byte, but for the space, which parts cores
SPELT = "".join(" " if b == 32 else chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256))


def _path(tokenizer: str | None) -> str:
    if tokenizer:
        return tokenizer
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class WordTable:
    """Ids of words; white space never reaches this tokenizer's model, so words are independent chunks.

    Plain words (letters up to U+00FF, perhaps ASCII marks after them) are a core and a
    tail: normaliser and splitter do no more to them than lower-case, part the two and
    spell the bytes, which is tried first on every letter and mark. Each core, whatever
    its case and tail, goes through the library's model once, many in a call, and the
    tokens that end a word tell them apart. All others, and tails, go through the whole
    tokenizer.
    """

    def __init__(self, tokenizer: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(_path(tokenizer))
        self.rest, self.cores, self.tails = FlatTable(self._whole), FlatTable(self._merged), FlatTable(self._whole)
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for w, i in self.tok.get_vocab().items() if w.endswith(suffix)]] = True
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.marks = "".join(c for c in string.punctuation if c != "'" and not any(c in t for t in added))
        self.plain = False
        if suffix and not any(set(t) <= set(LETTERS + self.marks) for t in added):
            words = pa.array([*PROBES, *(f"{c}n{c}" for c in LETTERS), *(f"The{c}{d}" for c in self.marks for d in ("", c, "."))])
            want, lens = self._whole(words)
            flat, offs = self._parted(words)
            self.plain = np.array_equal(want, flat) and np.array_equal(lens, np.diff(offs))

    def _whole(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, how many each) by the whole tokenizer."""
        flat, lens = [np.zeros(0, np.int32)], []
        for lo in range(0, len(words), 1000):
            got = [e.ids for e in self.tok.encode_batch_fast(words[lo:lo + 1000].to_pylist(), add_special_tokens=False)]
            lens += map(len, got)
            flat.append(np.fromiter(chain.from_iterable(got), np.int32))
        return np.concatenate(flat), np.array(lens, np.int64)

    def _merged(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, how many each) by the model alone."""
        flat, lens = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(cores), 5000):
            part = cores[lo:lo + 5000]
            text = codecs.charmap_decode(" ".join(part.to_pylist()).encode(), "strict", SPELT)[0]
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(part):  # a byte the vocabulary lacks
                ids, n = self._whole(part)
            else:
                n = np.diff(ends, prepend=-1)
            flat.append(ids)
            lens.append(n)
        return np.concatenate(flat), np.concatenate(lens)

    def _parted(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        core, tail = pc.utf8_rtrim(words, self.marks), pc.utf8_ltrim(words, LETTERS)
        size = [pc.binary_length(x).to_numpy() for x in (words, core, tail)]
        other = pa.array(size[1] + size[2] != size[0])  # not letters, then marks
        core, tail = (pc.if_else(other, "", x).dictionary_encode() for x in (pc.utf8_lower(core), tail))
        tables = [self.cores.lookup(core.dictionary), self.tails.lookup(tail.dictionary)]
        rest = words.filter(other)
        if len(rest):
            tables.append(self.rest.lookup(rest))
        # two pieces a word: its core, or all of it, and its tail
        first = core.indices.to_numpy().astype(np.int64)
        second = tail.indices.to_numpy() + len(core.dictionary)
        first[other.to_numpy(zero_copy_only=False)] = len(core.dictionary) + len(tail.dictionary) + np.arange(len(rest))
        piece = np.stack((first, second), 1).ravel()
        base = np.cumsum([0, *(len(f) for f, _ in tables)])
        starts = np.concatenate([o[:-1] + b for (_, o), b in zip(tables, base)])
        lens = np.concatenate([np.diff(o) for _, o in tables])
        flat, offs = gather(np.concatenate([f for f, _ in tables]), starts[piece], lens[piece])
        return flat, offs[::2]

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat int32 ids, offsets) of distinct ``words`` in their order."""
        return self._parted(words) if self.plain else self.rest.lookup(words)


# --- range asymmetric numeral system -------------------------------------------------

def scaled_frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to sum 2**scale, at least 1 for every symbol that occurs."""
    total, out = counts.sum(), np.zeros(len(counts), np.int64)
    if not total:
        return out
    if np.count_nonzero(counts) > 1 << scale:
        raise ValueError("more symbols than slots: raise the scale")
    out = np.where(counts > 0, np.maximum(1, counts * (1 << scale) // total), 0)
    over = int(out.sum()) - (1 << scale)
    order = np.argsort(-out, kind="stable")
    while over:  # spread the rounding over the commonest symbols, in proportion
        room = out[order] - 1 if over > 0 else np.maximum(out[order], 1)
        step = np.minimum(room, np.maximum(1, abs(over) * room // max(1, room.sum()))) if over > 0 else np.maximum(1, abs(over) * room // room.sum()) * (out[order] > 0)
        step = np.where(np.cumsum(step) <= abs(over), step, np.maximum(0, abs(over) - (np.cumsum(step) - step)))
        out[order] -= np.sign(over) * step
        over -= int(np.sign(over) * step.sum())
    return out


def encode_block(ids: np.ndarray, freq: np.ndarray, scale: int = SCALE) -> bytes:
    """One self-contained block: header, checkpoints, crc32 per segment, words."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    segments = max(1, -(-steps // SEGMENT))
    cum = np.concatenate(([0], np.cumsum(freq)))[:-1].astype(np.uint64)
    f64 = freq.astype(np.uint64)
    padded = np.zeros(steps * lanes, np.int64)
    padded[:n] = ids
    grid = padded.reshape(steps, lanes)
    state = np.full(lanes, LOW)
    shift, limit_shift = np.uint64(scale), np.uint64(31 - scale + 32)
    words: list[np.ndarray] = []
    written = 0
    points = []
    for step in range(steps - 1, -1, -1):
        live = lanes if (step + 1) * lanes <= n else n - step * lanes
        sym = grid[step, :live]
        x, f = state[:live], f64[sym]
        full = x >= f << limit_shift
        if full.any():
            # the decoder reads lanes in ascending order, and words from the end of what is written
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[::-1])
            written += len(words[-1])
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[:live] = (q << shift) + (x - q * f) + cum[sym]
        if step % SEGMENT == 0:
            points.append((written, state.copy()))
    points.reverse()
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
    head = struct.pack("<4sIIIIII", b"RANS", n, lanes, SEGMENT, segments, scale, written)
    body = [head]
    for k, (upto, states) in enumerate(points):
        piece = ids[k * SEGMENT * lanes:(k + 1) * SEGMENT * lanes].astype("<u4")
        body += [struct.pack("<II", written - upto, zlib.crc32(piece.tobytes())), states.astype("<u8").tobytes()]
    return b"".join([*body, stream.astype("<u4").tobytes()])


def decode_block(block: bytes, freq: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """All ids of a block; its segments are decoded side by side and checked."""
    magic, n, lanes, segment, segments, scale, count = struct.unpack_from("<4sIIIIII", block)
    if magic != b"RANS":
        raise ValueError("not a block of this format")
    if not n:
        return np.zeros(0, np.int64)
    at, size = struct.calcsize("<4sIIIIII"), 8 + 8 * lanes
    meta = np.frombuffer(block, "<u4", 2 * segments + 2 * lanes * segments, at).reshape(segments, 2 + 2 * lanes)
    pos, crcs = meta[:, 0].astype(np.int64), meta[:, 1]
    x = np.ascontiguousarray(meta[:, 2:]).view("<u8").astype(np.uint64)
    stream = np.frombuffer(block, "<u4", count, at + size * segments).astype(np.uint64)
    cum = np.concatenate(([0], np.cumsum(freq)))[:-1].astype(np.uint64)
    f64 = freq.astype(np.uint64)
    mask, shift = np.uint64((1 << scale) - 1), np.uint64(scale)
    steps = -(-n // lanes)
    out = np.zeros((segments, segment, lanes), np.int64)
    place = np.arange(segments)[:, None] * segment * lanes + np.arange(lanes)[None, :]
    for step in range(min(segment, steps)):
        live = place + step * lanes < n
        slot = x & mask
        sym = slots[slot]
        y = f64[sym] * (x >> shift) + slot - cum[sym]
        need = (y < LOW) & live
        rank = np.cumsum(need, axis=1)
        take = (pos[:, None] + rank - 1)[need]
        y[need] = (y[need] << np.uint64(32)) | stream[take]
        pos += rank[:, -1]
        x = np.where(live, y, x)
        out[:, step, :] = sym
    ids = out.reshape(-1)[:n]
    for k in range(segments):
        piece = ids[k * segment * lanes:(k + 1) * segment * lanes].astype("<u4")
        if zlib.crc32(piece.tobytes()) != crcs[k]:
            raise ValueError(f"checksum of segment {k} differs")
    return ids


# --- tables of blocks ----------------------------------------------------------------

def _pack(ids: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
             end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole documents in ascending id order, ids not yet entropy-coded (``RAW_SCHEMA``)."""

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        table = table_for(("tokenizers", _path(tokenizer)), lambda: WordTable(tokenizer))
        held, names, lens, seq = [], [], [], 0

        def block():
            ids = np.concatenate(held) if held else np.zeros(0, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([lens], pa.list_(pa.int32())), pa.array([_pack(ids)], pa.binary())],
                ["part", "seq", "doc_ids", "lens", "raw"])

        for b in slices(batches, "text", 8 << 20):
            lists = pc.ascii_split_whitespace(pc.fill_null(b.column("text"), "").cast(pa.string()))
            ids, offs = join_by_position(lists, table, end_id)
            cuts = np.flatnonzero(np.diff(offs[:-1] // block_tokens)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                held.append(ids[offs[lo]:offs[hi]])
                names += b.column("doc_id").slice(lo, hi - lo).to_pylist()
                lens += np.diff(offs[lo:hi + 1]).tolist()
                if sum(map(len, held)) >= block_tokens:
                    yield block()
                    held, names, lens, seq = [], [], [], seq + 1
        if names:
            yield block()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return ordered.mapInArrow(run, RAW_SCHEMA)


def symbol_counts(raw: DataFrame) -> np.ndarray:
    """Exact counts of every id over all blocks; reaches the driver as one row per vocabulary entry."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for cell in b.column("raw").to_pylist():
                c = np.bincount(_unpack(cell))
                if len(c) > len(total):
                    total, c = c, total
                total[:len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    rows = raw.select("raw").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def write_token_files(docs: DataFrame, path: str, **options) -> None:
    """Tokenize ``docs`` and write the block files below ``path``."""
    spark = docs.sparkSession
    raw = stored(tokenize(docs, **options), "token-ids")
    freq = scaled_frequencies(symbol_counts(raw))
    spark.createDataFrame([(SCALE, freq.tolist())], "scale int, freq array<long>").write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)  # one entry per vocabulary id

    def run(batches):
        f = shared.value
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                payload = encode_block(_unpack(row.column("raw")[0].as_py()), f)
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("part", "seq", "start", "doc_ids", "lens")),
                                                  pa.array([payload], pa.binary())],
                                                 ["part", "seq", "start", "doc_ids", "lens", "payload"])

    sizes = raw.select("part", "seq", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    per_part = sizes.groupBy("part").agg(F.sum("n").alias("m"))
    before = per_part.select("part", (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("before"))
    starts = sizes.join(before, "part").select(
        "part", "seq", (F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n")).alias("start"))
    # the starts are a few numbers per block: put next to the blocks by (part, seq)
    blocks = raw.join(F.broadcast(starts) if starts_fit(spark, raw) else starts, ["part", "seq"])
    blocks.select("part", "seq", "start", "doc_ids", "lens", "raw").mapInArrow(run, BLOCK_SCHEMA) \
        .write.partitionBy("part").parquet(f"{path}/blocks")


def starts_fit(spark: SparkSession, raw: DataFrame, limit: int = 100_000) -> bool:
    """True if there are at most ``limit`` blocks (24 bytes each), so their starts may be broadcast."""
    return raw.count() <= limit


def _decoded(spark: SparkSession, path: str, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``each`` of the decoded documents, up to 2000 at a time, in the worker that decodes them."""
    scale, freq = spark.read.parquet(f"{path}/table").first()
    shared = spark.sparkContext.broadcast(np.asarray(freq, np.int64))

    def run(batches):
        f = shared.value
        slots = np.repeat(np.arange(len(f)), f)
        for b in batches:
            for i in range(b.num_rows):
                ids = decode_block(b.column("payload")[i].as_py(), f, slots).astype(np.int32)
                lens = np.asarray(b.column("lens")[i].as_py(), np.int64)
                offs = np.concatenate(([0], np.cumsum(lens)))
                for lo in range(0, len(lens), 2000):
                    hi = min(len(lens), lo + 2000)
                    yield each(pa.RecordBatch.from_arrays(
                        [b.column("doc_ids")[i].values.slice(lo, hi - lo),
                         pa.array(b.column("start")[i].as_py() + offs[lo:hi], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(offs[lo:hi + 1] - offs[lo], pa.int32()),
                                                  pa.array(ids[offs[lo]:offs[hi]]))],
                        ["doc_id", "start", "ids"]))

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return blocks.select("start", "doc_ids", "lens", "payload").mapInArrow(run, schema)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids array<int>, one row per document, decoded from the block files."""
    return _decoded(spark, path, lambda b: b, "doc_id long, start long, ids array<int>")


def _digest(b: pa.RecordBatch) -> pa.RecordBatch:
    ids = b.column("ids")
    flat, offs = ids.flatten().to_numpy().astype("<u4"), ids.offsets.to_numpy()
    offs = offs - offs[0]
    data = memoryview(flat.tobytes())
    crc = [zlib.crc32(data[4 * lo:4 * hi]) for lo, hi in zip(offs[:-1], offs[1:])]
    return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(offs), pa.int64()),
                                       pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(decoded: DataFrame) -> DataFrame:
    """The contract's columns: crc32 of each document's ids as little-endian 32-bit integers."""
    return decoded.mapInArrow(lambda batches: map(_digest, batches), DIGEST_SCHEMA)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``digests`` of ``read_token_files``: ids go no further than the worker that decodes them."""
    return _decoded(spark, path, _digest, DIGEST_SCHEMA)
