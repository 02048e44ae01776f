"""Distinct-chunk table: tokenize each distinct chunk once, join ids back by position.

Valid when no token crosses a chunk boundary. Each Python worker keeps one
table per tokenizer, which keeps what was asked for last and at most
``max_entries`` chunks, so memory is bounded however many distinct chunks the corpus
has, and a lost worker only costs tokenizing its chunks again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TABLES: dict = {}


class Recent:
    """A bounded dictionary in two halves. What is found in the old half moves to the young one; ``turn``
    lets the old half go once the young one is full, so frequent keys stay."""

    def __init__(self, max_entries: int):
        self.half, self.young, self.old = max_entries // 2, {}, {}

    def find(self, keys: list) -> list:
        """The values of ``keys``, None for those not known."""
        out = list(map(self.young.get, keys))
        old = self.old.get
        for i, x in enumerate(out):
            if x is None:
                x = old(keys[i])
                if x is not None:
                    out[i] = self.young[keys[i]] = x
        return out

    def turn(self) -> None:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}


class ChunkTable:
    """chunk -> ids (int32 bytes), filled on demand by ``encode(list of chunks)``."""

    def __init__(self, encode: Callable, max_entries: int = 200_000):
        self.encode, self.ids = encode, Recent(max_entries)

    def lookup(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat int32 ids, offsets) of distinct ``chunks`` in their order."""
        keys = chunks.to_pylist()
        parts = self.ids.find(keys)
        missing = [i for i, p in enumerate(parts) if p is None]
        for lo in range(0, len(missing), 5_000):
            part = missing[lo:lo + 5_000]
            for i, v in zip(part, self.encode([keys[i] for i in part])):
                self.ids.young[keys[i]] = parts[i] = np.array(v, np.int32).tobytes()
        self.ids.turn()
        lens = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), np.int32)
        return flat, np.concatenate(([0], np.cumsum(lens)))


class FlatTable:
    """chunk -> ids as a column of chunks beside their flat ids, no Python object per chunk.

    ``encode(array of chunks)`` gives (flat int32 ids, how many each). Beyond ``max_entries`` the half used
    last stays, beyond ``max_bytes`` of chunks none does. The empty chunk has no ids and is always known.
    """

    def __init__(self, encode: Callable, max_entries: int = 500_000, max_bytes: int = 32 << 20):
        self.encode, self.max_entries, self.max_bytes = encode, max_entries, max_bytes
        self._start()

    def _start(self) -> None:
        self.names, self.flat, self.offs = pa.array([""]), np.zeros(0, np.int32), np.zeros(2, np.int64)
        self.used, self.clock = np.zeros(1, np.int64), 0

    def lookup(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat int32 ids, offsets) of distinct ``chunks`` in their order."""
        self.clock += 1
        at = pc.index_in(chunks, value_set=self.names)
        unknown = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        if unknown.any():
            missing = chunks.filter(pa.array(unknown))
            flat, lens = self.encode(missing)
            at[unknown] = len(self.names) + np.arange(len(missing))
            self.names = pa.concat_arrays([self.names, missing])
            self.flat = np.concatenate((self.flat, flat))
            self.offs = np.concatenate((self.offs, self.offs[-1] + np.cumsum(lens)))
            self.used = np.concatenate((self.used, np.zeros(len(missing), np.int64)))
        self.used[at] = self.clock
        out = gather(self.flat, self.offs[at], np.diff(self.offs)[at])
        self._turn()
        return out

    def _turn(self) -> None:
        if self.names.nbytes > self.max_bytes:
            self._start()
        elif len(self.names) > self.max_entries:
            order = np.argsort(-self.used[1:], kind="stable")[:self.max_entries // 2]
            keep = np.concatenate(([0], 1 + np.sort(order)))
            self.names, self.used = self.names.take(pa.array(keep)), self.used[keep]
            self.flat, self.offs = gather(self.flat, self.offs[keep], np.diff(self.offs)[keep])


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``flat[starts[i]:starts[i] + lens[i]]`` in a row, and their offsets."""
    offs = np.concatenate(([0], np.cumsum(lens)))
    # position of every id inside ``flat``, without a Python loop
    at = np.repeat(starts - offs[:-1], lens)
    at += np.arange(offs[-1])
    return flat[at], offs


def table_for(key, make: Callable[[], Callable]) -> ChunkTable:
    """The worker's table for ``key``, made on first use (a ``ChunkTable`` unless ``make`` gives a table itself)."""
    if key not in _TABLES:
        made = make()
        _TABLES[key] = made if hasattr(made, "lookup") else ChunkTable(made)
    return _TABLES[key]


def join_by_position(lists: pa.ListArray, table: ChunkTable, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) per list of chunks: its chunks' ids in order, then ``end_id``."""
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    enc = lists.flatten().dictionary_encode()
    codes = enc.indices.to_numpy()
    flat, offs = table.lookup(enc.dictionary)
    ids, total = gather(flat, offs[:-1][codes], np.diff(offs)[codes])
    doc = total[starts]
    if end_id is None:
        return ids, doc
    n = len(starts) - 1
    out = np.empty(len(ids) + n, np.int32)
    ends = doc[1:] + np.arange(n)
    body = np.ones(len(out), bool)
    body[ends] = False
    out[body], out[ends] = ids, end_id
    return out, doc + np.arange(n + 1)
