"""SentencePiece encoding and decoding by a distinct-chunk table (operator 10).

White space is marked with U+2581 and no piece of the model holds a marker
after another character, so merges never cross from a word into the next
marker. A text is therefore a row of marked words; each distinct one is
segmented once per table and its ids are joined back by position.

Defined results: null and empty texts encode to the end id alone and decode to
the empty text; runs of spaces, leading and trailing spaces belong to the next
marked word (or stand alone at the end); a literal U+2581 in the text counts
as a space, as the library treats it; repeated rows give repeated results; a
null id is carried through. Only the two named columns are read, so extra or
clashing columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.chunks import join_by_position, table_for
from cartwheel.llm.common import slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_MODELS: dict = {}


def _path(model: str | None) -> str:
    if model:
        return model
    import public_tokenizers
    return public_tokenizers.path(MODEL)


def _processor(model: str | None):
    path = _path(model)
    if path not in _MODELS:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        crossing = [i for i in range(sp.get_piece_size()) if MARK in sp.id_to_piece(i).lstrip(MARK)]
        if crossing:
            raise ValueError("a piece crosses a white-space marker: the distinct-chunk table does not apply")
        _MODELS[path] = sp
    return _MODELS[path]


def _chunk_encoder(model: str | None):
    sp = _processor(model)
    lone = [sp.piece_to_id(MARK)]

    def encode(chunks):
        # the library puts one marker before its input, which is the chunk's own first marker
        return [ids if c else lone for c, ids in zip(chunks, sp.encode(chunks, num_threads=1))]

    return encode


def marked_words(text: str) -> list[str]:
    """Chunks of a text without the first marker of each: spaces join the word after them."""
    if not text:
        return []
    out, held = [], 0
    items = text.replace(MARK, " ").split(" ")
    for item in items[:-1]:
        if item:
            out.append(" " * held + item)
            held = 0
        else:
            held += 1
    out.append(" " * held + items[-1])
    return out


def _chunk_lists(texts: pa.Array) -> pa.ListArray:
    """Marked words of each text: a plain split, but for the texts with odd spaces."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    odd = pc.equal(pc.binary_length(texts), 0)
    for test, s in ((pc.match_substring, "  "), (pc.match_substring, MARK), (pc.starts_with, " "), (pc.ends_with, " ")):
        odd = pc.or_(odd, test(texts, s))
    plain = pc.split_pattern(texts, " ").cast(pa.list_(pa.string()))
    rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if not len(rows):
        return plain
    own = pa.array([marked_words(texts[int(i)].as_py()) for i in rows], pa.list_(pa.string()))
    order = np.arange(len(texts))
    order[rows] = len(texts) + np.arange(len(rows))
    return pa.concat_arrays([plain, own]).take(pa.array(order))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """doc_id, ids array<int>: the library's ids with the end id. ``model`` defaults to the public 32k file."""

    def run(batches):
        sp = _processor(model)
        table = table_for(("sentencepiece", _path(model)), lambda: _chunk_encoder(model))
        for b in slices(batches, "text", 4 << 20):
            flat, offs = join_by_position(_chunk_lists(b.column("text")), table, sp.eos_id())
            ids = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """doc_id, ids, text: the library's decode of each list of ids (null list: empty text)."""

    def run(batches):
        sp = _processor(model)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids = [x if x is not None else [] for x in part.column("ids").to_pylist()]
                texts = sp.decode(ids, num_threads=1) if ids else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "text"])

    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def recode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """doc_id, ids, text: ``decode(encode(docs))`` in one step, so that a task holds one worker with one model."""

    def run(batches):
        sp = _processor(model)
        table = table_for(("sentencepiece", _path(model)), lambda: _chunk_encoder(model))
        for b in slices(batches, "text", 2 << 20):
            flat, offs = join_by_position(_chunk_lists(b.column("text")), table, sp.eos_id())
            for lo in range(0, b.num_rows, 500):
                hi = min(b.num_rows, lo + 500)
                at = offs[lo:hi + 1]
                ids = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(flat[at[0]:at[-1]]))
                texts = sp.decode(ids.to_pylist(), num_threads=1)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """The contract's columns from encoded and decoded documents."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
