"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Fixed value: what separates words, ``[\x20\x09-\x0D]`` (ASCII white space).
WORD = r"[^\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver runs it.

    On a cluster the package is shipped with ``--py-files``; this only adds the
    driver's own folder to the workers' path, which a local session needs.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser over a uint64 array (wraps silently)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def slices(batches, column: str, max_bytes: int = 8 << 20):
    """Cut record batches so that ``column`` holds about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(sizes, dtype=np.int64) - sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(lo, hi - lo)


def words_of(texts: pa.Array, lower: bool = True):
    """(offsets, codes, dictionary) of the ASCII-white-space words of each text; null is empty.

    ``codes[offsets[i]:offsets[i+1]]`` index ``dictionary`` and are the words of
    text ``i`` in order. Lower-casing touches A-Z only.
    """
    arr = pc.fill_null(texts, "")
    if lower:
        arr = pc.ascii_lower(arr)
    lists = pc.ascii_split_whitespace(arr)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    enc = lists.flatten().dictionary_encode()
    codes, dictionary = enc.indices.to_numpy(), enc.dictionary
    offsets = offsets - offsets[0]
    empty = pc.index(dictionary, "").as_py()
    if empty >= 0:  # white space at either end leaves an empty string
        real = codes != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        codes = codes[real]
    return offsets, codes, dictionary
