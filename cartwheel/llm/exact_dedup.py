"""Exact dedup by content-defined chunk recipes (operator 3), DataFrame functions only.

Each normalised text is cut where its content says so: after a short pattern of
letters and a separator, no earlier than MIN and no later than MAX characters,
so equal stretches give equal chunks wherever they stand. Every distinct chunk
text is moved once, to the table of chunks, which groups by the chunk's bytes
and so proves which hashes stand for exactly one text (a verified identifier).
A document is then its recipe, the ordered list of identifiers, and documents
are compared by recipe alone; long texts do not move again. A hash that stands
for two texts (a clash) is told apart by the text's rank among them.

Texts are equal when identical after lower-casing A-Z. Of equal texts the row
with the largest id stays.

Defined results: a null text equals the empty one; rows that repeat an id with
an equal text are one document (one result row, all rows counted in
group_size); a null id sorts below all ids; only the two named columns are read,
so extra or clashing columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN, MAX = 512, 8192
BOUNDARY = r"(?<=[aeiou][nrst][\s.,;])"
CUT = rf"(?s).{{{MIN},{MAX}}}?{BOUNDARY}|.{{1,{MAX}}}"


def normalise(text: Column) -> Column:
    """Lower-case A-Z only (lower() agrees with that on texts of ASCII alone, and is faster)."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def chunks(norm: Column) -> Column:
    """Content-defined chunks of a normalised text, in order; none for the empty text."""
    return F.regexp_extract_all(norm, F.lit(CUT), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256, recipe array<long> (chunk hashes in order)."""
    d = docs.select(F.col(id_col).alias("doc_id"), normalise(F.col(text_col)).alias("norm"))
    return d.select("doc_id", F.sha2("norm", 256).alias("text_sha256"),
                    F.transform(chunks(F.col("norm")), lambda c: F.xxhash64(c)).alias("recipe"))


def chunk_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """h, chunk: every distinct chunk text once, proven distinct by its bytes."""
    d = docs.select(F.explode(chunks(normalise(F.col(text_col)))).alias("chunk"))
    return d.select(F.xxhash64("chunk").alias("h"), "chunk").distinct()


def clashes(table: DataFrame) -> DataFrame:
    """h: hashes that stand for more than one chunk text."""
    return table.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")


def _ranked(docs: DataFrame, table: DataFrame, bad: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_sha256, ranks: for documents with a clashing hash, the rank of each clashing chunk."""
    d = docs.select(F.col(id_col).alias("doc_id"), normalise(F.col(text_col)).alias("norm"))
    cells = d.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk")) \
        .withColumn("h", F.xxhash64("chunk")).join(bad, "h", "left_semi")
    texts = table.join(bad, "h", "left_semi")
    # rank = how many chunk texts of the same hash sort before it; a hash has few texts
    other = texts.select("h", F.col("chunk").alias("other"))
    rank = texts.join(other, "h").groupBy("h", "chunk").agg(F.count_if(F.col("other") < F.col("chunk")).alias("rank"))
    return cells.join(rank, ["h", "chunk"]).groupBy("doc_id", "text_sha256") \
        .agg(F.array_sort(F.collect_set(F.struct("pos", "rank"))).alias("ranks"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    found = stored(recipes(docs, id_col, text_col), "recipes")
    table = chunk_table(docs, text_col)
    bad = stored(clashes(table), "clashes")
    if bad.isEmpty():  # every hash is a verified identifier
        rec, key = found, ["recipe"]
    else:
        ranks = _ranked(docs, table, bad, id_col, text_col)
        rec = found.alias("r").join(ranks.alias("k"), F.col("r.doc_id").eqNullSafe(F.col("k.doc_id"))
                                    & (F.col("r.text_sha256") == F.col("k.text_sha256")), "left") \
            .select("r.doc_id", "r.text_sha256", "r.recipe", F.coalesce("k.ranks", F.array().cast("array<struct<pos:int,rank:bigint>>")).alias("ranks"))
        key = ["recipe", "ranks"]
    # rows that repeat an id and a text count, and give one row
    rows = rec.groupBy("doc_id", "text_sha256", *key).agg(F.count(F.lit(1)).alias("n"))
    groups = rows.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return rows.join(groups, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one per distinct normalised text, all columns kept."""
    ids = classes(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("keep"), F.col("text_sha256").alias("keep_sha"))
    # the row travels as one struct, so no column of it can clash
    d = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.sha2(normalise(F.col(text_col)), 256).alias("sha"))
    kept = d.join(ids, F.col("id").eqNullSafe(F.col("keep")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    return kept.dropDuplicates(["id", "sha"]).select("row.*")
