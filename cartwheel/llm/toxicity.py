"""Toxicity grades by cumulative-link ordinal regression (operator 8).

P(grade > k | text) = logistic(w . x - theta_k) with one weight vector shared by
all thresholds theta_0 < theta_1 < ...; x marks which features of a selected
vocabulary the text holds: words, and beginnings of longer words (4 and 5
characters, written with ``^`` in front), which catch inflected forms. The output is the probability of each grade and the
expected severity.

The vocabulary (``vocabulary`` words at most) is selected by how much more often
a word occurs in graded than in grade-0 rows; vocabulary and weights are learned
from a bounded sample of labelled rows (``sample`` per side at most, by hash of
the id), both documented parameters; a sampled row weighs as many labelled rows of
its side as it stands for, so results do not depend on whether the bound bites. Scoring reads every word of every text.

Words are lower-cased (A-Z), split at ASCII white space and stripped of ASCII
punctuation at both ends.

Defined results: null, empty and blank texts hold no words and get the intercept's
severity; without graded rows the expected severity is 0 everywhere; null labels
are not learned from; contradicting labels of an id count as the higher one;
repeated rows get repeated results; a null id is scored and not learned from;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import slices, stored, words_of

SAMPLE = 8000
VOCABULARY = 1500
STARTS = (4, 5)
PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(text: Column) -> Column:
    """Distinct features of a text: its words and their beginnings (used on the sample)."""
    t = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.split(t, r"[\x20\x09-\x0D]+")
    bare = F.array_remove(F.array_distinct(F.transform(parts, lambda x: F.btrim(x, F.lit(PUNCT)))), "")
    starts = [F.transform(F.filter(bare, lambda x, k=k: F.length(x) > k), lambda x, k=k: F.concat(F.lit("^"), F.substring(x, 1, k)))
              for k in STARTS]
    return F.array_distinct(F.concat(bare, *starts))


def features(word: str) -> list[str]:
    """The same for one bare word."""
    return [word, *("^" + word[:k] for k in STARTS if len(word) > k)] if word else []


def fit_cumulative_link(x: list[np.ndarray], grades: np.ndarray, width: int, n_grades: int,
                        penalty: float = 1e-5, steps: int = 300, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by gradient steps (Adam) on the ordinal likelihood.

    ``x`` holds the feature indices of each row, ``weight`` how much it counts.
    Thresholds are kept in order through positive gaps.
    """
    n, cuts = len(grades), n_grades - 1
    counts = np.ones(n) if weight is None else weight * (n / weight.sum())
    flat = np.concatenate(x) if n else np.zeros(0, int)
    row = np.repeat(np.arange(n), [len(a) for a in x])
    above = grades[:, None] > np.arange(cuts)[None, :]
    share = np.clip((counts[:, None] * above).mean(axis=0), 1e-3, 1 - 1e-3)
    theta = -np.log(share / (1 - share))
    par = np.concatenate([np.zeros(width), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1):
        w, gaps = par[:width], np.exp(par[width + 1:])
        theta = par[width] + np.concatenate(([0.0], np.cumsum(gaps)))
        z = np.bincount(row, w[flat], n)
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -30, 30)))  # P(grade > k)
        full = np.hstack([np.ones((n, 1)), p, np.zeros((n, 1))])
        at = np.arange(n)
        mass = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = np.hstack([np.zeros((n, 1)), p * (1 - p), np.zeros((n, 1))])
        dz = -counts * (slope[at, grades] - slope[at, grades + 1]) / mass / n
        gw = np.bincount(flat, dz[row], width) + penalty * w
        dtheta = np.zeros(cuts + 2)
        np.add.at(dtheta, grades, counts * slope[at, grades] / mass / n)
        np.add.at(dtheta, grades + 1, -counts * slope[at, grades + 1] / mass / n)
        dtheta = dtheta[1:-1]
        tail = np.cumsum(dtheta[::-1])[::-1]
        g = np.concatenate([gw, [dtheta.sum()], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return par[:width], par[width] + np.concatenate(([0.0], np.cumsum(np.exp(par[width + 1:]))))


def _sampled(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """doc_id, grade, weight, words of the labelled sample (2 * ``sample`` rows at most).

    ``weight`` is the number of labelled rows of its side that a row stands for,
    times the row's own weight if ``grades`` comes with one.
    """
    own_weight = F.col("weight") if "weight" in grades.columns else F.lit(1.0)
    one = grades.select("doc_id", F.col("grade").cast("int").alias("grade"), own_weight.alias("weight")).dropna() \
        .groupBy("doc_id").agg(F.max("grade").alias("grade"), F.max("weight").alias("weight"))
    n = one.agg(F.count_if(F.col("grade") == 0).alias("low"), F.count_if(F.col("grade") > 0).alias("high")).first()
    stands = F.when(F.col("grade") == 0, max(1.0, n.low / sample)).otherwise(max(1.0, n.high / sample))
    order = [F.xxhash64(F.lit(5), "doc_id"), F.col("doc_id")]
    few = one.filter("grade = 0").orderBy(*order).limit(sample).unionByName(one.filter("grade > 0").orderBy(*order).limit(sample))
    few = few.select(F.col("doc_id").alias("__id"), "grade", (F.col("weight") * stands).alias("weight"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.join(F.broadcast(few), F.col("doc_id") == F.col("__id")).dropDuplicates(["doc_id"]) \
        .select("doc_id", "grade", "weight", words(F.col("text")).alias("words"))


def select_vocabulary(rows: DataFrame, vocabulary: int = VOCABULARY) -> list[str]:
    """Words whose document share differs most between graded and grade-0 rows (z of two shares)."""
    n = {r.g: r for r in rows.groupBy((F.col("grade") > 0).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("all")).collect()}
    if len(n) < 2:
        return []
    n1, n0 = float(n[True].n), float(n[False].n)
    all1, all0 = n[True].all, n[False].all  # labelled rows that both sides stand for
    seen = rows.select((F.col("grade") > 0).alias("g"), F.explode("words").alias("word")).groupBy("word") \
        .agg(F.count_if("g").alias("a"), F.count_if(~F.col("g")).alias("b")).filter("a + b >= 3")
    share = (F.col("a") * (all1 / n1) + F.col("b") * (all0 / n0)) / F.lit(all1 + all0)
    z = F.abs(F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    return [r.word for r in seen.orderBy(z.desc(), "word").limit(vocabulary).select("word").collect()]


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> dict:
    """A model {words, weights, thresholds} from ``grades`` (doc_id, grade 0..K, and if given the weight of the row)."""
    rows = _sampled(docs, grades, id_col, text_col, sample)
    names = select_vocabulary(rows, vocabulary)
    keep = F.array(*[F.lit(w) for w in names]) if names else F.array().cast("array<string>")
    got = rows.select("doc_id", "grade", "weight", F.array_intersect("words", keep).alias("words")).orderBy("doc_id").collect()
    y = np.array([r.grade for r in got], int)
    if not names or not len(y) or y.max() < 1:
        return {"words": [], "weights": [], "thresholds": []}
    index = {w: i for i, w in enumerate(names)}
    x = [np.array([index[w] for w in r.words], int) for r in got]
    weights, thresholds = fit_cumulative_link(x, y, len(names), int(y.max()) + 1, weight=np.array([r.weight for r in got]))
    return {"words": names, "weights": weights.tolist(), "thresholds": thresholds.tolist()}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_grades array<double> (of each grade), expected_severity double."""
    theta = np.asarray(model["thresholds"])
    index = {w: i for i, (w, v) in enumerate(zip(model["words"], model["weights"])) if v}
    w = np.array(model["weights"] or [0.0])

    def run(batches):
        for b in slices(batches, "text"):
            offsets, codes, dictionary = words_of(b.column("text").cast(pa.string()))
            bare = pc.ascii_trim(dictionary, characters=PUNCT).to_pylist()
            known = [[index[f] for f in features(x) if f in index] for x in bare]
            held = np.fromiter(map(len, known), np.int64, len(known))
            flat = np.array([k for ks in known for k in ks], np.int64)
            first = np.cumsum(held) - held
            n = b.num_rows
            row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
            hit = held[codes] > 0 if len(codes) else np.zeros(0, bool)
            row, at = row[hit], codes[hit]
            times = held[at]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            feature = flat[np.repeat(first[at], times) + step]
            pairs = np.unique(np.repeat(row, times) * len(w) + feature)  # a feature counts once a text
            z = np.bincount(pairs // len(w), w[pairs % len(w)], n)
            above = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -30, 30)))
            p = -np.diff(np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))]), axis=1)
            grades = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), grades, pa.array(above.sum(axis=1))],
                                             ["doc_id", "p_grades", "expected_severity"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, p_grades array<double>, expected_severity double")


def weak_grades(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample: int = SAMPLE, markers: int = 50) -> DataFrame:
    """doc_id, grade 0..2, weight of the sample of labels that only say toxic or not (doc_id, toxic 0/1).

    Grade 0: not toxic. Toxic rows of the sample are split by how many distinct
    marker words (the words most typical of toxic rows) they hold: up to the
    sample's median is grade 1, more is grade 2. The weight is the number of
    labels of its side that a row stands for; ``fit`` counts it so often.
    """
    binary = labels.select("doc_id", F.col("toxic").alias("grade"))
    rows = _sampled(docs, binary, id_col, text_col, sample)
    names = select_vocabulary(rows, markers)
    keep = F.array(*[F.lit(w) for w in names]) if names else F.array().cast("array<string>")
    held = rows.select("doc_id", "grade", "weight", F.size(F.array_intersect("words", keep)).alias("n"))
    median = held.filter("grade > 0").agg(F.percentile_approx("n", 0.5).alias("m")).first().m or 0
    graded = held.select("doc_id", F.when(F.col("grade") == 0, 0).when(F.col("n") <= median, 1).otherwise(2).alias("grade"), "weight")
    return stored(graded, "weak-grades")  # the sample's rows; read several times
