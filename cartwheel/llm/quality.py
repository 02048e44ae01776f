"""Quality classifier: a sparse ensemble of rules (operator 9).

Statistics of a text are Spark column expressions. Shallow trees are grown on a
bounded sample of labelled rows (``sample`` a class at most, by hash of the id:
the only bound, a parameter; a sampled row weighs as many labelled rows of its
class as it stands for, so scores do not depend on whether the bound bites),
every path of a tree is a conjunctive rule over the statistics, a lasso-penalised logistic regression keeps few rules and gives
them weights, and the surviving rules are compiled to one Spark expression, so
scoring is a single pass over the documents with no Python.

Defined results: a null or empty text has all statistics 0 and gets the score of
that point; without labels, or with labels of one class, the score is that
class's smoothed share; labels that are null or contradict each other for an id
are averaged and rounded up; repeated rows get repeated scores; a null id
scores like any other and is never trained on; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import fold

SPLIT = r"[\x20\x09-\x0D]+"
SAMPLE = 8000
THRESHOLD = 0.7


def statistics(text: Column) -> dict[str, Column]:
    """Name -> expression over the helper columns that ``with_statistics`` adds."""
    n, w, lines = F.col("__n"), F.col("__words"), F.col("__lines")
    words = F.greatest(F.size(w), F.lit(1))
    chars = F.greatest(n, F.lit(1))
    count = lambda pattern: n - F.length(F.regexp_replace(text, pattern, ""))
    return {
        "chars": F.log1p(n.cast("double")),
        "word_length": n / words,
        "distinct_words": F.size(F.array_distinct(w)) / words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "line_length": F.log1p(n / F.greatest(F.size(lines), F.lit(1))),
        "upper": count("[A-Z]+") / chars,
        "symbols": count(r"[!-+/:-@\[-`{-~]+") / chars,
        "digits": count("[0-9]+") / chars,
        "stops": count("[.,]+") / chars,
        "letters": count("[A-Za-zÀ-ɏ]+") / chars,
        "longest": F.log1p(F.aggregate(w, F.lit(0), lambda a, x: F.greatest(a, F.length(x))).cast("double")),
    }


def _parts(text: Column) -> dict[str, Column]:
    """The helper columns that ``statistics`` reads, from the text column."""
    return {"__n": F.length(text), "__words": F.filter(F.split(text, SPLIT), lambda x: x != ""), "__lines": F.split(text, "\n")}


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """doc_id and one double per statistic (and their names)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    d = d.select("*", *[e.alias(k) for k, e in _parts(F.col("__t")).items()])
    stats = statistics(F.col("__t"))
    return d.select("doc_id", *[e.cast("double").alias(k) for k, e in stats.items()]), list(stats)


# --- trees, rules, lasso: on the bounded sample --------------------------------------

def _split(x, g, rows, weight, least=20, cuts=32):
    """(gain, feature, threshold) of the best weighted least-squares split of ``g`` over ``rows``."""
    best = (1e-9, None, None)
    r, n = weight[rows], len(rows)
    rg = r * g[rows]
    total, mass = rg.sum(), r.sum()
    for j in range(x.shape[1]):
        v = x[rows, j]
        order = np.argsort(v, kind="stable")
        s, c, m = v[order], np.cumsum(rg[order]), np.cumsum(r[order])
        at = np.unique(np.linspace(least, n - least, cuts).astype(int)) if n > 2 * least else []
        for i in at:
            if 0 < i < n and s[i - 1] < s[i]:
                gain = c[i - 1] ** 2 / m[i - 1] + (total - c[i - 1]) ** 2 / (mass - m[i - 1]) - total ** 2 / mass
                if gain > best[0]:
                    best = (gain, j, (s[i - 1] + s[i]) / 2)
    return best


def _grow(x, g, rows, weight, depth, path, paths, out):
    if depth and len(rows) >= 40:
        _, j, t = _split(x, g, rows, weight)
        if j is not None:
            for low in (True, False):
                part = rows[(x[rows, j] <= t) == low]
                new = (*path, (j, low, float(t)))
                paths.append(new)
                _grow(x, g, part, weight, depth - 1, new, paths, out)
            return
    out[rows] = (weight[rows] * g[rows]).sum() / weight[rows].sum() if len(rows) else 0


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 12, depth: int = 3, seed: int = 3,
               weight: np.ndarray | None = None) -> list[tuple]:
    """Distinct paths of ``trees`` boosted shallow trees: tuples of (feature, is_low, threshold)."""
    rng = np.random.default_rng(seed)
    weight = np.ones(len(y)) if weight is None else weight
    f, rules = np.zeros(len(y)), {}
    for _ in range(trees):
        g = y - 1 / (1 + np.exp(-f))
        rows = np.sort(rng.choice(len(y), max(1, int(0.7 * len(y))), replace=False))
        paths, step = [], np.zeros(len(y))
        _grow(x, g, rows, weight, depth, (), paths, step)
        f = f + 2 * step
        rules.update(dict.fromkeys(paths))
    return list(rules)


def rule_matrix(x: np.ndarray, rules: list[tuple]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for j, low, t in rule:
            out[:, k] *= (x[:, j] <= t) == low
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = 2e-3, steps: int = 400,
                   weight: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient; ``weight``: how much each row counts."""
    n, m = z.shape
    r = np.ones(n) if weight is None else weight * (n / weight.sum())
    z1 = np.hstack([np.ones((n, 1)), z])
    rate = 4 * n / max(1e-9, np.linalg.norm(z1 * np.sqrt(r)[:, None], 2) ** 2)
    w = v = np.zeros(m + 1)
    t = 1.0
    for _ in range(steps):
        grad = z1.T @ (r * (1 / (1 + np.exp(-np.clip(z1 @ v, -30, 30))) - y)) / n
        new = v - rate * grad
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - rate * penalty)
        t1 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t1 * (new - w), new, t1
    return float(w[0]), w[1:]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> dict:
    """A model {intercept, rules: [(weight, rule)], names} from ``labels`` (doc_id, label 0/1)."""
    one = labels.select(F.col("doc_id"), F.col("label").cast("double").alias("y")).dropna() \
        .groupBy("doc_id").agg(F.ceil(F.avg("y")).cast("int").alias("y"))
    picked = None
    for y in (0, 1):
        part = one.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    weights = {r.y: r.n for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = picked.select(F.col("doc_id").alias("__id"), "y")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = own.join(F.broadcast(few), F.col("doc_id") == F.col("__id")).select("doc_id", "text")  # 2 * sample ids at most
    stats, names = with_statistics(known.dropDuplicates(["doc_id"]))
    rows = stats.join(F.broadcast(few), F.col("doc_id") == F.col("__id")).orderBy("doc_id").collect()
    prior = (weights.get(1, 0) + 1) / (sum(weights.values()) + 2)
    flat = {"intercept": math.log(prior / (1 - prior)), "rules": [], "names": names}
    y = np.array([r["y"] for r in rows], float)
    if len(rows) < 40 or len(set(y)) < 2:
        return flat
    x = np.array([[r[k] for k in names] for r in rows], float)
    share = {c: weights[c] / min(weights[c], sample) for c in (0, 1)}  # labelled rows that a sampled row stands for
    stands = np.array([share[int(c)] for c in y])
    rules = tree_rules(x, y, weight=stands)
    if not rules:
        return flat
    b, w = lasso_logistic(rule_matrix(x, rules), y, weight=stands)
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return {"intercept": b, "rules": [(float(w[k]), rules[k]) for k in keep], "names": names}


def score_column(model: dict, prefix: str = "") -> Column:
    """The model as one expression over the statistics (named with ``prefix``): 0 to 1."""
    z = F.lit(model["intercept"])
    for weight, rule in model["rules"]:
        test = F.lit(True)
        for j, low, t in rule:
            c = F.col(prefix + model["names"][j])
            test = test & ((c <= F.lit(t)) if low else (c > F.lit(t)))
        z = z + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score."""
    stats, _ = with_statistics(docs, id_col, text_col)
    return stats.select("doc_id", score_column(model).alias("score"))


def keep(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns unchanged: one pass, no join."""
    d = docs.select(F.struct(*docs.columns).alias("__row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    d = d.select("*", *[e.alias(k) for k, e in _parts(F.col("__t")).items()])
    d = d.withColumn("__s", F.struct(*[e.cast("double").alias(k) for k, e in statistics(F.col("__t")).items()]))
    return d.filter(score_column(model, "__s.") >= threshold).select("__row.*")


def training_fold(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of the id modulo 4 is not 2."""
    return labels.filter(fold("doc_id", 4) != 2).select("doc_id", F.col("quality").alias("label"))


