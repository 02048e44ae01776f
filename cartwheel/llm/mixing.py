"""Mixing sources to target weights by min-cost flow (operator 5).

A document may belong to several sources. Documents are aggregated by their
membership pattern (the set of sources), and word capacity is routed from
patterns to source quotas by a min-cost flow: a pattern offers its size once
per epoch, each repetition at a higher cost (convex), so nothing is repeated
while fresh words of a source are left. The amount that leaves a pattern is then
taken from its documents: whole epochs of all of them, and for the rest a
seeded choice: documents in the order of a seeded hash, each that still fits, and
at last the one nearest to what is then open if that comes nearer the target.

What reaches the driver is one row per pattern and per source, and 256 sums per
pattern and round of the radix search for the cut-off, or about ``CANDIDATES``
documents a pattern and round of filling the gap behind it: these depend on the mix
that is asked for, not on the number of documents (more than ``MAX_PATTERNS``
patterns are refused with an error, never dropped). The choice itself is a
filter on (hash, ranges of the hash with the largest size taken there), so no group of rows meets in one task.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share the total size; a target stops at 3 times its source's size and what is
over goes to the others by weight until none is above.

Defined results: size of a null or blank text is 0 and takes 0 words; a null
source is a source of its own, and a null among the sources of a row too;
the seeded hash is of id and text, so rows of one id or without id are told apart;
repeated rows are separate documents that share their hash, as many of them are
taken as fit, by the number of the row in the stored table; extra columns pass through ``mix`` untouched; an empty table
gives no rows. Same input and seed, same result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
EPOCHS = 3
MAX_PATTERNS = 100_000
CANDIDATES = 256
LOW, HIGH = -(1 << 63), (1 << 63) - 1
EPOCH_COSTS = (0, 10, 30)  # convex: each further repetition costs more than the one before


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights=WEIGHTS, epochs: int = EPOCHS) -> dict:
    """source -> target: weighted share of the total, capped at ``epochs`` sizes, the excess reshared."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > epochs * sizes[s]]
        if not full:
            out.update((s, unit * weight[s]) for s in open_)
            break
        for s in full:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(supply: dict, quotas: dict, epochs: int = EPOCHS, costs=EPOCH_COSTS) -> dict:
    """(pattern, source) -> words. Successive shortest paths over pattern -> source arcs.

    ``supply`` maps a pattern (tuple of sources) to its size. Patterns that share no
    source with others form components of their own, which are solved apart.
    """
    patterns = [p for p, size in supply.items() if size > 0]
    of_source: dict = {}
    for p in patterns:
        for s in p:
            of_source.setdefault(s, []).append(p)
    flow: dict = {}
    seen: set = set()
    for first in patterns:
        if first in seen:
            continue
        part, sources, todo = [], set(), [first]
        seen.add(first)
        while todo:
            p = todo.pop()
            part.append(p)
            for s in p:
                if s not in sources:
                    sources.add(s)
                    for q in of_source[s]:
                        if q not in seen:
                            seen.add(q)
                            todo.append(q)
        flow.update(_solve(part, sources, supply, quotas, epochs, costs))
    return flow


def _solve(patterns, sources, supply, quotas, epochs, costs) -> dict:
    """One component: cheapest augmenting paths from spare epochs to open quotas."""
    flow = {(p, s): 0 for p in patterns for s in p}
    used = dict.fromkeys(patterns, 0)
    need = {s: max(0, round(quotas[s])) for s in sources}
    into = {s: [p for p in patterns if s in p] for s in sources}
    while True:
        # Dijkstra from all patterns with spare words; going back along a flow returns its words
        best, back, heap = {}, {}, []
        for k, p in enumerate(patterns):
            e = used[p] // supply[p]
            if e < epochs:
                heapq.heappush(heap, (costs[e], k, "p", p, None))
        tick, goal, reached = len(patterns), None, False  # a goal may be None: the null source
        while heap:
            cost, _, kind, node, origin = heapq.heappop(heap)
            if (kind, node) in best:
                continue
            best[kind, node], back[kind, node] = cost, origin
            if kind == "s" and need[node] > 0:
                goal, reached = node, True
                break
            for other in (node if kind == "p" else into[node]):
                if kind == "p" or flow[other, node] > 0:
                    tick += 1
                    heapq.heappush(heap, (cost, tick, "s" if kind == "p" else "p", other, (kind, node)))
        if not reached:
            return {k: v for k, v in flow.items() if v}
        path, at = [], ("s", goal)
        while at is not None:
            path.append(at)
            at = back[at]
        path.reverse()
        start = path[0][1]
        amount = min(need[goal], (used[start] // supply[start] + 1) * supply[start] - used[start])
        for (k1, a), (_, b) in zip(path, path[1:]):
            if k1 == "s":
                amount = min(amount, flow[b, a])
        for (k1, a), (_, b) in zip(path, path[1:]):
            if k1 == "p":
                flow[a, b] += amount
            else:
                flow[b, a] -= amount
        used[start] += amount
        need[goal] -= amount


def _keyed(docs: DataFrame, sources: Column, id_col: str, text_col: str, seed: int) -> list[Column]:
    """The columns that decide: pattern, size, seeded hash, and a number that tells rows of one hash apart (store it before use)."""
    return [F.array_sort(F.array_distinct(sources.cast("array<string>"))).alias("__pattern"),
            size_of(F.col(text_col)).alias("__size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col).cast("string")).alias("__h"),
            F.monotonically_increasing_id().alias("__salt")]


_CHOICE = "__ranges array<struct<first:long,last:long,cap:long>>, __split array<struct<h:long,salt:long>>, __also long"


def plan(keyed: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per pattern: whole epochs, ranges of the hash taken once more, and its sources' sizes and targets.

    ``keyed`` has __pattern, __size, __h, __salt and is read several times.
    """
    spark = keyed.sparkSession
    rows = keyed.groupBy("__pattern").agg(F.sum("__size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: group the sources first")
    supply = {tuple(r[0]): r.size for r in sorted(rows, key=lambda r: [(s is None, s or "") for s in r[0]])}
    sizes: dict = {}
    for p, size in supply.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + size
    quota = _quotas(supply, sizes, weights, epochs)
    routed: dict = {}
    for (p, _), words in min_cost_flow(supply, quota, epochs).items():
        routed[p] = routed.get(p, 0) + words
    out = {p: divmod(routed.get(p, 0), size) if size else (0, 0) for p, size in supply.items()}
    cut = _cutoffs(keyed, {p: rest for p, (_, rest) in out.items() if rest})
    back = _put_back(keyed, cut)
    none = ([], [], None)
    return spark.createDataFrame(
        [(list(p), int(whole), *cut.get(p, none)[:3], *back.get(p, none)[:3], [(s, sizes[s], float(quota[s])) for s in p]) for p, (whole, _) in out.items()],
        f"__pattern array<string>, __whole long, {_CHOICE}, {_CHOICE.replace('__', '__back_')}, by_source array<struct<source:string,source_size:long,target:double>>")



def _put_back(keyed: DataFrame, cut: dict) -> dict:
    """What goes back where one more row overshot the quota: chosen among the rows taken in hash order, as those were.

    Without it a source whose last text is long misses its target by up to half that text.
    """
    over = {p: x[3] for p, x in cut.items() if x[3] > 0}
    if not over:
        return {}
    frame = keyed.sparkSession.createDataFrame([(list(p), *cut[p][:3]) for p in over], f"__pattern array<string>, {_CHOICE}")
    chosen = keyed.join(F.broadcast(frame), "__pattern").filter(_in_ranges() & (F.col("__salt") != F.col("__also"))).select(*keyed.columns)
    return _cutoffs(chosen, over)


def _in_ranges(kind: str = "__") -> Column:
    h = F.col("__h")
    beyond = F.exists(f"{kind}split", lambda x: (h == x["h"]) & (F.col("__salt") > x["salt"]))
    return ~beyond & F.exists(f"{kind}ranges", lambda r: (h >= r["first"]) & (h <= r["last"]) & (F.col("__size") <= r["cap"]))


def _times() -> Column:
    salt = F.col("__salt")
    back = _in_ranges("__back_") | F.coalesce(salt == F.col("__back_also"), F.lit(False))
    return F.col("__whole") + F.when((_in_ranges() & ~back) | (salt == F.col("__also")), 1).otherwise(0)


def taken(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
          weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, pattern, size, times, taken, by_source: one row per row of ``docs``.

    ``sources`` is an array column: the sources that a document belongs to;
    by_source holds (source, source_size, target) of each.
    """
    keyed = stored(docs.select(F.col(id_col).alias("doc_id"), *_keyed(docs, sources, id_col, text_col, seed)), "mix-sizes")
    got = keyed.join(F.broadcast(plan(keyed, weights, epochs)), "__pattern")  # MAX_PATTERNS rows at most
    return got.select("doc_id", F.col("__pattern").alias("pattern"), F.col("__size").alias("size"), _times().alias("times"),
                      (_times() * F.col("__size")).alias("taken"), "by_source")


def mix(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
        weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, its columns unchanged.

    Texts are not shuffled: the plan (one row per pattern) is broadcast to them.
    They are stored once with the row numbers, which must not change between reads.
    """
    # the row travels as one struct, so no column of it can clash
    rows = stored(docs.select(F.struct(*docs.columns).alias("__row"), *_keyed(docs, sources, id_col, text_col, seed)), "mix-rows")
    got = rows.join(F.broadcast(plan(rows.drop("__row"), weights, epochs)).drop("by_source"), "__pattern")
    got = got.withColumn("__times", F.when(F.col("__size") > 0, _times()).otherwise(0)).filter("__times > 0")
    return got.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select("__row.*")


def _quotas(supply: dict, sizes: dict, weights, epochs: int) -> dict:
    """Targets share the words that exist once, however many sources a document belongs to."""
    total, out = sum(supply.values()), {}
    if not sizes:
        return out
    scaled = targets(sizes, weights, epochs)
    factor = total / max(1e-300, sum(sizes.values()))
    if factor == 1.0 or not total:
        return scaled
    for s, t in scaled.items():
        out[s] = t * factor
    return out


def _cutoffs(keyed: DataFrame, rest: dict) -> dict:
    """pattern -> (ranges (first, last, largest size) of the hash taken, last row taken of hashes taken in part, one more row,
    words beyond the quota).

    The documents are taken in hash order, each that fits what is open then. A
    radix search takes those up to the first that does not fit; behind it only
    documents of the gap's size at most are looked at, and so on until none is
    left. Where few fill the gap, the next ones in hash order are fetched and
    taken one by one. Of the documents that are left, the one whose size is
    nearest to what is still open fills it if that comes nearer.
    """
    if not rest:
        return {}
    spark = keyed.sparkSession
    ranges: dict = {p: [] for p in rest}
    parts: dict = {}  # (pattern, hash) -> rows taken of the equal ones that share the hash
    state = {p: (LOW, HIGH, words) for p, words in rest.items()}  # first hash not decided, largest size, words open
    gap = dict(rest)
    search, near = dict(state), {}
    while state:
        for p, (upto, left, tie) in _prefix(keyed, search).items():
            first, cap, _ = state[p]
            if upto >= first:
                ranges[p].append((first, upto, cap))
            gap[p] = left
            state[p] = (upto + 1, left, left)
            if tie:
                near[p] = upto + 1
        _take_groups(keyed, state, near, ranges, parts, gap)
        state = {p: x for p, x in state.items() if x[0] <= HIGH and x[2] > 0}
        if not state:
            break
        seen = _open(keyed, state).groupBy("__pattern").agg(F.approx_count_distinct("__h").alias("n"), F.sum("__size").alias("words")).collect()
        seen = {tuple(r[0]): r for r in seen}
        state = {p: x for p, x in state.items() if p in seen}  # nothing else fits in the others
        search, near = {}, {}
        for p, (first, cap, left) in state.items():
            n, words = seen[p].n, seen[p].words
            if left * n > CANDIDATES * words and words > left:
                search[p] = state[p]  # many documents fill the gap
            else:
                near[p] = HIGH if n <= CANDIDATES else min(HIGH, first + (HIGH - first) * CANDIDATES // n)
        _take_groups(keyed, state, near, ranges, parts, gap)
        near = {}
    split = _split(keyed, parts)
    frame = spark.createDataFrame([(list(p), ranges[p], split.get(p, []), gap[p]) for p in rest],
                                  "__pattern array<string>, __ranges array<struct<first:long,last:long,cap:long>>, "
                                  "__split array<struct<h:long,salt:long>>, gap long")
    beyond = keyed.join(F.broadcast(frame), "__pattern").filter((F.col("__size") > 0) & (F.col("gap") > 0) & ~_in_ranges())
    best = beyond.groupBy("__pattern").agg(F.min(F.struct(F.abs(F.col("__size") - F.col("gap")).alias("miss"), F.col("__h").alias("h"),
                                                               F.col("__salt").alias("salt"), F.col("__size").alias("size"))).alias("b")).collect()
    also = {tuple(r[0]): r.b for r in best if r.b.miss < gap[tuple(r[0])]}
    return {p: (ranges[p], split.get(p, []), also[p].salt if p in also else None, also[p].size - gap[p] if p in also else 0) for p in rest}


def _take_groups(keyed: DataFrame, state: dict, near: dict, ranges: dict, parts: dict, gap: dict) -> None:
    """Take the open documents up to the hash in ``near`` one by one, each that fits; rows of one hash are equal."""
    for p, groups in _groups(keyed, state, near).items():
        first, cap, left = state[p]
        for h, size, n in groups:
            fit = min(n, left * n // size)
            if fit < n:  # from here on only smaller ones
                last = h if fit else h - 1
                if last >= first:
                    ranges[p].append((first, last, cap))
                if fit:
                    parts[p, h] = fit
                left -= fit * (size // n)
                first, cap = h + 1, left
            else:
                left -= size
        if near[p] >= first:
            ranges[p].append((first, near[p], cap))
        state[p] = (near[p] + 1, left, left)
        gap[p] = left


def _split(keyed: DataFrame, parts: dict) -> dict:
    """pattern -> (hash, last row number taken) of the hashes that are taken in part: the same search, over row numbers."""
    if not parts:
        return {}
    frame = keyed.sparkSession.createDataFrame([(list(p), h) for p, h in parts], "__pattern array<string>, h long")
    same = (F.col("__h") == F.col("h"))
    rows = keyed.join(F.broadcast(frame), "__pattern").filter(same).select(
        F.concat("__pattern", F.array(F.col("h").cast("string"))).alias("__pattern"), F.lit(1).cast("long").alias("__size"), F.col("__salt").alias("__h"))
    found = _prefix(rows, {(*p, str(h)): (LOW, HIGH, n) for (p, h), n in parts.items()})
    out: dict = {}
    for key, (upto, _, _) in found.items():
        out.setdefault(key[:-1], []).append((int(key[-1]), upto))
    return out


def _open(keyed: DataFrame, state: dict) -> DataFrame:
    """The documents from a pattern's first undecided hash on that are not larger than its cap."""
    frame = keyed.sparkSession.createDataFrame([(list(p), first, cap) for p, (first, cap, _) in state.items()], "__pattern array<string>, first long, cap long")
    return keyed.join(F.broadcast(frame), "__pattern").filter((F.col("__h") >= F.col("first")) & (F.col("__size") <= F.col("cap")) & (F.col("__size") > 0))


def _groups(keyed: DataFrame, state: dict, near: dict) -> dict:
    """pattern -> (hash, size of all its rows, their number) up to the hash in ``near``, in order."""
    if not near:
        return {}
    last = keyed.sparkSession.createDataFrame([(list(p), h) for p, h in near.items()], "__pattern array<string>, last long")
    part = _open(keyed, {p: state[p] for p in near}).join(F.broadcast(last), "__pattern").filter(F.col("__h") <= F.col("last"))
    out: dict = {p: [] for p in near}
    for r in part.groupBy("__pattern", "__h").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n")).collect():
        out[tuple(r[0])].append((r[1], r.size, r.n))
    return {p: sorted(g) for p, g in out.items()}


def _prefix(keyed: DataFrame, search: dict) -> dict:
    """pattern -> (last hash up to which the open documents fit, words left, whether the next hash is shared), by radix search.

    Each round sums sizes by the next eight bits of the hash inside the bucket where
    the pattern's quota falls, so the driver sees 256 sums a pattern; the last
    bucket is one hash value.
    """
    if not search:
        return {}
    spark = keyed.sparkSession
    rows = _open(keyed, search).select("__pattern", "__size", F.col("__h").bitwiseXOR(F.lit(LOW)).alias("key"))  # order of the unsigned key = order of h
    state = {p: (0, words) for p, (_, _, words) in search.items()}  # prefix so far, words still to take
    done: dict = {}
    for level in range(8):
        if not state:
            break
        shift = 56 - 8 * level
        frame = spark.createDataFrame([(list(p), prefix) for p, (prefix, _) in state.items()], "__pattern array<string>, prefix long")
        inside = rows.join(F.broadcast(frame), "__pattern")
        if level:
            inside = inside.filter(F.shiftrightunsigned("key", shift + 8) == F.col("prefix"))
        sums = inside.groupBy("__pattern", F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(255)).alias("digit")) \
            .agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        by: dict = {}
        for r in sums:
            by.setdefault(tuple(r[0]), []).append((r.digit, r.size, r.n))
        after = {}
        for p, (prefix, words) in state.items():
            digit, alone = 256, True
            for d, size, n in sorted(by.get(p, [])):
                if size > words:
                    digit, alone = d, n == 1
                    break
                words -= size
            top = prefix << 8
            if alone or not shift:  # all before this digit fit
                done[p] = (((top + digit) << shift) - 1 + LOW, words, not alone)
            else:
                after[p] = (top + digit, words)
        state = after
    return done
