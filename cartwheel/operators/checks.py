"""Data-quality operators (Q1–Q17). Every check returns its failing rows;
zero rows means pass.

Generic checks (not_null, unique, accepted_values, relationships,
expression_is_true, unique combination) are DataFrame → DataFrame functions.
``declared_check_counts`` runs a whole list of declared checks and returns one
row per check with its failure count, reading every model once and evaluating
all checks in a single aggregation over tagged (check, key) records.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.functions.exprs import packed_key
from cartwheel.operators.rollups import daily_order_count, duplicate_keys, max_loaded_at
from cartwheel.operators.windows import weekday_baseline, zscore
from cartwheel.params import Params


# ---------------------------------------------------------------- generic checks (Q1–Q6)
def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key (combinations) occurring more than once; a NULL single key is ignored."""
    return duplicate_keys(df, *cols)


def check_accepted_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose value is outside the list; NULL passes."""
    return df.where(~F.col(col).isin(*list(values)))


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent row with ``field_`` equal to it."""
    parent_keys = parent.select(F.col(field_).alias(col)).where(F.col(col).isNotNull()).distinct()
    return child.where(F.col(col).isNotNull()).join(parent_keys, col, "left_anti")


def check_expression(df: DataFrame, expr: str | Column) -> DataFrame:
    """Rows where the expression is false. NULL passes (NOT NULL is NULL)."""
    c = F.expr(expr) if isinstance(expr, str) else expr
    return df.where(~c)


# ---------------------------------------------------------------- singular checks (Q7–Q10)
def check_order_item_count(fct_orders: DataFrame) -> DataFrame:
    """Q7 (warn): orders whose header item count differs from the counted lines."""
    return (fct_orders
            .where(F.col("line_item_count").isNotNull()
                   & (F.col("source_item_count") != F.col("line_item_count")))
            .select("order_key", "order_id", "source_item_count", "line_item_count",
                    (F.col("line_item_count") - F.col("source_item_count")).alias("diff"),
                    "ordered_date"))


def check_no_order_before_signup(fct_orders: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Q8 (error): orders placed before the user signed up (equi join + theta filter)."""
    return (fct_orders.select("order_id", "user_id", "ordered_at")
            .join(dim_users.select("user_id", "signed_up_at"), "user_id", "inner")
            .where(F.col("ordered_at") < F.col("signed_up_at"))
            .select("order_id", "user_id", "ordered_at", "signed_up_at"))


def order_volume_baseline(fct_orders: DataFrame, weeks: int = 12) -> DataFrame:
    """W7/W8 over every order day: count, same-weekday baseline and z-score."""
    b = weekday_baseline(daily_order_count(fct_orders), weeks=weeks)
    return b.select("ordered_date", "order_count",
                    F.round("baseline_avg", 1).alias("baseline_avg"),
                    F.col("baseline_stddev"), "baseline_weeks",
                    F.round(zscore("order_count", "baseline_avg", "baseline_stddev"), 2)
                    .alias("z_score"))


def check_daily_order_volume(fct_orders: DataFrame, params: Params, weeks: int = 12,
                             min_weeks: int = 8, threshold: float = 3.0) -> DataFrame:
    """Q9 (warn): recent days [run - lookback, run) whose volume is more than
    ``threshold`` sample stddevs from the same-weekday baseline."""
    b = weekday_baseline(daily_order_count(fct_orders), weeks=weeks)
    z = zscore("order_count", "baseline_avg", "baseline_stddev")
    start = params.run_date - dt.timedelta(days=params.lookback_days)
    return (b.where((F.col("baseline_weeks") >= min_weeks) & (F.col("baseline_stddev") > 0)
                    & (F.col("ordered_date") >= F.lit(start)) & (F.col("ordered_date") < F.lit(params.run_date))
                    & (F.abs(z) > threshold))
            .select("ordered_date", "order_count", F.round("baseline_avg", 1).alias("baseline_avg"),
                    F.round(z, 2).alias("z_score")))


def check_fact_not_truncated(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Q10 (error): staging and fact row counts differ.

    Both counts come from one aggregate over a tagged union (no join of two
    one-row frames).
    """
    tagged = (staging.select(F.lit(1).alias("_s"), F.lit(0).alias("_f"))
              .unionByName(fact.select(F.lit(0).alias("_s"), F.lit(1).alias("_f"))))
    counts = tagged.agg(F.sum("_s").cast("bigint").alias("staging_rows"),
                        F.sum("_f").cast("bigint").alias("fact_rows"))
    return (counts.withColumn("missing_rows", F.col("staging_rows") - F.col("fact_rows"))
            .where(F.col("staging_rows") != F.col("fact_rows")))


def check_equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row when the two relations have different row counts."""
    return check_fact_not_truncated(a, b).withColumnsRenamed(
        {"staging_rows": "rows_a", "fact_rows": "rows_b", "missing_rows": "diff"})


def check_null_proportion(df: DataFrame, col: str, max_proportion: float) -> DataFrame:
    """One row when the share of NULLs in ``col`` exceeds the limit."""
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_if(F.col(col).isNull()).alias("null_count"))
    return (agg.withColumn("null_proportion",
                           F.round(F.try_divide(F.col("null_count").cast("double"),
                                                F.col("row_count").cast("double")), 4))
            .where(F.col("null_proportion") > max_proportion))


def check_recency(df: DataFrame, col: str, now: dt.datetime, max_age_hours: float) -> DataFrame:
    """One row when the newest value of ``col`` is older than the limit."""
    latest = df.agg(F.max(col).alias("latest"))
    age = (F.unix_seconds(F.lit(now.isoformat(sep=" ")).cast("timestamp"))
           - F.unix_seconds(F.col("latest"))) / 3600.0
    return (latest.withColumn("age_hours", F.round(age, 2))
            .where(F.col("latest").isNull() | (F.col("age_hours") > max_age_hours)))


# ---------------------------------------------------------------- contracts (Q12, Q13)
class ContractError(ValueError):
    pass


def enforce_contract(df: DataFrame, contract: StructType, not_null: Iterable[str] = ()) -> DataFrame:
    """Check column names, order-insensitive, and types against the contract at
    analysis time; add a runtime assertion for NOT NULL columns (Parquet does
    not enforce nullability on write, trap T9). Returns the frame in contract order."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.fields}
    missing = sorted(set(expected) - set(actual))
    extra = sorted(set(actual) - set(expected))
    wrong = sorted(c for c in expected if c in actual and actual[c] != expected[c])
    if missing or extra or wrong:
        raise ContractError(f"contract mismatch: missing={missing} extra={extra} wrong_type={wrong}")
    out = df.select(*[f.name for f in contract.fields])
    nn = list(not_null)
    if not nn:
        return out
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in nn])
    msg = "not-null contract violated on one of: " + ", ".join(nn)
    # assert_true yields NULL or raises; folding it into a carried column keeps
    # column pruning from removing the assertion.
    first = nn[0]
    guarded = F.coalesce(F.assert_true(ok, F.lit(msg)).cast(expected[first]), F.col(first))
    return out.withColumn(first, guarded)


# ---------------------------------------------------------------- freshness (Q14, Q17)
@dataclass(frozen=True)
class Freshness:
    warn_after_hours: float | None
    error_after_hours: float | None


# Freshness limits per source (hours). Events 6/24; products
# are exempt (insert-only master); every other source 12/36.
FRESHNESS = {
    "orders": Freshness(12, 36),
    "order_items": Freshness(12, 36),
    "users": Freshness(12, 36),
    "inventory_items": Freshness(12, 36),
    "distribution_centers": Freshness(12, 36),
    "events": Freshness(6, 24),
    "products": Freshness(None, None),
}


def source_freshness(tables: dict[str, DataFrame], now: dt.datetime,
                     limits: dict[str, Freshness] | None = None) -> DataFrame:
    """Per source: newest load time, age in hours at ``now`` and status
    (pass / warn / error / exempt). A source that never loaded is an error; ages are
    compared in seconds, unrounded. An observation, never a gate (Q17)."""
    limits = limits or FRESHNESS
    now_ts = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    rows = []
    for name, df in sorted(tables.items()):
        lim = limits.get(name, Freshness(None, None))
        seconds = F.unix_seconds(now_ts) - F.unix_seconds(F.col("max_loaded_at"))
        age = F.round(seconds / 3600.0, 2)
        status = F.lit("exempt") if lim.error_after_hours is None else (
            F.when(F.col("max_loaded_at").isNull() | (seconds > lim.error_after_hours * 3600), "error")
            .when(seconds > lim.warn_after_hours * 3600, "warn").otherwise("pass"))
        rows.append(max_loaded_at(df).select(F.lit(name).alias("source_name"), "max_loaded_at",
                                             age.alias("age_hours"), status.alias("freshness_status")))
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------- declared checks as data (App. A)
@dataclass(frozen=True)
class CheckSpec:
    model: str
    column: str | None
    kind: str  # not_null | unique | accepted_values | relationships | expression | unique_combination
    args: tuple = field(default_factory=tuple)
    severity: str = "error"
    where: str | None = None  # the column that marks the rows it is for

    @property
    def name(self) -> str:
        col = self.column or "+".join(self.args)
        return f"{self.kind}__{self.model}__{col}"


@dataclass(frozen=True)
class RowsIn:
    """The model whose rows hold those of another: all, or those that column ``where`` marks,
    with their checked columns as they are, or by the new ``names``."""
    model: str
    names: dict[str, str] = field(default_factory=dict)
    where: str | None = None


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)


def _key_sql(cols: tuple[str, ...]) -> str:
    if len(cols) == 1:
        return f"CAST({_q(cols[0])} AS STRING)"
    return "to_json(struct(" + ", ".join(_q(c) for c in cols) + "))"


def _failure_sql(spec: CheckSpec) -> str:
    c = _q(spec.column)
    if spec.kind == "not_null":
        return f"{c} IS NULL"
    if spec.kind == "accepted_values":
        return f"NOT ({c} IN ({', '.join(_lit(v) for v in spec.args)}))"
    if spec.kind == "expression":
        return f"NOT ({c} {spec.args[0]})"
    raise ValueError(spec.kind)


def _owner(spec: CheckSpec) -> tuple[str, str] | None:
    """The (model, column) whose keys a unique check counts or a relationship asks for."""
    if spec.kind == "unique":
        return spec.model, spec.column
    return (spec.args[0], spec.args[1]) if spec.kind == "relationships" else None


def _key_groups(specs: dict[int, CheckSpec]) -> dict[int, int]:
    """The id under which each check's records are counted. A unique check has room for one
    more on its key, which then travels once for both: a relationship to that key, or
    the unique check for marked rows of the same model."""
    unique = {_owner(s): i for i, s in specs.items() if s.kind == "unique" and not s.where}
    return {i: unique.pop(_owner(s), i) if s.kind == "relationships" or s.kind == "unique" and s.where else i for i, s in specs.items()}


def _tags(model: str, specs: dict[int, CheckSpec], groups: dict[int, int]) -> str | None:
    """SQL for the array of check records one row of ``model`` contributes:
    (check id, key, owners, rows); NULL entries are dropped by the caller. A row that owns
    a key counts as an owner; a failing row, a child or a marked row that owns a key as a row. Built as
    one expression string so a model's tags cost one parse, not hundreds of
    JVM calls."""
    tags = {}  # one for each id and role: the owners of a key that two checks ask for

    def tag(i, key, owns, *conditions):
        keep = " AND ".join(c for c in (*conditions, specs[i].where and not owns and _q(specs[i].where)) if c)
        t = (f"named_struct('check_id', {groups[i]}, 'key', {key}, "
             f"'owners', {int(owns)}L, 'rows', {int(not owns)}L)")
        tags.setdefault((groups[i], owns), f"CASE WHEN {keep} THEN {t} END" if keep else t)

    for i, s in specs.items():
        if s.model == model and s.kind in ("not_null", "accepted_values", "expression"):
            tag(i, "CAST(NULL AS STRING)", False, _failure_sql(s))
        elif s.model == model and s.kind == "unique_combination":
            tag(i, _key_sql(tuple(s.args)), not s.where)
        if _owner(s) and _owner(s)[0] == model:
            column = _owner(s)[1]
            tag(i, _key_sql((column,)), s.kind == "relationships" or not s.where, f"{_q(column)} IS NOT NULL")
        if s.model == model and s.kind == "relationships":
            tag(i, _key_sql((s.column,)), False, f"{_q(s.column)} IS NOT NULL")
    if not tags:
        return None
    return "filter(array(" + ", ".join(tags.values()) + "), t -> t IS NOT NULL)"


def _place(spec: CheckSpec, rows_in: dict[str, RowsIn]) -> CheckSpec:
    """The check on the model that it is read from, by the names that its columns have there."""
    at = rows_in.get(spec.model, RowsIn(spec.model))
    args = spec.args
    if spec.kind == "relationships":
        parent = rows_in.get(args[0], RowsIn(args[0]))
        if parent.where:  # the other rows would own keys too
            parent = RowsIn(args[0])
        args = (parent.model, parent.names.get(args[1], args[1]))
    elif spec.kind == "unique_combination":
        args = tuple(at.names.get(c, c) for c in args)
    return replace(spec, model=at.model, column=at.names.get(spec.column, spec.column), args=args, where=at.where)


def declared_check_counts(specs: Iterable[CheckSpec], models: Callable[[str], DataFrame],
                          rows_in: dict[str, str | RowsIn] | None = None) -> DataFrame:
    """One row per declared check: (check_name, model, kind, severity, failures).

    Every model is read once: each of its rows emits one small record per row-level
    check that it fails (a healthy table emits none) and one per key that takes part
    in a check (unique key, relationship child or parent key), tagged with an integer
    check id. One aggregation over (check, key) then evaluates all checks:
      row-level     failures = failing rows
      unique        failures = keys with more than one owner
      relationships failures = child rows whose key has no owner
    A parent key that is checked for uniqueness too is counted once for both.
    The aggregates are sums, so a hot key is combined map-side
    before the shuffle. Keys that are digests travel packed.

    ``rows_in`` names, for a model, another one that selects from it row by row and
    keeps its checked columns as they are (``RowsIn``: renames them, or marks the rows): the checks of both
    are read from the rows of the latter, and a check that both declare is counted once, for both.
    """
    specs = list(specs)
    read_from = {m: at if isinstance(at, RowsIn) else RowsIn(at) for m, at in (rows_in or {}).items()}
    placed = [_place(s, read_from) for s in specs]
    first: dict[tuple, int] = {}
    counted_as = [first.setdefault((s.model, s.column, s.kind, s.args, s.where), i) for i, s in enumerate(placed)]
    counted = {i: placed[i] for i in first.values()}
    groups = _key_groups(counted)
    involved = sorted({s.model for s in placed} | {s.args[0] for s in placed if s.kind == "relationships"})
    parts = []
    for m in involved:
        tags = _tags(m, counted, groups)
        if tags:
            parts.append(models(m).select(F.explode(F.expr(tags)).alias("t")).select("t.*"))
    records = reduce(DataFrame.unionByName, parts)
    per_key = (records.groupBy("check_id", packed_key("key").alias("key"))
               .agg(F.sum("owners").alias("owners"), F.sum("rows").alias("rows")))
    counts = per_key.groupBy("check_id").agg(F.count_if(F.col("owners") > 1).alias("repeated"),
                                             F.count_if(F.col("rows") > 1).alias("repeated_rows"),
                                             F.sum(F.when(F.col("owners") == 0, F.col("rows"))).alias("lone"))
    spark = counts.sparkSession
    meta = spark.createDataFrame([(groups[i], s.name, s.model, s.kind, s.severity, placed[i].where is not None) for i, s in zip(counted_as, specs)],
                                 "check_id int, check_name string, model string, kind string, severity string, marked boolean")
    repeated = F.when(F.col("marked"), F.col("repeated_rows")).otherwise(F.col("repeated"))
    failures = F.when(F.col("kind").isin("unique", "unique_combination"), repeated).otherwise(F.col("lone"))
    return F.broadcast(meta).join(counts, "check_id", "left").select(
        "check_name", "model", "kind", "severity",
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))


# ---------------------------------------------------------------- runner (Q15, Q16)
class CheckFailed(RuntimeError):
    pass


@dataclass
class CheckResult:
    name: str
    severity: str
    failures: int


def run_checks(checks: dict[str, tuple[str, Callable[[], DataFrame]]],
               store: Callable[[str, DataFrame], None] | None = None) -> list[CheckResult]:
    """Run named checks ``{name: (severity, () -> failing rows)}``.

    ``warn`` failures are recorded (and stored when ``store`` is given);
    any ``error`` failure raises after all checks ran, so the next layer is
    not built. Only a count leaves the cluster.
    """
    results = []
    for name, (severity, build) in checks.items():
        failing = build()
        if store is not None and severity == "warn":
            store(name, failing)
        results.append(CheckResult(name, severity, failing.count()))
    errors = [r for r in results if r.severity == "error" and r.failures]
    if errors:
        raise CheckFailed("; ".join(f"{r.name}: {r.failures} failing rows" for r in errors))
    return results
