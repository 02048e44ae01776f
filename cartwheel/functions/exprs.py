"""Column-returning helpers: keys, money, ratios, dates, labels.

All are built-in Spark expressions (JVM-side, whole-stage codegen); no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values.
# Placeholder the public surrogate-key macro substitutes for NULL inputs, and
# the separator it joins parts with.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# Money type: exact decimal. (18, 9) keeps the nine fractional digits of the
# warehouse NUMERIC while leaving Spark room for exact + - * and sums.
MONEY = DecimalType(18, 9)
# Order-item statuses that are not recognised as revenue.
NON_REVENUE_STATUSES = ("cancelled", "returned")
# Label for a missing entry channel in the funnel.
UNKNOWN_CHANNEL = "(unknown)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a timestamp (NTZ is read as UTC)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def surrogate_key(*cols) -> Column:
    """md5 of the parts joined by '-', NULL parts replaced by a placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def packed_key(c) -> Column:
    """A surrogate key as its 16 bytes, half of what its text takes in a shuffle; any other text travels as it is."""
    digest = F.unhex(_col(c))
    same = F.lower(F.hex(digest)) == _col(c)
    return F.struct(F.when(same, digest).alias("digest"), F.when(same, F.lit(None)).otherwise(_col(c)).alias("text"))


def unpacked_key(c: str) -> Column:
    """The text that ``packed_key`` was given."""
    return F.coalesce(F.col(f"{c}.text"), F.lower(F.hex(f"{c}.digest")))


def key_from_parts(c, *parts) -> Column:
    """A surrogate key for a row that holds its parts: only whether it is their key, and otherwise its text, need to travel."""
    made = _col(c).eqNullSafe(surrogate_key(*parts))
    return F.struct(made.alias("made"), F.when(~made, _col(c)).alias("text"))


def key_of_parts(c: str, *parts) -> Column:
    """The key that ``key_from_parts`` was given, from the same parts."""
    return F.when(F.col(f"{c}.made"), surrogate_key(*parts)).otherwise(F.col(f"{c}.text"))


def money(c) -> Column:
    """Float or wider decimal → exact money decimal."""
    return _col(c).cast(MONEY)


# Operand type for exact ratios. Spark shrinks the scale of a quotient of two
# (38, s) decimals to 6 digits, and rounding that again to 4 digits can go the
# wrong way (12.97034979 → 12.970350 → 12.9704). At (28, 9) the quotient keeps
# 10 fractional digits.
RATIO_OPERAND = DecimalType(28, 9)


def guarded_rate(numerator, denominator, scale: int = 4) -> Column:
    """round(n / d, scale) half-up when d > 0, else NULL (exact decimal division)."""
    n, d = _col(numerator).cast(RATIO_OPERAND), _col(denominator).cast(RATIO_OPERAND)
    return F.when(d > 0, F.round(n / d, scale))


def safe_ratio(numerator, denominator, scale: int = 4) -> Column:
    """round(n / d, scale) as double; NULL when d is 0 or NULL (safe divide)."""
    return F.round(F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double")), scale)


def is_revenue_recognized(status) -> Column:
    """status NOT IN (cancelled, returned); NULL status stays NULL (trap T5)."""
    return ~_col(status).isin(*NON_REVENUE_STATUSES)


def recognized_or_zero(flag, value) -> Column:
    """value when the flag is true, else 0 (NULL flag → 0, like CASE WHEN)."""
    return F.when(_col(flag), _col(value)).otherwise(F.lit(0).cast(MONEY))


def days_between(later_ts, earlier_date) -> Column:
    """Whole days from a date to the date of a timestamp."""
    return F.datediff(F.to_date(_col(later_ts)), _col(earlier_date))


def whole_units_between(unit: str, start, end) -> Column:
    """Whole elapsed units (MINUTE, SECOND) from start to end, truncating."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def age_group(age) -> Column:
    """Decade label; NULL age falls through to the last bucket (trap T6)."""
    a = _col(age)
    return (F.when(a < 20, "10s").when(a < 30, "20s").when(a < 40, "30s")
            .when(a < 50, "40s").when(a < 60, "50s").otherwise("60s+"))


def email_hash(email) -> Column:
    return F.sha2(F.lower(F.trim(_col(email))), 256)


def email_domain(email) -> Column:
    """Lower-cased part after '@'; NULL when there is none (safe offset)."""
    return F.lower(F.get(F.split(_col(email), "@"), 1))


def month_start(d) -> Column:
    return F.trunc(_col(d), "month")


def period_start(d, grain: str) -> Column:
    """Start of the ISO week (Monday), month or year containing date d."""
    if grain not in ("week", "month", "year"):
        raise ValueError(f"unknown grain {grain!r}")
    return F.trunc(_col(d), grain)


def months_between_starts(later, earlier) -> Column:
    """Month boundaries crossed between two month-first dates."""
    return F.months_between(_col(later), _col(earlier)).cast("int")


def session_id(user_id, started_at) -> Column:
    """Deterministic session id: '<user>-<yyyyMMddHHmmss of session start>', NULL if either part is."""
    return F.concat(_col(user_id).cast("string"), F.lit("-"),
                    F.date_format(_col(started_at), "yyyyMMddHHmmss"))


def in_window(c, start, end) -> Column:
    """Inclusive date range; start/end are dates or ISO strings."""
    return _col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
