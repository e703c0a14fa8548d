"""Column expressions shared by cleaning, metrics and views.

None of them raises on bad data, whatever ``spark.sql.ansi.enabled`` says: a value that cannot be
read becomes NULL (or the stated default). All stay inside Catalyst; there are no UDFs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Fixed formats of the inputs.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"  # yyyy-MM-dd
ISO_UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


# ---- text -------------------------------------------------------------------------------------


def text(column: ColumnLike, default: str | None = None, upper: bool = False) -> Column:
    """Trimmed text. A blank stays ``''``; only NULL takes the default."""
    out = F.trim(_c(column))
    if upper:
        out = F.upper(out)
    return out if default is None else F.coalesce(out, F.lit(default))


def first_text(*columns: ColumnLike) -> Column:
    """The first non-NULL trimmed text."""
    return F.coalesce(*(F.trim(_c(c)) for c in columns))


# ---- numbers ----------------------------------------------------------------------------------


# Casts of unreadable text raise inside Spark and are caught there, which costs microseconds per cell.
# These patterns let only readable text reach a cast.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?\s*$"
# Whole parts far beyond 32 bits are refused here, too, as the cast to int would raise on each of them. Nothing is tried twice (``+``).
_DIGITS = r"^\s*+[+-]?+0*(?:\d{1,9}+|1\d{9}+|2[01]\d{8}+)(?:\.\d*+)?+\s*+$"


def lenient_double(column: ColumnLike) -> Column:
    """A double, NULL when the text is not a plain or scientific number."""
    text_form = _c(column).cast("string")
    return F.when(text_form.rlike(_NUMBER), text_form.try_cast("double"))


def lenient_int(column: ColumnLike, source: T.DataType | None = None) -> Column:
    """Integer part of a number, NULL when there is none or it does not fit.

    Text keeps the digits before the point (``'3.7'`` is 3), but only if the whole text is a number:
    ``'3.x'``, ``'1e3'`` and ``'3000000000'`` are NULL. Numeric columns are truncated directly, so
    pass their type as ``source``.
    """
    col = _c(column)
    if source is not None and not isinstance(source, T.StringType):
        return col.try_cast("int")
    return F.when(col.rlike(_DIGITS), col.cast("double").try_cast("int"))


def int_or_zero(column: ColumnLike, source: T.DataType | None = None) -> Column:
    return F.coalesce(lenient_int(column, source), F.lit(0))


def money(column: ColumnLike) -> Column:
    """Exact decimal of a double amount, so sums do not depend on the order rows are read in."""
    return _c(column).try_cast("decimal(28,6)")


def half_up(column: ColumnLike, digits: int) -> Column:
    return F.round(_c(column), digits)


def clamp(column: ColumnLike, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), _c(column)))


def ratio(numerator: ColumnLike, denominator: ColumnLike, digits: int, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale`` rounded; NULL when the denominator is 0 or NULL."""
    quotient = F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))
    return F.round(quotient * F.lit(scale) if scale != 1.0 else quotient, digits)


def pct_change(current: ColumnLike, previous: ColumnLike) -> Column:
    """Percentage change; 0 where there is no positive previous value."""
    cur, prev = _c(current), _c(previous)
    return F.when(prev > 0, F.try_divide((cur - prev).cast("double"), prev.cast("double")) * 100).otherwise(
        F.lit(0.0)
    )


def direction(change: ColumnLike) -> Column:
    delta = _c(change)
    return F.when(delta > 0, "INCREASING").when(delta < 0, "DECREASING").otherwise("STABLE")


def per_90(total: ColumnLike, minutes: ColumnLike, cap: float = 3.0, digits: int = 4) -> Column:
    """Events per 90 minutes, capped; NULL below 90 minutes."""
    played = _c(minutes)
    rate = F.try_divide(_c(total).cast("double"), played.cast("double") / 90)
    return F.round(F.when(played >= 90, F.least(rate, F.lit(cap))), digits)


def height_cm(column: ColumnLike, nearest: bool = False) -> Column:
    """Height in whole centimetres. Values under 10 are metres; 0 and NULL are unknown.

    Truncation turns 1.15 m into 114 because 1.15 * 100 is 114.99…; ``nearest=True`` rounds instead.
    """
    number = lenient_double(column)
    metres = number * 100
    if nearest:
        metres = F.round(metres)
    return (
        F.when(number.isNull() | (number == 0), F.lit(None).cast("int"))
        .when(number < 10, metres.try_cast("int"))
        .otherwise(number.try_cast("int"))
    )


# ---- dates and times --------------------------------------------------------------------------


def lenient_date(column: ColumnLike, source: T.DataType | None = None) -> Column:
    """A ``yyyy-MM-dd`` date, NULL when it is not one."""
    col = _c(column)
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    shown = col.cast("string")
    return F.when(shown.rlike(DATE_PATTERN), shown.try_cast("date"))


def iso_utc(column: ColumnLike) -> Column:
    """Timestamp of ISO-8601 text with a literal ``Z``."""
    return F.try_to_timestamp(_c(column), F.lit(ISO_UTC_PATTERN))


def in_zone(timestamp: ColumnLike, zone: str) -> Column:
    """Wall-clock time of a UTC timestamp in ``zone``."""
    return F.from_utc_timestamp(_c(timestamp), zone)


def as_date(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def age_years(birth: ColumnLike, as_of: dt.date | str | None = None) -> Column:
    """Difference of calendar years, not birthday-exact."""
    return F.year(as_date(as_of)) - F.year(_c(birth))


# ---- labels -----------------------------------------------------------------------------------


def label_by_floor(column: ColumnLike, floors: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose floor the value exceeds (strictly); ``default`` otherwise, NULL included."""
    out = F.lit(default)
    for floor, label in reversed(floors):
        out = F.when(_c(column) > floor, label).otherwise(out)
    return out


def label_by_ceiling(
    column: ColumnLike, ceilings: Sequence[tuple[int, str]], above: str, missing: str
) -> Column:
    """First label whose (inclusive) ceiling holds the value."""
    out = F.when(_c(column).isNotNull(), above).otherwise(missing)
    for ceiling, label in reversed(ceilings):
        out = F.when(_c(column) <= ceiling, label).otherwise(out)
    return out


def scoreline(home: ColumnLike, home_goals: ColumnLike, away_goals: ColumnLike, away: ColumnLike) -> Column:
    """``Home 2-1 Away``; an unknown score shows as 0, an unknown team makes the line NULL."""
    shown = [F.coalesce(_c(g).cast("string"), F.lit("0")) for g in (home_goals, away_goals)]
    return F.concat(_c(home), F.lit(" "), shown[0], F.lit("-"), shown[1], F.lit(" "), _c(away))


def leader(left: ColumnLike, right: ColumnLike, if_left, if_right, otherwise) -> Column:
    """Three-way comparison label; NULL operands compare as neither."""
    left, right = _c(left), _c(right)
    return F.when(left > right, if_left).when(left < right, if_right).otherwise(otherwise)
