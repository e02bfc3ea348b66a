"""Date parts and calendar buckets of a sale timestamp (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hour buckets in the order they are tested; the first match
# wins, so hour 13 is 'Noon' even though the afternoon list names it too.
TIME_OF_DAY = [
    ("Morning", [6, 7, 8, 9, 10]),
    ("Noon", [11, 12, 13]),
    ("Afternoon", [13, 14, 15, 16]),
]
TIME_OF_DAY_ELSE = "Night"

# Month buckets, first match wins.
SEASONS = [
    ("Winter", [12, 1, 2]),
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
]
SEASON_ELSE = "Fall"

# Names counted as weekdays, and the weekday flag labels.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
YES, NO = "Yes", "No"

# Constant time-member attributes.
NOT_A_HOLIDAY = "Not a holiday"
NO_EVENT = "No event"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(value, buckets, otherwise) -> Column:
    """Searched CASE over IN-lists; the first matching bucket wins."""
    value = _col(value)
    expr = None
    for label, members in buckets:
        cond = value.isin(members)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise) if otherwise is not None else expr


def time_of_day(ts) -> Column:
    return bucket(F.hour(_col(ts)), TIME_OF_DAY, TIME_OF_DAY_ELSE)


TIME_OF_DAY_LABELS = [label for label, _ in TIME_OF_DAY] + [TIME_OF_DAY_ELSE]


def time_of_day_code(ts) -> Column:
    """Index of the time-of-day bucket (0-based, same first-match rule) as a
    tinyint: a compact grouping key; :func:`time_of_day_label` maps it back."""
    buckets = [(i, hours) for i, (_, hours) in enumerate(TIME_OF_DAY)]
    return bucket(F.hour(_col(ts)), buckets, len(TIME_OF_DAY)).cast("tinyint")


def time_of_day_label(code) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in TIME_OF_DAY_LABELS]), _col(code).cast("int") + 1)


def season(ts) -> Column:
    return bucket(F.month(_col(ts)), SEASONS, SEASON_ELSE)


def day_name(ts, pad: bool = False) -> Column:
    """Full English weekday name ('Monday'). ``pad=True`` blank-pads to nine
    characters like a fixed-width 'Day' format, which is what makes an exact
    weekday test fail for every day but Wednesday; off by default."""
    name = F.date_format(_col(ts), "EEEE")
    return F.rpad(name, 9, " ") if pad else name


def weekday_flag(day_of_week) -> Column:
    return F.when(_col(day_of_week).isin(WEEKDAYS), YES).otherwise(NO)


def date_parts(ts) -> list[Column]:
    """year, month, day, hour as int columns."""
    ts = _col(ts)
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour")]


def calendar_columns(ts) -> list[Column]:
    """The six calendar attributes of a sale, as named columns."""
    ts = _col(ts)
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), season(ts).alias("season"),
            F.dayofmonth(ts).alias("day"), day_name(ts).alias("day_of_week"),
            time_of_day(ts).alias("time_of_day")]


def time_member_columns() -> list[Column]:
    """Derived time-member attributes from a row holding ``day_of_week``."""
    return [weekday_flag("day_of_week").alias("is_weekday"),
            F.lit(NOT_A_HOLIDAY).alias("holiday"), F.lit(NO_EVENT).alias("event")]


def calendar_from_date(year="year", month="month", day="day", pad_day_name: bool = False) -> list[Column]:
    """season and day_of_week of a (year, month, day) moment."""
    date = F.make_date(_col(year), _col(month), _col(day))
    return [season(date).alias("season"), day_name(date, pad_day_name).alias("day_of_week")]
