"""Date / time scalar rules.

All are Column -> Column expressions (JVM side, codegen); parsing is
lenient through ``try_to_timestamp`` because ANSI casts raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats the source writes status times in.  The second
# pattern accepts single-digit day / month (the strict parser rejects them).
STATUS_TIME_FORMATS = ["dd/MM/yyyy hh:mm:ss a", "d/M/yyyy h:mm:ss a"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_status_time(c, formats: list[str] | None = None) -> Column:
    """Text ``DD/MM/YYYY HH12:MI:SS AM`` -> timestamp, bad text -> NULL."""
    c = _c(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in (formats or STATUS_TIME_FORMATS)])


def weekday_name(d) -> Column:
    """``TO_CHAR(d, 'Day')``: English day name blank-padded to 9."""
    return F.rpad(F.date_format(_c(d), "EEEE"), 9, " ")


def week_number(d) -> Column:
    """``strftime('%U') + 1``: Sunday-based week of year, plus one."""
    d = _c(d)
    return F.floor((F.dayofyear(d) - 1 + 7 - (F.dayofweek(d) - 1)) / 7).cast("int") + 1


def excel_date(n) -> Column:
    """Spreadsheet serial day number -> date (epoch 1899-12-30)."""
    return F.date_add(F.lit("1899-12-30").cast("date"), _c(n).cast("int"))


def hours_between(a, b) -> Column:
    """(b - a) in hours as double (NULL if either is NULL)."""
    return (F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))) / F.lit(3.6e9)


def days_between_floor(a, b) -> Column:
    """Whole days of (b - a), floored like ``Timedelta.days``."""
    return F.floor(
        (F.unix_micros(_c(b).cast("timestamp")) - F.unix_micros(_c(a).cast("timestamp"))) / F.lit(86_400_000_000)
    ).cast("bigint")


def package_aging(ts, as_of: str) -> Column:
    """Days from ``ts`` to ``as_of`` rounded half-to-even, NULL -> 0."""
    secs = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(_c(ts).cast("timestamp"))) / 1e6
    return F.coalesce(F.bround(secs / 86400.0, 0), F.lit(0.0))


# ------------------------------------------------------------------ X01/X02
def date_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    c = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}date": F.to_date(c),
            f"{prefix}hour": F.hour(c),
            f"{prefix}month": F.month(c),
            f"{prefix}year_month": F.date_format(c, "yyyy-MM"),
            f"{prefix}weekday": weekday_name(F.to_date(c)),
            f"{prefix}week": week_number(F.to_date(c)),
        }
    )


# ------------------------------------------------------------------ X03
def journey_durations(df: DataFrame, pairs: list[tuple[str, str, str]], age: tuple[str, str, str] | None = None):
    """Add ``name = hours(start -> end)`` for each (name, start, end); with
    ``age=(name, start, as_of)`` also whole days from start to as_of."""
    cols = {name: hours_between(a, b) for name, a, b in pairs}
    if age is not None:
        name, start, as_of = age
        cols[name] = days_between_floor(start, F.lit(as_of).cast("timestamp"))
    return df.withColumns(cols)


# ------------------------------------------------------------------ X26
def coerce_timestamps(df: DataFrame, cols: list[str], formats: list[str] | None = None) -> DataFrame:
    """Parse each text column of ``cols``; blank or bad text -> NULL."""
    return df.withColumns({c: parse_status_time(F.nullif(F.trim(F.col(c)), F.lit("")), formats) for c in cols})
