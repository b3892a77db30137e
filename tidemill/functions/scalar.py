"""Column helpers for the places where Spark's defaults differ from the wanted result."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def epoch_seconds(ts: Column | str) -> Column:
    """Seconds since 1970 with the fraction, for timestamps with or without a zone."""
    return F.unix_micros(_c(ts).cast("timestamp")) / F.lit(1_000_000.0)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in seconds with the fraction; negative when ``end`` is first."""
    start, end = _c(start).cast("timestamp"), _c(end).cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def round_int(col: Column | str) -> Column:
    """Cast to a whole number by rounding half away from zero; a plain cast truncates."""
    return F.round(_c(col), 0).cast("long")


def whole_div(a: Column, b: Column) -> Column:
    """Integer division; ``/`` would give a fraction."""
    return F.call_function("div", a, b)


def weekday_name(ts: Column | str) -> Column:
    """Lower-case English day name without padding."""
    return F.lower(F.date_format(_c(ts), "EEEE"))


def month_start(ts: Column | str) -> Column:
    return F.date_trunc("month", _c(ts))


def parse_or_null(text: Column | str, fmt: str | None = None) -> Column:
    """Timestamp from text; null where it does not parse."""
    return F.try_to_timestamp(_c(text), F.lit(fmt) if fmt else None)


def parse_or_fail(text: Column | str, fmt: str | None = None) -> Column:
    """Timestamp from text; the query fails where it does not parse."""
    return F.to_timestamp(_c(text), fmt) if fmt else F.to_timestamp(_c(text))


def stamp_text(ts: Column | str, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    """The time stamp used in file names."""
    return F.date_format(_c(ts), fmt)


def part_after(text: Column | str, sep: str) -> Column:
    """The second part of the text split at ``sep``, taken as it is written; null when there is none."""
    return F.get(F.split(_c(text), _literal(sep)), 1)


def _literal(sep: str) -> str:
    """A pattern for exactly this text."""
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def blank(text: Column | str) -> Column:
    """True for null, empty and all-white text; any white space counts, as for a strip."""
    return F.coalesce(~_c(text).rlike(r"(?U)\S"), F.lit(True))


def too_long(text: Column | str, limit: int) -> Column:
    return F.length(_c(text)) > limit


def money(col: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Fixed-point amount, so that sums do not depend on the order of rows."""
    return _c(col).cast(f"decimal({precision},{scale})")


def two_decimals(col: Column | str) -> Column:
    """Fixed-point amount from a double that holds two decimals.

    Goes by whole hundredths, which is several times faster than the cast by way of text; a third
    decimal would be rounded in binary, so other doubles should use ``money``.
    """
    hundredths = F.round(_c(col) * 100).cast("bigint").cast("decimal(15,0)")
    return (hundredths * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")


def mean_money(col: Column | str) -> Column:
    """Mean of a fixed-point column from its exact sum; null when there are no values."""
    return F.sum(_c(col)).cast("double") / F.nullif(F.count(_c(col)), F.lit(0)).cast("double")


def split_cells(text: Column | str, sep: str = ",") -> Column:
    """Multi-valued cell to a list of trimmed parts; ``sep`` is taken as it is written."""
    return F.transform(F.split(_c(text), _literal(sep)), lambda part: F.trim(part))
