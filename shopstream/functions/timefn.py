"""Date and time column functions.

All of them are built-in expressions, so they stay inside whole-stage
codegen.  Conversions go through TIMESTAMP_NTZ arithmetic so results do not
depend on the session time zone; a zone is an explicit argument instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_epoch_ms(c) -> Column:
    """Wall-clock TIMESTAMP_NTZ read as UTC -> epoch milliseconds (floored)."""
    return F.floor(F.unix_micros(ntz_to_instant(c)) / F.lit(1000)).cast("bigint")


def epoch_ms_to_local(c, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ wall clock in zone ``tz``."""
    utc = F.timestamp_add("MILLISECOND", _c(c), F.expr(_EPOCH_NTZ))
    if tz.upper() == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_ms_to_instant(c) -> Column:
    """Epoch milliseconds -> TIMESTAMP (an instant; usable for watermarks)."""
    return F.timestamp_millis(_c(c))


def ntz_to_instant(c) -> Column:
    """Wall-clock TIMESTAMP_NTZ taken as UTC -> TIMESTAMP instant.

    ``withWatermark`` rejects TIMESTAMP_NTZ, and a plain cast (like
    ``timestampdiff`` on NTZ values) goes through the session zone, which
    moves wall-clock times that fall in a daylight-saving gap.  Rebuilding
    the instant from the fields with an explicit zone does not.
    """
    c = _c(c)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def day_and_hour(local_ntz) -> tuple[Column, Column]:
    """``yyyy-MM-dd`` and ``HH`` strings of a wall-clock timestamp."""
    c = _c(local_ntz)
    return F.date_format(c, "yyyy-MM-dd"), F.date_format(c, "HH")


def split_datetime_text(c) -> tuple[Column, Column]:
    """``'yyyy-MM-dd HH:mm:ss'`` text -> (date text, hour text) (P5)."""
    c = _c(c)
    date_part = F.split_part(c, F.lit(" "), F.lit(1))
    hour_part = F.split_part(F.split_part(c, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
    return date_part, hour_part


def whole_years_between(birthday, on_datetime_text) -> Column:
    """Age: whole days from birthday to the order *date*, divided by 365 and
    truncated toward zero (P14).  The time part of the order time is dropped,
    so negative gaps under a year give 0 and leap days make ages early."""
    on_day = F.try_to_date(F.substring(_c(on_datetime_text), 1, 10), "yyyy-MM-dd")
    text = _c(birthday).cast("string")
    # snapshots may carry the birthday as epoch milliseconds
    days = F.floor(text.try_cast("bigint") / F.lit(86_400_000)).cast("int")
    born = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.date_add(F.lit("1970-01-01").cast("date"), days))
    return (F.datediff(on_day, born) / F.lit(365)).cast("int")


def previous_day_text(c) -> Column:
    """``yyyy-MM-dd`` text of the day before."""
    return F.date_format(F.date_sub(F.to_date(_c(c), "yyyy-MM-dd"), 1), "yyyy-MM-dd")
