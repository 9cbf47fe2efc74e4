"""Timestamps of many forms as UTC instants and as ISO text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyweave.functions.numbers import to_double
from tallyweave.functions.text import WHITE_SPACE

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Numbers above this are milliseconds, and the range of years 1 to 9999.
MILLIS_ABOVE = 1e11
FIRST_SECOND = -62135596800.0
LAST_SECOND = 253402300799.0
# A text has to start with a full date; a bare time would be read as a time of today.
ISO_START = r"^\d{4}-\d{2}-\d{2}"
# Further layouts that are understood; sections in brackets may be absent.
CLOCK = "[ h:mm:ss a][ h:mm a][ H:mm:ss][ H:mm]"
SLASHED = "[yyyy/M/d][M/d/yyyy]" + CLOCK
# The month first, and the day first where that is no date.
DOTTED, DOTTED_DAY = "M.d.yyyy" + CLOCK, "d.M.yyyy" + CLOCK
UNPADDED = "yyyy-M-d" + CLOCK
SPELLED = "[MMMM d, yyyy][MMM d, yyyy][MMMM d yyyy][MMM d yyyy][d MMMM yyyy][d MMM yyyy][d-MMM-yyyy]" + CLOCK + "[ Z]"
YEAR_LAST = "MMM d H:mm:ss yyyy"
COMPACT = "yyyyMMdd'T'HHmmss[X]"
_WEEKDAY = r"^[A-Za-z]{3}, "
_BARE_WEEKDAY = r"^[A-Za-z]{3} (?=[A-Za-z]{3} +\d)"
# Eight digits that form a date are one, and no epoch number of the year 1970.
DIGITS = r"^(19|20)\d{2}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$"


def epoch_time(number: Column) -> Column:
    """Instant of an epoch number in seconds or milliseconds; null outside years 1 to 9999."""
    scale = F.when(number > MILLIS_ABOVE, F.lit(1000.0)).otherwise(F.lit(1.0))
    inside = (number >= FIRST_SECOND) & (number <= LAST_SECOND * 1000.0)
    return F.when(inside, F.timestamp_seconds(number / scale))


def epoch_seconds_time(number: Column) -> Column:
    """Instant of an epoch number that is always in seconds."""
    return F.when((number >= FIRST_SECOND) & (number <= LAST_SECOND), F.timestamp_seconds(number))


def text_time(text: Column) -> Column:
    """Instant of a trimmed date text; a text without a zone is UTC."""
    def read(value: Column, layout: str) -> Column:
        return F.try_to_timestamp(value, F.lit(layout))

    return (
        F.when(text.rlike(ISO_START), text.try_cast("timestamp"))
        .when(text.contains("/"), read(text, SLASHED))
        .when(text.rlike("^[0-9]{8}T"), read(text, COMPACT))
        .when(text.rlike(DIGITS), read(text, "yyyyMMdd"))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), read(text, UNPADDED))
        .when(text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}"), F.coalesce(read(text, DOTTED), read(text, DOTTED_DAY)))
        .when(text.rlike(_BARE_WEEKDAY), read(F.regexp_replace(F.regexp_replace(text, _BARE_WEEKDAY, ""), " +", " "), YEAR_LAST))
        .when(text.rlike("[A-Za-z]{3}[ -]"), read(F.regexp_replace(text, _WEEKDAY, ""), SPELLED))
    )


def number_in(text: Column) -> Column:
    """The epoch number in a trimmed text. Date texts are told apart before: trying to read
    one as a number costs an exception inside the cast."""
    return F.when(~text.rlike(ISO_START) & ~text.rlike(DIGITS), to_double(text))


def time_of(number: Column, text: Column) -> Column:
    """Instant of a trimmed text and the number in it, if it is one."""
    return F.coalesce(epoch_time(number), text_time(text))


def parse_time(value: Column) -> Column:
    """Instant of a number, a numeric text or a date text, or null."""
    text = F.btrim(value.cast("string"), F.lit(WHITE_SPACE))
    return time_of(number_in(text), text)


def is_iso_time(value: Column) -> Column:
    """Whether a value is a timestamp or the ISO text of one."""
    return F.coalesce(value.cast("string").rlike(ISO_START) & value.try_cast("timestamp").isNotNull(), F.lit(False))


def utc_iso(value: Column) -> Column:
    """``parse_time`` as text with whole seconds, such as ``2024-01-01T00:00:00Z``."""
    return F.date_format(parse_time(value), ISO_FORMAT)


def epoch_iso(number: Column) -> Column:
    """``utc_iso`` for a column that is already numeric."""
    return F.date_format(epoch_time(number.cast("double")), ISO_FORMAT)
