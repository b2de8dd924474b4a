"""Date parsing and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANK_CLASS, strip_all

FAILED_PREFIX = "FAILED: "
#: Two-digit years stand for the hundred years from this one on.
FIRST_YEAR = 1970

# ---------------------------------------------------------- free-form dates
# A text is read by token classes, not by a list of formats. One pattern takes a time of day (with zone) out of the text;
# a second one matches the three date tokens (digit runs and month names, with ordinals, weekdays and separators around
# them) and puts them in order. Which token is day, month and year follows from their classes and sizes alone.

#: Parts of a match are joined by a character that blank squeezing has removed before.
_CUT = "\x1f"
# Names of months and weekdays, zone names of times.
_MONTH = ("((?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?"
          "|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?!\\p{L}))")
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAY = "(?:mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)(?!\\p{L})"
_ZONE = "(?: ?(?:z|utc|gmt|[ecmp][sd]t)(?!\\p{L}))?(?: ?[+-]\\d{2}(?::?\\d{2})?)?"
_HOUR, _MINUTE, _HALF = "(?:[01]?\\d|2[0-3])", "[0-5]\\d", " ?[ap]\\.?m(?!\\p{L})\\.?"
_CLOCK = f":{_MINUTE}(?::{_MINUTE}(?:[.,]\\d{{1,9}})?)?"
#: (text before) h:mm[:ss[.f]], or h[:mm[:ss]] am, or after a date T hh[mm[ss]], or after eight digits hhmm[ss] (text after);
#: a time that no clock shows does not match and is no part of a date either.
_TIME = (f"^(.*?)(?:(?<=\\d)t|\\bat\\b)? ?(?:(?<![\\d.:])(?:(?:0?\\d|1[0-2])(?:{_CLOCK})?{_HALF}|{_HOUR}{_CLOCK}(?!{_HALF})){_ZONE}"
         f"|(?<=\\dt)(?:[01]\\d|2[0-3])(?:{_MINUTE}(?:{_MINUTE})?)?{_ZONE}"
         f"|(?<=^\\d{{8}})(?:[01]\\d|2[0-3]){_MINUTE}(?:{_MINUTE})?)(?=[ ,;]|$)(.*)$")
_ENDING = "(?:st|nd|rd|th)?(?!\\p{L})"
#: A comma between two digits is no separator.
_SEP = "(?:(?<=\\d)(?:st|nd|rd|th)(?!\\p{L}))?(?:[ ./;'-]++|,(?!\\d)|(?<!\\d),)*+(?:of (?=\\p{L}))?"


def _number(digits: str) -> str:
    return f"(?<!\\d)({digits})(?!\\d)"


_SHORT, _LATE = _number("\\d{1,2}"), "3[2-9]|[4-9]\\d"
_YEAR, _ANY_YEAR, _SURE_YEAR = _number("\\d{4}"), _number("\\d{4}|\\d{1,2}"), _number(f"\\d{{4}}|{_LATE}")
_PAST_MONTHS = "1[3-9]|2\\d|3[01]"
#: Tokens in order of the text and what they are, the first that matches: with a month's name, four digits or a number over
#: 31 beside a short one are the year, else the year comes last (first before a name at the end). Without a name, a first
#: token of four digits or over 31 starts year-month-day, one over 12 day-month-year, any other month-day-year.
_ORDERS = [
    ([_MONTH, _SURE_YEAR, _SHORT], "myd"), ([_MONTH, _SHORT, _ANY_YEAR], "mdy"),
    ([_SURE_YEAR, _MONTH, _SHORT], "ymd"), ([_SHORT, _MONTH, _ANY_YEAR], "dmy"),
    ([_SHORT, _SURE_YEAR, _MONTH], "dym"), ([_ANY_YEAR, _SHORT, _MONTH], "ydm"),
    ([_SURE_YEAR, _SHORT, _SHORT], "ymd"), ([_number(_PAST_MONTHS), _SHORT, _ANY_YEAR], "dmy"), ([_SHORT, _SHORT, _ANY_YEAR], "mdy"),
]
#: The same for runs of eight or six digits.
_RUNS = [("(\\d{4})(\\d{2})(\\d{2})", "ymd"), (f"({_LATE})(\\d{{2}})(\\d{{2}})", "ymd"),
         (f"({_PAST_MONTHS})(\\d{{2}})(\\d{{2}})", "dmy"), ("(\\d{2})(\\d{2})(\\d{2})", "mdy")]
_DATE = (f"^[ ,;]*(?:(?:{'|'.join(p for p, _ in _RUNS)})(?!\\d)|(?:{_WEEKDAY}[ .,]*)?(?:"
         f"{'|'.join(_SEP.join(tokens) for tokens, _ in _ORDERS)}){_ENDING}(?:[ .,]+{_WEEKDAY})?)[ .,;t]*$")
#: "year, month, day" of whichever order matched: the groups of the others are empty.
_YMD = _CUT.join("".join(f"${3 * n + order.index(part) + 1}" for n, (_, order) in enumerate([*_RUNS, *_ORDERS]))
                 for part in "ymd")


def squeeze_blanks(c: Column) -> Column:
    """Trim every kind of whitespace at both ends and collapse inner runs to one space."""
    return F.regexp_replace(strip_all(c), f" {BLANK_CLASS}++|(?! ){BLANK_CLASS}++", " ")


def _ordered(squeezed: Column) -> Column:
    """[year, month, day] as they are written, or one element where the text is no date."""
    timed = squeezed.rlike(":|\\dt|[ap]\\.?m|^\\d{12}")
    untimed = F.when(timed, F.regexp_replace(squeezed, _TIME, "$1 $2")).otherwise(squeezed)
    return F.split(F.regexp_replace(untimed, _DATE, _YMD), _CUT, -1)


def _squeezed(text: Column) -> Column:
    return F.lower(squeeze_blanks(text))


def _numbers(parts: Column, first_year: int) -> Column:
    year, month, day = (F.get(parts, F.lit(i)) for i in range(3))
    y = year.cast("int")  # the pattern lets digits through only
    named = F.instr(F.lit(_MONTHS), F.substring(month, 1, 3))
    full = F.when(F.length(year) > 2, y).otherwise(F.pmod(y - first_year, F.lit(100)) + first_year)
    # a conditional value is no plain struct, which the optimizer would write out again at each use of a field
    return F.when(F.size(parts) == 3, F.struct(
        full.alias("y"), F.when(named > 0, (named + 2) / 3).otherwise(month.cast("int")).cast("int").alias("m"),
        day.cast("int").alias("d")))


def _as_date(ymd: Column) -> Column:
    """The calendar's date, NULL where it has none."""
    y, m, d = ymd["y"], ymd["m"], ymd["d"]
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.when(y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= days), F.make_date(y, m, d))


def parse_mixed_date(c: Column, first_year: int = FIRST_YEAR) -> Column:
    """The date that a text in any common spelling names; NULL where it names none, or only part of one.

    For columns of a DataFrame prefer ``with_mixed_date``, whose steps are projections."""
    let = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    return let(_squeezed(c), lambda s: let(_ordered(s), lambda parts: let(_numbers(parts, first_year), _as_date)))


def normalize_date_string(c: Column) -> Column:
    """ISO ``yyyy-MM-dd`` or ``FAILED: <trimmed input>``; NULL stays NULL."""
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.date_format(parse_mixed_date(c), "yyyy-MM-dd"), F.concat(F.lit(FAILED_PREFIX), strip_all(c))))


def with_mixed_date(df, src: str, out: str, first_year: int = FIRST_YEAR):
    """``df`` plus ``out`` = parsed DATE of text column ``src``. Each step is a projection of its own, so that it is
    evaluated once however often the next one refers to it."""
    text, parts, ymd = (f"_{out}_{step}" for step in ("text", "parts", "ymd"))
    return (df.withColumn(text, _squeezed(F.col(src))).withColumn(parts, _ordered(F.col(text)))
            .withColumn(ymd, _numbers(F.col(parts), first_year)).withColumn(out, _as_date(F.col(ymd))).drop(text, parts, ymd))


def with_iso_date(df, src: str, out: str):
    """``df`` plus ``out`` = ISO text or ``FAILED: <trimmed input>``."""
    tmp = f"_{out}_parsed"
    df = with_mixed_date(df, src, tmp)
    iso = F.when(F.col(src).isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.date_format(F.col(tmp), "yyyy-MM-dd"), F.concat(F.lit(FAILED_PREFIX), strip_all(F.col(src)))))
    return df.withColumn(out, iso).drop(tmp)


def epoch_seconds(ts_ntz: Column) -> Column:
    """Seconds (fractional) since 1970-01-01 for a TIMESTAMP_NTZ; independent
    of the session time zone."""
    # The epoch is a TIMESTAMP_NTZ parsed from text: a Python datetime literal
    # would become a session-zone TIMESTAMP and shift by the zone offset.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts_ntz) / F.lit(1_000_000)


def local_day(ts_utc_ntz: Column, zone: str) -> Column:
    """Calendar day in ``zone`` of a UTC wall-clock TIMESTAMP_NTZ
    (independent of the session time zone)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc_ntz))


def tumbling_index(seconds: Column, width: int) -> Column:
    return F.floor(seconds / F.lit(width)).cast("bigint")


def seconds_to_window_end(seconds: Column, width: int) -> Column:
    """``width - int(ts % width)`` as in a one-time-code window."""
    return (F.lit(width) - F.floor(F.pmod(seconds, F.lit(width)))).cast("bigint")


def date_spine(start: Column, stop: Column) -> Column:
    """One element per day from start to stop inclusive (explode it)."""
    return F.sequence(start, stop, F.expr("INTERVAL 1 DAY"))
