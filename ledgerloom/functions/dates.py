"""Date and time columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time text falls into these tokens; a clock takes its half of the day and its offset along.
_TOKEN = "|".join(
    (
        r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:\s*[AaPp]\.?[Mm]\b\.?)?(?:\s*(?:Z\b|[+-]\d{2}:?\d{2}\b))?",
        r"\d{1,2}\s*[AaPp]\.?[Mm]\b\.?",
        r"\d+",
        r"[A-Za-z]+",
        r"[^\sA-Za-z\d]",
    )
)
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
_WEEKDAYS = "MONTUEWEDTHUFRISATSUN"
#: Words and signs without a meaning of their own; UTC is the zone of all times.
_FILLERS = ("T", "AT", "OF", "ST", "ND", "RD", "TH", "Z", "GMT", "UTC", ",", "/", "-", ".")
#: Years of two digits: up to this one they belong to this century.
_LAST_SHORT_YEAR = 74


def day(moment: Column) -> Column:
    """Timestamp to date, NULL stays NULL."""
    return moment.cast("date")


def month(moment: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(moment.cast("date"), "month")


def plus_years(moment: Column, years: Column | int) -> Column:
    """X11: calendar years later; 29 February becomes 28 February."""
    return F.add_months(moment.cast("date"), F.lit(12) * years)


def in_days(moment: Column, start: dt.date, end: dt.date) -> Column:
    """Whole days `start` to `end`, both included.

    Written as a half-open range on the raw column, so that it reaches the Parquet scan as a
    pushed filter and the last day keeps its hours.
    """
    return (moment >= F.lit(start)) & (moment < F.lit(end + dt.timedelta(days=1)))


def between_midnights(moment: Column, start: dt.date, end: dt.date) -> Column:
    """P13 on a timestamp against two bare dates: of the last day only midnight counts (Q19)."""
    return (moment >= F.lit(start)) & (moment <= F.lit(end))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _part(token: Column) -> Column:
    """What a token says: digits as they are, M and the number of a month, C and a clock, Z for the name
    of a zone, NULL for nothing, ? for text that no time has."""
    word = F.upper(token)
    month_at = F.instr(F.lit(_MONTHS), F.substring(word, 1, 3))
    day_at = F.instr(F.lit(_WEEKDAYS), F.substring(word, 1, 3))
    long = F.length(word) >= 3
    return (
        F.when(F.contains(token, F.lit(":")), F.concat(F.lit("C"), word))
        .when((token < ":") & F.contains(word, F.lit("M")), F.concat(F.lit("C"), word))
        .when(token.between("0", ":"), token)
        .when(word.isin(*_FILLERS), F.lit(None))
        .when(long & (month_at % 3 == 1), F.concat(F.lit("M"), ((month_at + 2) / 3).cast("int").cast("string")))
        .when(long & (day_at % 3 == 1), F.lit(None))
        # as in the usual parsers, capitals behind a clock name a zone; one that is not known is left out
        .when(long & (F.length(word) <= 5) & (token == word), F.lit("Z"))
        .otherwise("?")
    )


def _clock(token: Column) -> Column:
    """A clock in 24 hours with its offset; an hour may stand alone before its half of the day.

    The token is C, digits and signs, then A or P with M, then Z or an offset, in capitals.
    """
    bare = F.translate(token, ",C ", ".")  # a comma is a point, the mark and blanks go
    zone = F.regexp_extract(token, r"(?:Z|[+-]\d\d:?\d\d)$", 0)
    offset = F.when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
    zone = F.coalesce(offset, zone)
    half = F.when(F.contains(token, F.lit("M")), F.when(F.contains(token, F.lit("P")), 12).otherwise(0))

    def in_day(time: Column) -> Column:
        head = F.substring_index(time, ":", 1)
        hour = head.try_cast("int")
        rest = F.when(F.contains(time, F.lit(":")), F.substring(time, F.length(head) + 1, 99)).otherwise(":00")
        counted = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + half)
        return F.concat(F.lit(" "), F.lpad(counted.cast("string"), 2, "0"), rest, zone)

    return let(F.regexp_extract(bare, r"^[\d:]+(?:\.\d+)?", 0), in_day)


def _date(a: Column, b: Column, c: Column) -> Column:
    """Year, month and day in ISO form from three parts in their order.

    A month by name leaves the day before the year, unless only the first can be the year.  Of three
    numbers a first above 31 is the year, before month and day; else the year is the last, and the month
    the first, unless only the second can be one.
    """

    def number(x: Column) -> Column:
        return x.try_cast("int")

    def name(x: Column) -> Column:
        return x.startswith("M")

    def year(x: Column) -> Column:
        century = F.when(number(x) <= _LAST_SHORT_YEAR, "20").otherwise("19")
        return F.when(F.length(x) <= 2, F.concat(century, F.lpad(x, 2, "0"))).when(F.length(x) == 4, x)

    def iso(y: Column, m: Column, d: Column) -> Column:
        month_ = F.lpad(F.replace(m, F.lit("M"), F.lit("")), 2, "0")
        return F.concat(year(y), F.lit("-"), month_, F.lit("-"), F.when(F.length(d) <= 2, F.lpad(d, 2, "0")))

    return (
        F.when(name(a), F.when(number(b) > 31, iso(b, a, c)).otherwise(iso(c, a, b)))
        .when(name(b), F.when(number(a) > 31, iso(a, b, c)).otherwise(iso(c, b, a)))
        .when(name(c), F.when(number(b) > 31, iso(b, c, a)).otherwise(iso(a, c, b)))
        .when(number(a) > 31, iso(a, b, c))
        .when(number(a) > 12, iso(c, b, a))
        .otherwise(iso(c, a, b))
    )


def _general(text: Column) -> Column:
    """Times in any order of their tokens; NULL without a whole date."""

    def digits(x: Column, *cuts: tuple[int, str]) -> Column:
        out, at = [], 1
        for width, mark in cuts:
            out += [F.substring(x, at, width), F.lit(mark)]
            at += width
        return F.concat(*out)

    def compact(day_: Column, clock: Column) -> Column:
        date = F.when(F.length(day_) == 8, digits(day_, (4, "-"), (2, "-"), (2, " ")))
        time = F.when(F.length(clock) == 4, digits(clock, (2, ":"), (2, ""))).when(
            F.length(clock) == 6, digits(clock, (2, ":"), (2, ":"), (2, ""))
        )
        return F.concat(date, F.when(clock == "", "").otherwise(time))

    def moment(dates: Column, clocks: Column, others: Column) -> Column:
        n, a, b, c = F.size(dates), *[F.get(dates, F.lit(i)) for i in range(3)]
        time = F.when(F.size(clocks) == 0, "").otherwise(_clock(F.get(clocks, F.lit(0))))
        whole = (
            F.when(n == 3, F.concat(_date(a, b, c), time))
            .when(F.size(clocks) == 1, F.when((n == 1) & (F.length(a) == 8), F.concat(compact(a, F.lit("")), time)))
            .when((n == 2) & (F.length(a) == 8), compact(a, b))
            .when(n == 1, compact(F.substring(a, 1, 8), F.substring(a, 9, 99)))
        )
        # one name of a zone may stand beside a clock, and nothing that is not understood
        named = (F.size(others) == 0) | (F.size(others) == F.size(clocks)) & (F.get(others, F.lit(0)) == "Z")
        return F.when((F.size(clocks) <= 1) & named, whole)

    tokens = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), 0), _part)

    def sorted_out(parts: Column) -> Column:
        date = F.filter(parts, lambda p: (p < ":") | p.startswith("M"))
        clock = F.filter(parts, lambda p: p.startswith("C"))
        other = F.filter(parts, lambda p: p.isin("Z", "?"))
        return let(F.struct(date.alias("d"), clock.alias("c"), other.alias("o")), lambda f: moment(f["d"], f["c"], f["o"]))

    return let(tokens, sorted_out).try_cast("timestamp")


def lenient_timestamp(text: Column) -> Column:
    """Time text in any of the usual shapes, NULL for anything else.

    Text that begins with a year, a hyphen and no blank is ISO text or goes the way of all other text:
    it is cut into tokens once, and what they say is put in order.  The parts of a date may stand in any
    order, as numbers or with the month by name, before or behind a clock of 12 or 24 hours; a weekday,
    `at`, `of` and the endings of ordinals say nothing.  Without year, month and day there is no time, so
    that nothing depends on the day of the run.  Years of two digits up to 74 belong to this century.
    Names of zones other than UTC are not known and left out.
    """
    year_first = F.substring(F.ltrim(text), 5, 1) == "-"
    return F.coalesce(F.when(year_first, text.try_cast("timestamp")), _general(text))


def strict_timestamp(text: Column) -> Column:
    """Blank is NULL, unreadable text fails the job."""
    failed = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp")
    return F.when(F.coalesce(text, F.lit("")) != "", F.coalesce(lenient_timestamp(text), failed))
