"""Date text handling.  Wall-clock times throughout: an offset is dropped, not
applied, so nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import SPACE, is_blank

# The date forms that are recognised (month and day names in
# English, day before month in the slash and dash forms).
_DAY = r"(3[01]|[12]\d|0?[1-9])"
_MONTH = r"(1[0-2]|0?[1-9])"
_YEAR = r"((?!0000)\d{4})"
_TIME = r"(2[0-3]|[01]\d|\d):([0-5]\d|\d):([0-5]\d|\d)"
_OFFSET = r"[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?"
_WEEKDAYS = "mon|tue|wed|thu|fri|sat|sun"
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
MAIL_DATE = (
    rf"(?i)^(?:{_WEEKDAYS}),\s+{_DAY}\s+({_MONTHS})\s+{_YEAR}\s+{_TIME}\s+"
    rf"(?:gmt|(?-i:Z)|{_OFFSET})$"
)
ISO_DATE_TIME = rf"^{_YEAR}-{_MONTH}-{_DAY}(?:[Tt]|\s+){_TIME}$"
ISO_WITH_OFFSET = rf"^{_YEAR}-{_MONTH}-{_DAY}[Tt]{_TIME}(?:Z|{_OFFSET})$"
ISO_DATE = rf"^{_YEAR}-{_MONTH}-{_DAY}$"
DAY_FIRST = rf"^{_DAY}([/-]){_MONTH}\2{_YEAR}$"
CLOCK = r"^\d{1,2}:\d{2}$"

# ISO 8601 text as warehouse columns accept it: extended or basic date, an
# optional time after any one separator, an optional zone.
_ISO_TEXT = (
    r"^(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d))"
    r"(?:.(\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:Z|[+-]\d\d(?::?\d\d(?::?\d\d(?:\.\d+)?)?)?)?)?$"
)


def strip_space(c: Column) -> Column:
    """Trim Unicode white space, not only the blank."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def parse_datetime(c: Column) -> Column:
    """ISO 8601 text to ``timestamp_ntz``; the zone is dropped, bad text is NULL.

    The pattern guards the cast, which would also take ``2026`` or ``2026-05``.
    """
    def part(*groups: int) -> Column:
        return F.concat(*[F.regexp_extract(c, _ISO_TEXT, g) for g in groups])

    text = F.concat(
        part(1, 4), F.lit("-"), part(2, 5), F.lit("-"), part(3, 6), F.lit(" "),
        F.lpad(part(7), 2, "0"), F.lit(":"), F.lpad(part(8), 2, "0"), F.lit(":"),
        F.lpad(part(9), 2, "0"), F.lit("."), F.rpad(part(10), 6, "0"),
    )
    return F.when(
        c.rlike(_ISO_TEXT) & ~c.startswith("0000"), text.try_cast("timestamp_ntz")
    )


def _iso_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` from a timestamp_ntz without a fraction."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def _sortable(t: Column) -> Column:
    """Rewrite each recognised form to ``y-m-d h:m:s``; other text is NULL."""
    month_number = (
        F.position(F.lower(F.regexp_extract(t, MAIL_DATE, 2)), F.lit(_MONTHS.replace("|", "")))
        + 2
    ) / 3
    return (
        F.when(
            t.rlike(MAIL_DATE),
            F.concat(
                F.regexp_extract(t, MAIL_DATE, 3), F.lit("-"),
                month_number.cast("int").cast("string"),
                F.regexp_replace(t, MAIL_DATE, r"-$1 $4:$5:$6"),
            ),
        )
        .when(t.rlike(ISO_DATE_TIME), F.regexp_replace(t, ISO_DATE_TIME, "$1-$2-$3 $4:$5:$6"))
        .when(t.rlike(ISO_WITH_OFFSET), F.regexp_replace(t, ISO_WITH_OFFSET, "$1-$2-$3 $4:$5:$6"))
        .when(t.rlike(ISO_DATE), F.concat(t, F.lit(" 00:00:00")))
        .when(t.rlike(DAY_FIRST), F.regexp_replace(t, DAY_FIRST, "$4-$3-$1 00:00:00"))
    )


def normalize_date(date_text: Column, scraped_at: Column) -> Column:
    """Publication date as ISO text.

    A bare ``H:MM`` takes its day from ``scraped_at`` and is NULL without a
    usable one; text in no known form comes back unchanged.
    """
    t = strip_space(date_text)
    scraped_day = F.substring(parse_datetime(scraped_at).cast("string"), 1, 10)
    from_clock = F.concat(scraped_day, F.lit(" "), t, F.lit(":00")).try_cast("timestamp_ntz")
    return (
        F.when(is_blank(date_text), F.lit(None).cast("string"))
        .when(t.rlike(CLOCK), _iso_text(from_clock))
        .otherwise(
            F.coalesce(_iso_text(_sortable(t).try_cast("timestamp_ntz")), date_text)
        )
    )


def publication_day(publication_date: Column, scraped_at: Column) -> Column:
    """First ten characters of the publication date, else of the scrape time.

    A text slice: a date in no known form gives a day that is not a date.
    """
    return F.substring(F.coalesce(F.nullif(publication_date, F.lit("")), scraped_at), 1, 10)
