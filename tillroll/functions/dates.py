"""Date parsing without locales or zones: text in, ``timestamp_ntz`` out, NULL on failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import bind

# Indonesian month names and abbreviations, and weekday names.
INDONESIAN_MONTHS = {
    "Januari": "January",
    "Februari": "February",
    "Maret": "March",
    "April": "April",
    "Mei": "May",
    "Juni": "June",
    "Juli": "July",
    "Agustus": "August",
    "September": "September",
    "Oktober": "October",
    "November": "November",
    "Desember": "December",
}
INDONESIAN_SHORT_MONTHS = {
    "Jan": "Jan",
    "Feb": "Feb",
    "Mar": "Mar",
    "Apr": "Apr",
    "Mei": "May",
    "Jun": "Jun",
    "Jul": "Jul",
    "Agu": "Aug",
    "Agt": "Aug",
    "Sep": "Sep",
    "Okt": "Oct",
    "Nov": "Nov",
    "Des": "Dec",
}
INDONESIAN_WEEKDAYS = {
    "Senin": "Monday",
    "Selasa": "Tuesday",
    "Rabu": "Wednesday",
    "Kamis": "Thursday",
    "Jumat": "Friday",
    "Sabtu": "Saturday",
    "Minggu": "Sunday",
}

_MONTH_WORDS = {
    **{english: english[:3] for english in INDONESIAN_MONTHS.values()},
    **INDONESIAN_SHORT_MONTHS,
    **{local: english[:3] for local, english in INDONESIAN_MONTHS.items()},
    "Sept": "Sep",
}
_ZONE = r"(?i)\s*(?:\((?:UTC|GMT)[^)]*\)|\b(?:WIB|WITA|WIT)\b|\b(?:GMT|UTC)(?:\s*[+-]\d{1,2}(?::?\d{2})?)?)"
_WEEKDAY = r"(?iU)\b(?:{})\b,?\s*".format(
    "|".join([*INDONESIAN_WEEKDAYS, *INDONESIAN_WEEKDAYS.values()])
)


def english_month(c: Column) -> Column:
    """Turn the first word of a date into a three-letter English month (one map lookup).

    With one spelling left, one format is enough: a format that does not fit costs an exception.
    """
    lookup = F.create_map(*(F.lit(x) for pair in _MONTH_WORDS.items() for x in pair))
    word = F.regexp_extract(c, "[A-Za-z]{3,}", 0)
    return F.replace(c, word, F.coalesce(F.try_element_at(lookup, word), word))


def strip_weekday(c: Column) -> Column:
    return F.regexp_replace(c, _WEEKDAY, "")


def strip_zone(c: Column) -> Column:
    return F.regexp_replace(c, _ZONE, "")


def parse_ts(c: Column, *formats: str) -> Column:
    """First format that parses wins. The text is naive: zones must be stripped before."""
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in formats)).cast("timestamp_ntz")


def parse_local_ts(c: Column, *formats: str) -> Column:
    """Weekday and zone dropped, Indonesian month translated, then parsed."""
    short = dict.fromkeys(f.replace("MMMM", "MMM") for f in formats)
    text = bind(strip_zone(strip_weekday(c)), lambda t: F.trim(english_month(t)))
    return bind(text, lambda t: parse_ts(t, *short))


def timestamp_id(c: Column) -> Column:
    """A transaction id made from the minute of the payment."""
    return F.date_format(c, "yyyyMMddHHmm")


def datetime_features(df: DataFrame, ts: str) -> DataFrame:
    """Calendar columns: Monday is day 0 and weeks are ISO weeks."""
    c = F.col(ts)
    return df.withColumns(
        {
            "year": F.year(c),
            "month": F.month(c),
            "day_of_week": F.weekday(c),
            "day_of_month": F.dayofmonth(c),
            "week_of_year": F.weekofyear(c),
            "is_weekend": (F.weekday(c) >= 5).cast("int"),
        }
    )
