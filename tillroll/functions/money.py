"""Money parsing. All styles end in ``decimal(18,2)`` and give NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# style -> (characters looked for, their replacements; a missing replacement deletes). M5 and M7 have no fixed marks.
_STYLES = {
    "M1": (",", ""),  # 1,000,000.00
    "M2": (",.", "."),  # 200.406,00
    "M3": (".", ""),  # 200.000
    "M4": (".,", ""),  # either separator, whole units
    "M6": (", \u00a0\t\n\r", ""),  # 103 254.00
}


# Currencies with three minor digits.
_THREE_DIGITS = ("BHD", "IQD", "JOD", "KWD", "LYD", "OMR", "TND")


def plain_number(c: Column, currency: Column | None = None) -> Column:
    """A number in either style of grouping (1,234.56 or 1.234,56) as digits with a decimal point.

    With both marks, the last one is the decimal mark. A mark that stands more than once only groups. A single mark
    groups if just three digits follow and a group can be before them (no more than three digits, not a zero), unless
    the currency has three minor digits; else it is the decimal mark.
    """
    mark = F.regexp_extract(c, r"([.,])[^.,]*$", 1)
    bare = lambda x: F.translate(x, ".,", "")
    point = F.concat(bare(F.regexp_extract(c, r"(?s)^(.*)[.,][^.,]*$", 1)), F.lit("."), F.regexp_extract(c, r"([^.,]*)$", 1))
    grouped = c.rlike(r"^[^0-9]*[1-9][0-9]{0,2}[.,][0-9]{3}$")
    if currency is not None:
        grouped = grouped & ~F.coalesce(F.upper(currency).isin(*_THREE_DIGITS), F.lit(False))
    both = c.contains(",") & c.contains(".")
    again = F.length(c) - F.length(F.replace(c, mark)) > 1
    return F.when(mark == "", c).when(both, point).when(again | grouped, bare(c)).otherwise(point)


def parse_money(c: Column, style: str, whole: bool = False, currency: Column | None = None) -> Column:
    """Parse an amount written in one of the styles; ``whole`` truncates toward zero.

    M5 and M7 are written by people or services of either style (2,50 or 2.50, 1,234 or 1.234); ``currency`` helps to
    tell their marks apart, see :func:`plain_number`.
    """
    text = plain_number(c, currency) if style in ("M5", "M7") else F.translate(c, *_STYLES[style])
    value = text.try_cast("decimal(18,2)")
    if whole:
        value = value.try_cast("bigint").try_cast("decimal(18,2)")
    return value


def currency_code(c: Column) -> Column:
    """``Rp`` and ``Rp.`` become IDR; anything else is kept."""
    return F.when(c.isin("Rp", "Rp."), F.lit("IDR")).otherwise(c)


def split_at_digit(c: Column) -> tuple[Column, Column]:
    """Text before the first digit, and the rest."""
    pattern = r"(?s)^([^0-9]*)([0-9].*)$"
    return F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)


def keep_number(c: Column) -> Column:
    """Only digits and points."""
    return F.regexp_replace(c, "[^0-9.]", "")
