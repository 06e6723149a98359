"""Text functions: every one takes Columns and returns a Column of built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace stripped from captured text (BMP spaces seen in mail, not only 0x20).
BLANKS = " \t\r\n\f\u00a0"

# ASCII punctuation removed before a title is split into tokens.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` mentions it.

    Columns are expressions: naming one five times computes it five times, and a long chain named
    twice at every step grows without limit. Binding it as a lambda variable stops both.
    """
    return F.transform(F.array(c), use)[0]


def switch(key: Column, cases: Mapping[object, Column]) -> Column:
    """The case whose name equals ``key``, else NULL; found by halving, not by comparing ``key`` with every name.

    ``key`` is named at every step: it should be a column or a bound value.
    """
    names = sorted(cases)
    if len(names) == 1:
        return F.when(key == F.lit(names[0]), cases[names[0]])
    mid = len(names) // 2
    low, high = ({n: cases[n] for n in part} for part in (names[:mid], names[mid:]))
    return F.when(key < F.lit(names[mid]), switch(key, low)).otherwise(switch(key, high))


def regex(pattern: str) -> str:
    """Unicode classes, and ``.`` stopping at a line feed only."""
    return "(?Ud)" + pattern


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def rx(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; NULL when the pattern does not match (an empty group stays '')."""
    p = regex(pattern)
    return F.when(c.rlike(p), F.regexp_extract(c, p, group))


def rx_filled(c: Column, pattern: str, group: int = 1) -> Column:
    """Like :func:`rx` for groups that cannot be empty: one regex pass, stripped, '' becomes NULL."""
    return null_if_blank(strip(F.regexp_extract(c, regex(pattern), group)))


def rx_first(c: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """The first pattern that matches wins."""
    return F.coalesce(*(rx(c, p, group) for p in patterns))


def rx_all(c: Column, pattern: str, sep: str = " + ", group: int = 1) -> Column:
    """Every match, joined; '' when nothing matches."""
    found = F.regexp_extract_all(c, F.lit(regex(pattern)), F.lit(group))
    return F.array_join(F.transform(found, strip), sep)


def between(c: Column, left: str, right: str) -> Column:
    """The shortest text between two label patterns, stripped."""
    return strip(rx(c, f"{left}\\s*(.*?)\\s*{right}"))


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)\\s+", " ")


def to_ascii(c: Column) -> Column:
    """Drop every character outside ASCII. NULL stays NULL."""
    return F.regexp_replace(c, "[^\\x00-\\x7F]+", "")


def clean_text(c: Column) -> Column:
    """Text for a feature: never NULL."""
    return F.coalesce(c.cast("string"), F.lit(""))


def translate_terms(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace whole words in the given order."""
    for old, new in mapping.items():
        if old != new:
            c = F.regexp_replace(c, rf"(?U)\b\Q{old}\E\b", new.replace("\\", "\\\\").replace("$", "\\$"))
    return c


def extract_domain(c: Column) -> Column:
    """Host after the first ``@`` that has one, else NULL."""
    return rx_filled(c, r"@([\w.\-]+)")


def parse_addr(c: Column) -> Column:
    """``Name <a@b>`` gives ``a@b``; a bare address is returned stripped."""
    return F.coalesce(rx_filled(c, "<([^<>]+)>"), strip(c))


def header_value(headers: Column, name: str) -> Column:
    """First header of that name in an ``array<struct<name,value>>``; '' when there is none."""
    hit = F.get(F.filter(headers, lambda h: h["name"] == F.lit(name)), F.lit(0))
    return F.coalesce(hit["value"], F.lit(""))


def title_key(subject: Column, domain: Column) -> Column:
    """The classifier's input: subject and sender domain; a missing domain reads ``None``."""
    return F.concat(F.coalesce(subject, F.lit("")), F.lit(" from:"), F.coalesce(domain, F.lit("None")))


def tokenize(c: Column) -> Column:
    """Lower case, ASCII punctuation removed, split on whitespace. No empty tokens."""
    bare = F.translate(F.lower(c), PUNCTUATION, "")
    return F.filter(F.split(bare, "[ \\t\\r\\n\\f\\x0B]+"), lambda t: t != F.lit(""))


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def split_words(c: Column) -> Column:
    """Whitespace split; empty text gives an empty array."""
    return F.filter(F.split(c, "(?U)\\s+"), lambda t: t != F.lit(""))


def ngrams(tokens: Column, n_min: int = 1, n_max: int = 2) -> Column:
    """All n-grams with ``n_min <= n <= n_max``, space-joined, shorter ones first."""
    def grams(n: int) -> Column:
        if n == 1:
            return tokens
        starts = F.when(
            F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))

    return F.concat(*(grams(n) for n in range(n_min, n_max + 1)))
