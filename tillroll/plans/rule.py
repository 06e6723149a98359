"""Declarative receipt rules and their compilation to Columns.

A rule says which mails it is for (title and sender), which layout of that provider it reads, and
where each field's *text* is found. Values are parsed afterwards from those short texts, so that a
body is searched once per field.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions import text as tx

TEXT_FIELDS = (
    "trx_id",
    "date",
    "merchant",
    "amount",
    "fees",
    "currency",
    "payment_method",
    "description",
)
MANDATORY = (
    "trx_id",
    "date",
    "merchant",
    "amount",
    "currency",
    "payment_method",
    "is_incoming",
    "description",
)


@dataclass(frozen=True)
class Source:
    """What a rule may read: the body text and the HTML table cells of one mail."""

    text: Column
    cells: Column


Take = Callable[[Source], Column]
Header = Callable[[Column], Column]


# ---- header predicates -------------------------------------------------------------------------


def equals(*values: str) -> Header:
    return lambda c: c.isin(*values) if len(values) > 1 else c == values[0]


def contains(*words: str) -> Header:
    """Case-sensitive, any of the words."""
    return lambda c: _any(c.contains(w) for w in words)


def contains_folded(*words: str) -> Header:
    """Any of the words whatever their case."""
    return lambda c: _any(F.lower(c).contains(w) for w in words)


def contains_all_folded(*words: str) -> Header:
    return lambda c: _all(F.lower(c).contains(w) for w in words)


def starts(*words: str) -> Header:
    return lambda c: _any(c.startswith(w) for w in words)


def ends(*words: str) -> Header:
    return lambda c: _any(c.endswith(w) for w in words)


def any_of(*tests: Header) -> Header:
    return lambda c: _any(t(c) for t in tests)


def _any(parts) -> Column:
    out = None
    for p in parts:
        out = p if out is None else out | p
    return out


def _all(parts) -> Column:
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out


# ---- body predicates ---------------------------------------------------------------------------


def says(*words: str) -> Take:
    return lambda s: _any(s.text.contains(w) for w in words)


def says_folded(*words: str) -> Take:
    return lambda s: _any(F.lower(s.text).contains(w) for w in words)


def shows(pattern: str) -> Take:
    return lambda s: s.text.rlike(tx.regex(pattern))


def cell_says(table: int, row: int, col: int, word: str) -> Take:
    return lambda s: F.coalesce(cell(table, row, col)(s).contains(word), F.lit(False))


# ---- field texts -------------------------------------------------------------------------------
#
# A take gives the raw text of a field, '' or NULL when it is not there. Stripping, blanks and
# defaults are settled afterwards on the short texts, so that no pattern is run twice on a body.


def find(*patterns: str, group: int = 1, default: str | None = None) -> Take:
    """First pattern that matches."""

    def take(s: Source) -> Column:
        regexes = [tx.regex(p) for p in patterns]
        last = F.regexp_extract(s.text, regexes[-1], group)
        tried = regexes[:-1]
        if default is not None:
            tried, last = regexes, F.lit(default)
        out = None
        for p in tried:
            hit = s.text.rlike(p), F.regexp_extract(s.text, p, group)
            out = F.when(*hit) if out is None else out.when(*hit)
        return last if out is None else out.otherwise(last)

    return take


def find_all(pattern: str, sep: str = " + ") -> Take:
    return lambda s: tx.rx_all(s.text, pattern, sep)


def find_groups(pattern: str, groups: Sequence[int], sep: str = " ") -> Take:
    """Several groups of one match, joined; only blanks when there is no match."""
    p = tx.regex(pattern)
    return lambda s: F.concat_ws(sep, *(tx.strip(F.regexp_extract(s.text, p, g)) for g in groups))


def join(*takes: Take, sep: str = " ") -> Take:
    """Texts of several places, joined."""
    return lambda s: F.concat_ws(sep, *(t(s) for t in takes))


def first(one: Take, other: Take) -> Take:
    """The second place is read when the first has only blanks."""
    return lambda s: F.when(F.trim(one(s)) != "", one(s)).otherwise(other(s))


def const(value: str) -> Take:
    return lambda s: F.lit(value)


def if_says(word: str, then: Take, otherwise: Take | None = None) -> Take:
    def take(s: Source) -> Column:
        c = F.when(s.text.contains(word), then(s))
        return c if otherwise is None else c.otherwise(otherwise(s))

    return take


def cell(table: int, row: int, col: int) -> Take:
    """Text of one table cell by position; NULL when it is not there."""

    def take(s: Source) -> Column:
        c = s.cells
        for i in (table, row, col):
            c = F.get(c, F.lit(i))
        return c

    return take


def cell_find(table: int, row: int, col: int, pattern: str, group: int = 1) -> Take:
    return lambda s: F.regexp_extract(cell(table, row, col)(s), tx.regex(pattern), group)


# ---- the rule ----------------------------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class Rule:
    """One layout of one provider. Rules of a provider are tried in order; the first fit wins."""

    provider: str
    variant: str
    title: Header | None
    sender: Header | None
    texts: dict[str, Take]
    dates: tuple[str, ...]
    when: Take | None = None
    flat: bool = False
    money: str = "M1"
    fee_money: str | None = None
    whole: bool = False
    incoming: bool = False
    cells: bool = False
    minute_id: bool = False  # the id is the minute of the payment
    weak_id: bool = False  # the id does not tell two transactions apart
    raw_currency: bool = False  # keep the sign as it is written
    nullable: frozenset[str] = frozenset()  # fields a complete row may lack
    blank: frozenset[str] = frozenset()  # fields that are '' when missing

    def __post_init__(self) -> None:
        unknown = set(self.texts) - set(TEXT_FIELDS)
        if unknown:
            raise ValueError(f"unknown fields: {sorted(unknown)}")

    def matches(self, subject: Column, sender: Column) -> Column:
        tests = []  # the sender first: it turns most mails away, and titles are longer
        if self.sender is not None:
            tests.append(self.sender(sender))
        if self.title is not None:
            tests.append(self.title(subject))
        return F.coalesce(_all(tests), F.lit(False))

    def field_texts(self, source: Source) -> list[Column]:
        missing = F.lit(None)
        return [
            (self.texts[name](source) if name in self.texts else missing)
            .cast("string")
            .alias(name)
            for name in TEXT_FIELDS
        ]


_REGISTERED: list[Rule] = []


def register_rule(rule: Rule) -> Rule:
    """Add a rule of the caller's own to the default set."""
    if any((r.provider, r.variant) == (rule.provider, rule.variant) for r in all_rules()):
        raise ValueError(f"rule {rule.provider}.{rule.variant} exists")
    _REGISTERED.append(rule)
    return rule


def unregister_rule(provider: str, variant: str) -> None:
    _REGISTERED[:] = [r for r in _REGISTERED if (r.provider, r.variant) != (provider, variant)]


def all_rules() -> tuple[Rule, ...]:
    from tillroll.plans.packs import BUILT_IN

    return (*BUILT_IN, *_REGISTERED)


def providers(rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Rules by provider, in order."""
    out: dict[str, list[Rule]] = {}
    for r in rules:
        out.setdefault(r.provider, []).append(r)
    return out
