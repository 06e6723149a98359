"""Receipts to transactions: header match, gate, and extraction in one narrow job.

Nothing here shuffles. Headers decide first, so a body is turned to text only for mails that some
provider claims; every claimed mail is read by the rules of the claiming provider alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import (
    english_month,
    parse_ts,
    strip_weekday,
    strip_zone,
    timestamp_id,
)
from tillroll.functions.html import html_cells, html_to_text
from tillroll.functions.money import currency_code, parse_money
from tillroll.functions.text import bind, collapse_ws, strip, switch
from tillroll.plans.rule import TEXT_FIELDS, Rule, Source, all_rules, providers
from tillroll.schemas import TRANSACTIONS


@lru_cache(maxsize=32)
def _claims(rules: tuple[Rule, ...], session: SparkSession) -> Column:
    """Names of the providers with a rule for this title and sender, computed once per mail.

    Where every rule names its senders, the title is asked for only in mails of one of them. Columns belong to a session,
    so compiled rules are kept for each.
    """
    by_provider = providers(rules)

    def claims(head: Column) -> Column:
        named = []
        for name, own in by_provider.items():
            tests = {}
            for r in own:  # rules of one provider usually share their header tests
                tests.setdefault((r.title, r.sender), r.matches(head["subject"], head["from_addr"]))
            hit = None
            for t in tests.values():
                hit = t if hit is None else hit | t
            named.append(F.when(hit, F.lit(name)))
        return F.array_compact(F.array(*named))

    if any(r.sender is None for r in rules):
        return bind(F.struct("subject", "from_addr"), claims)

    def known(addr: Column) -> Column:
        sent = None
        for sender in dict.fromkeys(r.sender for r in rules):
            sent = sender(addr) if sent is None else sent | sender(addr)
        none = F.array_compact(F.array().cast("array<string>"))
        return F.when(sent, bind(F.struct("subject", addr.alias("from_addr")), claims)).otherwise(none)

    return bind(F.col("from_addr"), known)


def match_providers(emails: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``providers``: every provider with a rule for this title and parsed sender address."""
    return emails.withColumn("providers", _claims(tuple(rules or all_rules()), emails.sparkSession))


def gate(
    emails: DataFrame,
    scored: DataFrame | None = None,
    threshold: float = 0.5,
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """Keep mails a rule claims, or whose title scores above the threshold.

    A ``score`` column on the mails themselves (as ``score_titles`` adds it) keeps this a filter. Scores
    in a frame of their own, ``scored`` with ``(message_id, score)``, are joined to the unclaimed mails
    only, so the claimed ones are not shuffled. Without scores the rules alone decide.
    """
    out = emails if "providers" in emails.columns else match_providers(emails, rules)
    claimed = F.size("providers") > 0
    if scored is not None:
        likely = scored.where(F.col("score") > F.lit(threshold)).select("message_id")
        return out.where(claimed).unionByName(
            out.where(~claimed).join(likely, "message_id", "left_semi")
        )
    if "score" in emails.columns:
        claimed = claimed | F.coalesce(F.col("score") > F.lit(threshold), F.lit(False))
    return out.where(claimed)


def _case(pairs: Sequence[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    c = F.when(*pairs[0])
    for cond, value in pairs[1:]:
        c = c.when(cond, value)
    return c if otherwise is None else c.otherwise(otherwise)


def _grouped(rules: Sequence[Rule], key: Callable[[Rule], object]) -> dict[object, list[str]]:
    """Rule ids by a parsing style, so that a style is compiled once and not once per rule."""
    out: dict[object, list[str]] = {}
    for r in rules:
        out.setdefault(key(r), []).append(_rule_id(r))
    return out


def _rule_id(r: Rule) -> str:
    return f"{r.provider}.{r.variant}"


def _styled(
    rule: Column, rules: Sequence[Rule], key: Callable[[Rule], object], build: Callable[[object], Column]
) -> Column:
    groups = _grouped(rules, key)
    return _case([(rule.isin(*ids), build(style)) for style, ids in groups.items()])


def parse_receipts(
    emails: DataFrame,
    rules: Sequence[Rule] | None = None,
    keep: Sequence[str] = (),
    outer: bool = True,
) -> DataFrame:
    """One row per (mail, claiming provider); with ``outer`` also where no rule of it fits.

    Such a row has a NULL ``variant``. Mails no provider claims keep one row with NULL ``provider``
    when they are in the input; apply :func:`gate` first to drop them. ``n_providers`` counts the
    claims of the mail.
    """
    rules = tuple(rules or all_rules())
    by_provider = providers(rules)
    flat = [p for p, own in by_provider.items() if own[0].flat]
    celled = [p for p, own in by_provider.items() if any(r.cells for r in own)]

    claims = F.col("providers") if "providers" in emails.columns else _claims(rules, emails.sparkSession)
    slot = bind(
        claims,
        lambda names: F.transform(
            names, lambda n: F.struct(n.alias("provider"), F.size(names).alias("n"))
        ),
    )
    explode = F.explode_outer if outer else F.explode
    if not outer:  # before bodies are asked for; the generator alone would have them made for all mails
        emails = emails.where(F.size(claims) > 0)
    plain = F.replace(F.col("body_text"), F.lit("\u00a0"), F.lit(" "))
    provider = F.col("_slot")["provider"]
    bodies = emails.select(
        "message_id", "body_html", "body_text", *keep, explode(slot).alias("_slot")
    ).select(
        "message_id",
        provider.alias("provider"),
        F.coalesce(F.col("_slot")["n"], F.lit(0)).alias("n_providers"),
        *keep,
        F.when(provider.isin(*celled), F.col("body_html")).alias("_html"),
        F.when(provider.isNotNull(), F.coalesce(html_to_text(F.col("body_html")), plain)).alias("_raw"),
    )
    slots = bodies.select(
        "message_id",
        "provider",
        "n_providers",
        *keep,
        F.when(F.col("provider").isin(*flat), collapse_ws(F.col("_raw")))
        .otherwise(F.col("_raw"))
        .alias("_text"),
        F.when(F.col("_html").isNotNull(), html_cells("_html")).alias("_cells"),
    )

    # A generator with a computed input is evaluated once per row, and no later filter is pushed
    # below it; a plain column would be computed again in the filter of every caller.
    found = F.explode(_found(rules, outer, emails.sparkSession))
    read = slots.select("message_id", "provider", "n_providers", *keep, found.alias("_f"))
    return _parsed(read, rules, keep)


@lru_cache(maxsize=32)
def _found(rules: tuple[Rule, ...], outer: bool, session: SparkSession) -> Column:
    """Array with the rule id and field texts of one mail, empty when no rule fits it.

    The CASE over all rules sits inside a lambda on purpose: as a plain column it would outgrow the
    64 KB limit of a generated method, and Spark would spend seconds on each executor before it falls
    back. The work is in the regex engine, which runs the same either way.
    """

    found = F.transform(F.array(F.struct("provider", "_text", "_cells")), lambda mail: _read(mail, rules))
    return found if outer else F.filter(found, lambda f: f.isNotNull())


def _read(mail: Column, rules: Sequence[Rule]) -> Column:
    """Field texts of the first layout of ``mail["provider"]`` that fits; NULL when none does."""
    source = Source(mail["_text"], mail["_cells"])
    cases = {}
    for name, own in providers(rules).items():
        fits = [(r.when(source) if r.when else F.lit(True), _texts(r, source)) for r in own]
        cases[name] = _case(fits)
    return switch(mail["provider"], cases)


def _texts(r: Rule, source: Source) -> Column:
    return F.struct(F.lit(_rule_id(r)).alias("rule"), *r.field_texts(source))


Names = Callable[[str], Column]


def _among(rule: Column, rules: Sequence[Rule], test: Callable[[Rule], bool]) -> Column:
    ids = [_rule_id(r) for r in rules if test(r)]
    return rule.isin(*ids) if ids else F.lit(False)


def _stripped(f: Column) -> list[Column]:
    """Field texts without blanks, the date without weekday and zone."""
    date = strip_zone(strip_weekday(f["date"])).alias("_date")
    return [f["rule"].alias("_rule"), date, *(strip(f[n]).alias(f"_{n}") for n in TEXT_FIELDS if n != "date")]


def _typed(m: Column, rules: Sequence[Rule]) -> Column:
    rule = m["_rule"]
    dates = _styled(rule, rules, lambda r: r.dates, lambda fmts: parse_ts(m["_date"], *fmts))
    amount = _styled(rule, rules, lambda r: (r.money, r.whole), lambda style: parse_money(m["_amount"], style[0], whole=style[1], currency=m["_currency"]))
    fees = _styled(rule, rules, lambda r: r.fee_money or r.money, lambda style: parse_money(m["_fees"], style))
    return F.struct(dates.alias("date"), amount.alias("amount"), fees.alias("fees"))


def _settled(m: Names, name: str, rules: Sequence[Rule]) -> Column:
    """A text; '' is NULL unless the rule lets it be blank."""
    c = m(f"_{name}")
    return F.when((c == "") & ~_among(m("_rule"), rules, lambda r: name in r.blank), None).otherwise(c)


_SETTLED = ("trx_id", "merchant", "currency", "payment_method", "description")


def _fields(text: Names, value: Column, rule: Column, rules: Sequence[Rule]) -> list[Column]:
    """The columns of a transaction but message and provider, from settled texts and typed values."""
    known = rule.isNotNull()
    values = {
        "variant": F.split_part(rule, F.lit("."), F.lit(2)),
        "trx_id": F.when(_among(rule, rules, lambda r: r.minute_id), timestamp_id(value["date"])).otherwise(text("trx_id")),
        "date": value["date"],
        "merchant": text("merchant"),
        "amount": value["amount"],
        "fees": F.when(known, F.coalesce(value["fees"], F.lit(0).cast("decimal(18,2)"))),
        "currency": F.when(_among(rule, rules, lambda r: r.raw_currency), text("currency")).otherwise(currency_code(text("currency"))),
        "payment_method": text("payment_method"),
        "is_incoming": F.when(known, _among(rule, rules, lambda r: r.incoming)),
        "description": text("description"),
    }
    return [c.alias(name) for name, c in values.items()]


def _parsed(read: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Field texts to typed values. Each projection reads only short texts of the one before."""
    rest = ("message_id", "provider", "n_providers", *keep)
    stripped = read.select(*rest, *_stripped(F.col("_f")))
    dated = stripped.withColumn("_date", F.trim(english_month(F.col("_date"))))
    # behind a generator too: filters and sums of a caller then read the values instead of parsing again
    typed_once = F.explode(F.transform(F.array(F.struct("_rule", "_date", "_amount", "_fees", "_currency")), lambda m: _typed(m, rules)))
    texts = [_settled(F.col, name, rules).alias(f"_t_{name}") for name in _SETTLED]
    values = dated.select(*rest, "_rule", *texts, typed_once.alias("_v"))
    fields = _fields(lambda name: F.col(f"_t_{name}"), F.col("_v"), F.col("_rule"), rules)
    return values.select("message_id", "provider", *fields, "n_providers", *keep)


def read_claims(emails: DataFrame, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per mail: ``(message_id, *keep, _claims)``, all that its claiming providers read in one array.

    An element is a transaction (``variant`` is NULL where no layout of that provider fits) with the texts that its
    ``date`` and ``amount`` were read from. Nothing is taken apart into rows, so nothing needs to be put together again;
    a body is turned to text once, however many providers claim the mail.
    """
    rules = tuple(rules or all_rules())
    by_provider = providers(rules)
    flat = [p for p, own in by_provider.items() if own[0].flat]
    celled = [p for p, own in by_provider.items() if any(r.cells for r in own)]
    claims = F.col("providers") if "providers" in emails.columns else _claims(rules, emails.sparkSession)
    some = lambda names: F.arrays_overlap("_claims", F.array(*map(F.lit, names))) if names else F.lit(False)

    # kept columns may have any name
    inner = {c: f"_keep_{n}" for n, c in enumerate(keep)}
    own = ("message_id", *inner.values())
    heads = emails.select("message_id", "body_html", "body_text", *(F.col(c).alias(n) for c, n in inner.items()), claims.alias("_claims"))
    plain = F.replace(F.col("body_text"), F.lit("\u00a0"), F.lit(" "))
    text = F.when(F.size("_claims") > 0, F.coalesce(html_to_text(F.col("body_html")), plain))
    bodies = heads.select(*own, "_claims", F.when(some(celled), F.col("body_html")).alias("_html"), text.alias("_raw"))
    both = bodies.select(
        *own,
        "_claims",
        "_raw",
        F.when(some(flat), collapse_ws(F.col("_raw"))).alias("_flat"),
        F.when(F.col("_html").isNotNull(), html_cells("_html")).alias("_cells"),
    )

    def slot(p: Column) -> Column:
        body = F.when(p.isin(*flat), F.col("_flat")).otherwise(F.col("_raw"))
        return F.struct(p.alias("provider"), body.alias("_text"), F.when(p.isin(*celled), F.col("_cells")).alias("_cells"))

    # one element each: generators keep what they made from being computed again, see parse_receipts
    found = bind(F.transform("_claims", slot), lambda slots: F.transform(slots, lambda s: F.struct(s["provider"].alias("provider"), _read(s, rules).alias("f"))))
    read = both.select(*own, F.explode(F.array(found)).alias("_found"))
    typed = F.transform("_found", lambda x: _claim(x, rules))
    made = read.select(*own, F.explode(F.array(typed)).alias("_made"))
    return made.select("message_id", *(F.col(n).alias(c) for c, n in inner.items()), F.col("_made").alias("_claims"))


def _claim(x: Column, rules: Sequence[Rule]) -> Column:
    """What one provider reads, as a struct; as :func:`_parsed` makes it over columns."""

    def settle(m: Column) -> Column:
        texts = [_settled(lambda n: m[n], name, rules).alias(name) for name in _SETTLED]
        return F.struct(m["_rule"].alias("rule"), _typed(m, rules).alias("v"), m["_date"].alias("date_text"), m["_amount"].alias("amount_text"), *texts)

    def finish(m: Column) -> Column:
        fields = _fields(lambda name: m[name], m["v"], m["rule"], rules)
        return F.struct(x["provider"].alias("provider"), *fields, m["date_text"], m["amount_text"])

    def month(m: Column) -> Column:
        others = [m[f"_{n}"].alias(f"_{n}") for n in TEXT_FIELDS if n != "date"]
        return F.struct(m["_rule"].alias("_rule"), F.trim(english_month(m["_date"])).alias("_date"), *others)

    stripped = bind(F.struct(*_stripped(x["f"])), month)
    return bind(bind(stripped, settle), finish)


def extract_transactions(emails: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Claimed mails to transaction rows, complete or not (see ``is_proper``)."""
    return parse_receipts(emails, rules, outer=False).select(
        *TRANSACTIONS.fieldNames()
    )
