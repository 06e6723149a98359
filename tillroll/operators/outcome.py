"""What became of each mail, and why: decided in the row, without a join or a group.

An outcome has a status, the mail's transactions and, unless one of them is complete, a fault: the stage that failed,
the kind of error and its detail. Faults of reading the raw message come with the mail (``parse_messages`` with
``faults``), those of matching, layouts and fields are found here, those of plug-in extractors in ``plugin``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import bind
from tillroll.operators.extract import read_claims
from tillroll.plans.rule import MANDATORY, Rule, all_rules
from tillroll.schemas import FAULT

#: Fields whose text may be there but unreadable, and where that text is.
_READ = {"date": "date_text", "amount": "amount_text"}


def fault(stage: str, error: Column | str, detail: Column | None = None) -> Column:
    """A fault of the schema ``FAULT``."""
    given = {"stage": F.lit(stage), "error": F.lit(error) if isinstance(error, str) else error, "detail": F.lit(None) if detail is None else detail}
    return F.struct(*(c.cast("string").alias(n) for n, c in given.items()))


def complete(field: Callable[[str], Column], rules: Sequence[Rule]) -> Column:
    """Every mandatory field is there, save those the rule lets be missing."""
    rule = F.concat_ws(".", field("provider"), field("variant"))
    out = field("variant").isNotNull()
    for name in MANDATORY:
        lenient = [f"{r.provider}.{r.variant}" for r in rules if name in r.nullable]
        here = field(name).isNotNull()
        out = out & ((here | rule.isin(*lenient)) if lenient else here)
    return out


def _missing(claim: Column, rules: Sequence[Rule]) -> Column:
    """Names of the mandatory fields that a claim lacks; with a mark where there is a text that could not be read."""
    rule = F.concat_ws(".", claim["provider"], claim["variant"])
    names = []
    for name in MANDATORY:
        lenient = [f"{r.provider}.{r.variant}" for r in rules if name in r.nullable]
        gone = claim[name].isNull() & ~rule.isin(*lenient) if lenient else claim[name].isNull()
        shown = F.lit(name)
        if name in _READ:
            shown = F.when(F.coalesce(claim[_READ[name]], F.lit("")) != "", f"{name}?").otherwise(shown)
        names.append(F.when(gone, shown))
    return F.array_compact(F.array(*names))


def outcomes(emails: DataFrame, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per mail: ``(message_id, from_domain, *keep, status, n_rows, n_proper, rows, fault)``.

    ``status`` is ``proper`` (a complete transaction), ``improper`` (only incomplete ones), ``unparsed`` (none) or
    ``broken`` (the message itself could not be read). ``rows`` are its transactions with a flag ``proper``. ``fault`` is
    NULL for proper mails; else its ``stage`` is ``headers`` or ``body`` (from the ``fault`` column of ``emails``, where
    there is one), ``match`` (``NoProvider``), ``layout`` (``NoLayout``; detail: the providers) or ``fields``
    (``UnreadableField`` where a text was found that is no date or amount, else ``MissingField``; detail: the names).
    """
    rules = tuple(rules or all_rules())
    new = ("message_id", "status", "n_rows", "n_proper", "rows", "fault")
    carried = [c for c in dict.fromkeys(("from_domain", *keep)) if c not in new] + ["fault"] * ("fault" in emails.columns)
    read = read_claims(emails, rules, carried)

    def judge(claims: Column) -> Column:
        named = F.transform(claims, lambda c: F.struct(c.alias("c"), complete(lambda n: c[n], rules).alias("proper"), _missing(c, rules).alias("missing")))
        return bind(named, told)

    def told(named: Column) -> Column:
        fits = F.filter(named, lambda x: x["c"]["variant"].isNotNull())
        return bind(F.struct(named.alias("all"), fits.alias("fits")), reduced)

    def reduced(m: Column) -> Column:
        lacks = F.array_distinct(F.flatten(F.transform(m["fits"], lambda x: x["missing"])))
        names = F.array_sort(F.array_distinct(F.transform(lacks, lambda n: F.rtrim(n, F.lit("?")))))
        error = F.when(F.exists(lacks, lambda n: n.endswith("?")), "UnreadableField").otherwise("MissingField")
        found = (
            F.when(F.exists(m["fits"], lambda x: x["proper"]), None)
            .when(F.size(m["all"]) <= 0, fault("match", "NoProvider"))
            .when(F.size(m["fits"]) == 0, fault("layout", "NoLayout", F.array_join(F.array_sort(F.transform(m["all"], lambda x: x["c"]["provider"])), ",")))
            .otherwise(fault("fields", error, F.array_join(names, ",")))
        )
        rows = F.transform(m["fits"], lambda x: F.struct(*(x["c"][n].alias(n) for n in _ROW), x["proper"].alias("proper")))
        n_proper = F.size(F.filter(m["fits"], lambda x: x["proper"]))
        return F.struct(rows.alias("rows"), F.size(m["fits"]).cast("long").alias("n_rows"), n_proper.cast("long").alias("n_proper"), found.alias("fault"))

    claims = F.coalesce("_claims", F.array().cast(read.schema["_claims"].dataType))
    judged = read.select("message_id", *carried, F.explode(F.transform(F.array(claims), judge)).alias("_o"))
    o = F.col("_o")
    given = F.col("fault") if "fault" in carried else F.lit(None).cast(FAULT)
    status = F.when(given.isNotNull(), "broken").when(o["n_proper"] > 0, "proper").when(o["n_rows"] > 0, "improper").otherwise("unparsed")
    return judged.select(
        "message_id",
        *(c for c in carried if c != "fault"),
        status.alias("status"),
        o["n_rows"].alias("n_rows"),
        o["n_proper"].alias("n_proper"),
        o["rows"].alias("rows"),
        F.coalesce(given, o["fault"]).alias("fault"),
    )


_ROW = ("provider", "variant", "trx_id", "date", "merchant", "amount", "fees", "currency", "payment_method", "is_incoming", "description")


def transactions(found: DataFrame) -> DataFrame:
    """The transactions of outcomes, with ``proper``: rows as ``extract_transactions`` and ``is_proper`` give them."""
    return found.select("message_id", F.explode("rows").alias("_row")).select("message_id", "_row.*")


def quarantine(found: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(message_id, *keep, stage, error, detail)`` of the mails with a fault, from any frame with a ``fault`` column."""
    return found.where(F.col("fault").isNotNull()).select("message_id", *keep, "fault.stage", "fault.error", "fault.detail")
