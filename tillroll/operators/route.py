"""What becomes of a mail: complete rows, incomplete rows, or nothing found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import to_ascii
from tillroll.operators.outcome import complete, outcomes
from tillroll.plans.rule import Rule, all_rules

# The report's columns in order.
REPORT_COLUMNS = (
    "Datetime",
    "Merchant Name",
    "Sub Category",
    "Category",
    "Amount",
    "Currency",
    "Transaction Type",
    "Payment Method",
    "Transaction ID",
    "Notes",
)

# Ids that stand for "no id" in some receipts.
PLACEHOLDER_IDS = ("", "-", "None")


def is_proper(tx: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``proper``: every mandatory field is there, save those the rule lets be missing."""
    return tx.withColumn("proper", complete(F.col, rules or all_rules()))


def route(emails: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row per gated mail: ``(message_id, from_domain, status, n_rows, n_proper)``, see ``outcomes``.

    Each mail is decided where it is read: no shuffle and no second scan.
    """
    return outcomes(emails, rules).select("message_id", "from_domain", "status", "n_rows", "n_proper")


def unparsed(
    gated: DataFrame, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ("body_html",)
) -> DataFrame:
    """Gated mails without a single proper row, with the columns needed to look at them later."""
    carried = [c for c in ("from_domain", *keep) if c != "message_id"]
    lost = outcomes(gated, rules, carried).where(F.col("n_proper") == 0)
    return lost.select("message_id", *dict.fromkeys(carried))


def dedup_transactions(
    tx: DataFrame,
    keys: Sequence[str] = ("provider", "trx_id"),
    weak_keys: Sequence[str] = ("date", "amount", "merchant", "description"),
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """One row per transaction: the most complete one, then the one with the smallest message id.

    Some receipts carry no id of their own (a dash, or the minute of the payment). Such ids do not
    tell transactions apart, so there the other fields join the key. The minimum is combined before
    the shuffle, so a transaction repeated many times still sends one row per task.
    """
    rules = rules or all_rules()
    weak_rules = sorted(f"{r.provider}.{r.variant}" for r in rules if r.weak_id)
    weak = F.col("trx_id").isNull() | F.col("trx_id").isin(*PLACEHOLDER_IDS)
    if weak_rules:
        weak = weak | F.concat_ws(".", "provider", "variant").isin(*weak_rules)
    extra = [F.when(weak, F.col(c)).alias(f"_weak_{c}") for c in weak_keys]
    # a copy that lacks a field gives way to one that has it
    lacks = sum((F.col(c).isNull().cast("int") for c in ("trx_id", "date", "merchant", "amount", "currency")), F.lit(0))
    row = F.struct(lacks.alias("_lacks"), "message_id", *(c for c in tx.columns if c != "message_id"))
    return (
        tx.groupBy(*keys, *extra)
        .agg(F.min(row).alias("_row"))
        .select(*(F.col("_row")[c].alias(c) for c in tx.columns))
    )


def format_report(tx: DataFrame) -> DataFrame:
    """The report's fixed columns; categories are filled by the classifier, not here."""
    empty = F.lit(None).cast("string")
    values = {
        "Datetime": F.col("date"),
        "Merchant Name": to_ascii(F.col("merchant")),
        "Sub Category": empty,
        "Category": empty,
        "Amount": F.col("amount"),
        "Currency": F.col("currency"),
        "Transaction Type": F.when(F.col("is_incoming"), "INCOME").otherwise("EXPENSE"),
        "Payment Method": F.col("payment_method"),
        "Transaction ID": to_ascii(F.col("trx_id")),
        "Notes": to_ascii(F.col("description")),
    }
    return tx.select(*(values[name].alias(name) for name in REPORT_COLUMNS))
