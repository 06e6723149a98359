"""Title lists, labelled tables and report files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.route import REPORT_COLUMNS, format_report
from tillroll.schemas import LABELLED_TX, TITLES

# Column names of the training tables, older and newer, and ours.
COLUMN_NAMES = {
    "Datetime": "datetime",
    "Date": "datetime",
    "Merchant Name": "merchant",
    "Notes": "notes",
    "Noted": "notes",
    "Location": "merchant",
    "Payment Method": "payment_method",
    "Transaction Type": "transaction_type",
    "Amount": "amount",
    "Category": "category",
    "Sub Category": "sub_category",
    "Transaction ID": "tx_id",
}


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """One CSV or a folder of them; columns are found by their header names."""
    raw = spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)
    has_label = "is_transaction" in raw.columns
    label = F.col("is_transaction").try_cast("boolean") if has_label else F.lit(None).cast("boolean")
    return raw.select("title", label.alias("is_transaction")).to(TITLES)


def read_labelled(
    spark: SparkSession, path: str, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """A labelled transaction table (CSV with header, or Parquet) in the LABELLED_TX schema.

    Values that do not fit their type become NULL; columns the file lacks are NULL.
    """
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
    names = {**COLUMN_NAMES, **(rename or {})}
    found = {names.get(c, c): c for c in reversed(raw.columns)}
    columns = []
    for field in LABELLED_TX:
        if field.name in found:
            source = F.col(f"`{found[field.name]}`").cast("string")
            value = source.try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return raw.select(*columns)


def write_titles(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(tx: DataFrame, path: str) -> None:
    """Transactions as CSV in the report's fixed column order."""
    report = format_report(tx) if tuple(tx.columns) != REPORT_COLUMNS else tx
    report.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)


def write_unparsed(df: DataFrame, path: str) -> None:
    """Unparsed mails by sender domain.

    Rows are rebalanced by domain: small ones share a task, and one that holds a third of all mails is
    split into as many tasks as its size asks for.
    """
    (
        df.hint("rebalance", "from_domain")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 1_000_000)
        .partitionBy("from_domain")
        .parquet(path)
    )


def write_quarantine(df: DataFrame, path: str, append: bool = False) -> None:
    """Mails with the reason why they were not used (``outcome.quarantine``), by stage: the queue to look through."""
    writer = df.hint("rebalance", "stage").write.mode("append" if append else "overwrite")
    writer.option("maxRecordsPerFile", 1_000_000).partitionBy("stage").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
