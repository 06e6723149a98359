"""Class statistics and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per class, most frequent first; NULL is no class."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), col)
    )


def class_weights(df: DataFrame, col: str) -> DataFrame:
    """``(class, n, weight)`` with weight = rows / (classes x rows of the class)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    even = counts.agg(F.sum("n") / F.count("*")).scalar()
    return counts.withColumn("weight", even / F.col("n"))


def evaluate(df: DataFrame, label: str, pred: str, p_label: str | None = None) -> DataFrame:
    """``(n, accuracy, log_loss)`` over rows that have a label.

    ``p_label`` names the probability given to the true class; without it the loss is NULL.
    """
    known = df.where(F.col(label).isNotNull())
    loss = (
        F.avg(-F.log(F.greatest(F.col(p_label), F.lit(1e-15)))) if p_label else F.lit(None).cast("double")
    )
    return known.agg(
        F.count("*").alias("n"),
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
        loss.alias("log_loss"),
    )
