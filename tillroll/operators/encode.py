"""Encoders and scalers, each with a fit on one frame and an application to any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup
from tillroll.operators.ranking import numbered
from tillroll.session import reliable_checkpoint


def _values(df: DataFrame, cols: Sequence[str], name: str, null: str | None = None) -> DataFrame:
    """``(col, name)``: one row per row and column, as text."""
    text = {c: F.col(c).cast("string") for c in cols}
    if null is not None:
        text = {c: F.coalesce(v, F.lit(null)) for c, v in text.items()}
    pairs = F.array(*(F.struct(F.lit(c).alias("col"), v.alias(name)) for c, v in text.items()))
    return df.select(F.inline(pairs))


def fit_all_labels(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """``(label, idx)`` for every column, as in :func:`fit_labels`; the frame is read once for all of them."""
    found = reliable_checkpoint(_values(df, cols, "label").where(F.col("label").isNotNull()).distinct())
    out = {}
    for c in cols:
        own = found.where(F.col("col") == c).select("label")
        out[c] = numbered(own, F.col("label"), "idx").withColumn("idx", F.col("idx") - 1)
    return out


def fit_labels(df: DataFrame, col: str) -> DataFrame:
    """``(label, idx)``: the distinct labels in alphabetical order, numbered from 0."""
    return fit_all_labels(df, [col])[col]


def encode_label(df: DataFrame, *cols: str, labels: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add ``<col>_idx`` for every column; values that were not fitted get NULL."""
    fitted = dict(labels or {})
    if unfitted := [c for c in cols if c not in fitted]:
        fitted |= fit_all_labels(df, unfitted)
    for col in cols:
        df = lookup(df, F.col(col).cast("string"), fitted[col], "label", {f"{col}_idx": "idx"})
    return df


def decode_label(df: DataFrame, col: str, labels: DataFrame) -> DataFrame:
    """Add ``<col>_label`` for a column of label ids."""
    return lookup(df, F.col(col), labels, "idx", {f"{col}_label": "label"})


def argmax(probabilities: Column) -> Column:
    """Position of the largest value, from 0."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def fit_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col, value, n, idx)`` by falling frequency from 1; id 0 is for unknown values.

    Ties go to the later value. All columns are counted in one pass, then numbered one by one.
    """
    counts = reliable_checkpoint(_values(df, cols, "value", "nan").groupBy("col", "value").agg(F.count("*").alias("n")))
    out = None
    for c in cols:
        own = numbered(counts.where(F.col("col") == c), F.struct("n", "value"), "idx", descending=True)
        out = own if out is None else out.unionByName(own)
    return out


def encode_category(df: DataFrame, cols: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """Add ``<col>_id`` for every column; 0 for values the fitted frame did not have."""
    fitted = fitted if fitted is not None else fit_categories(df, cols)
    for c in cols:
        key = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        found = lookup(df, key, fitted.where(F.col("col") == c), "value", {f"{c}_id": "idx"})
        df = found.withColumn(f"{c}_id", F.coalesce(f"{c}_id", F.lit(0)))
    return df


def one_hot(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """Add one 0/1 column per value of the domain; any other value gives only zeros."""
    hits = {
        f"{col}_{v}": F.coalesce((F.col(col).cast("string") == F.lit(v)).cast("int"), F.lit(0))
        for v in domain
    }
    return df.withColumns(hits)


def dummy_domain(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """``(value)``: the distinct values over all frames, as a frame, since there may be any number."""
    values = None
    for f in frames:
        own = f.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("value"))
        values = own if values is None else values.unionByName(own)
    return values.distinct()


def one_hot_aligned(
    train: DataFrame, test: DataFrame, domains: Mapping[str, Sequence[str]]
) -> tuple[DataFrame, DataFrame]:
    """The same dummy columns in both frames: one per value of a column's domain, 0 where it is absent.

    Every value becomes a column, so the caller names them (:func:`dummy_domain` finds them). For domains of any
    size use :func:`one_hot_long`.
    """
    for c, domain in domains.items():
        train, test = one_hot(train, c, sorted(domain)), one_hot(test, c, sorted(domain))
    return train, test


def one_hot_long(df: DataFrame, id: str, cols: Sequence[str]) -> DataFrame:
    """``(id, column)``: the dummy columns that are 1, named as by :func:`one_hot`; all others are 0.

    Frames with different values need no aligning in this form, and no list of values exists anywhere.
    """
    names = [F.concat(F.lit(f"{c}_"), F.col(c).cast("string")) for c in cols]
    return df.select(id, F.explode(F.array_compact(F.array(*names))).alias("column"))


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation of every column."""
    return df.agg(
        *(
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
            for c in cols
        )
    )


def standard_scale(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """Add ``<col>_scaled``; a constant column becomes 0. Pass the training frame's ``stats`` to reuse."""
    fitted = stats if stats is not None else fit_scaler(df, cols)
    held = df.withColumn("_stats", fitted.select(F.struct(*cols)).scalar())

    def scaled(c: str) -> Column:
        s = F.col("_stats")[c]
        return (F.col(c) - s["mean"]) / F.when(s["std"] == 0, 1.0).otherwise(s["std"])

    return held.withColumns({f"{c}_scaled": scaled(c) for c in cols}).drop("_stats")


def amount_log(df: DataFrame, col: str = "amount") -> DataFrame:
    return df.withColumn(f"{col}_log", F.log1p(F.col(col)))


def flat_label(df: DataFrame, category: str = "category", sub: str = "sub_category") -> DataFrame:
    """``label`` = category - sub category; NULL when either is missing."""
    return df.withColumn("label", F.concat(F.col(category), F.lit(" - "), F.col(sub)))
