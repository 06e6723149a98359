"""Titles: weak labels, batch labels, and a classifier that says whether a title announces a payment."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, Normalizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import PUNCTUATION

Vote = tuple[str, bool, Callable[[Column], Column]]


def _says(*words: str) -> Callable[[Column], Column]:
    def test(c: Column) -> Column:
        low = F.lower(c)
        out = low.contains(words[0])
        for w in words[1:]:
            out = out | low.contains(w)
        return out

    return test


# What never announces a payment, then what does. A refusal outweighs any support.
LABEL_RULES: tuple[Vote, ...] = (
    ("forwarded", False, lambda c: c.contains("Fwd:")),
    ("promotion", False, _says("promo", "discount", "% off", "sale ends", "cashback", "voucher")),
    ("announcement", False, _says("announc", "newsletter", "weekly", "what's new", "update to our")),
    ("guide", False, _says("how to", "guide", "tips for", "prompts for")),
    ("finished_order", False, _says("order completed", "pesanan selesai", "has been delivered")),
    ("security", False, _says("your pin", "pin code", "new device", "verification code", "password")),
    ("receipt", True, _says("receipt", "invoice", "journal")),
    ("paid", True, _says("you sent a payment", "you've received", "payment successful", "purchase")),
    ("success", True, _says("successful", "success ", "berhasil", "lunas", "telah membayar")),
    ("order", True, _says("telah kami terima", "checkout pesanan", "food order", "pesanan makananmu")),
    ("transfer", True, _says("transfer dana masuk", "notifikasi trans", "top up")),
    ("purchase_id", True, _says("pembelian", "pembayaran", "pemindahan")),
)


def weak_label(df: DataFrame, title: str = "title", rules: Sequence[Vote] = LABEL_RULES) -> DataFrame:
    """Add ``votes`` (names of the rules that spoke) and ``is_transaction``."""
    c = F.col(title)
    for_it = F.array_compact(F.array(*(F.when(t(c), F.lit(n)) for n, yes, t in rules if yes)))
    against = F.array_compact(F.array(*(F.when(t(c), F.lit(n)) for n, yes, t in rules if not yes)))
    return df.withColumns({"_for": for_it, "_against": against}).select(
        *df.columns,
        F.concat("_against", "_for").alias("votes"),
        ((F.size("_against") == 0) & (F.size("_for") > 0)).alias("is_transaction"),
    )


def label_batches(
    df: DataFrame, fn: Callable[[list[str]], list[bool]], title: str = "title", batch: int = 300
) -> DataFrame:
    """Add ``is_transaction`` from the caller's labeller, which is given lists of titles.

    Batches are cut within the Arrow batches of a task, so nothing is gathered; a last one may be short.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("is_transaction", T.BooleanType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch].copy()
                part["is_transaction"] = fn(part[title].tolist())
                yield part

    return df.mapInPandas(run, schema)


def _tokens_sql(title: str, out: str) -> str:
    strip = PUNCTUATION.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"SELECT *, filter(split(translate(lower({title}), '{strip}', ''), '\\\\s+'), t -> t <> '') "
        f"AS {out} FROM __THIS__"
    )


def train_title_model(
    df: DataFrame, title: str = "title", label: str = "is_transaction", vocabulary: int = 1024
) -> PipelineModel:
    """Fit a bag-of-words classifier: averaged token counts, then a logistic regression.

    Averaging the tokens of a title is what a mean-pooled embedding does; the linear layer on top is
    trained by Spark over partitions, with one gradient per step sent to the driver.
    """
    tokenised = SQLTransformer(statement=_tokens_sql("title", "title_tokens"))
    counted = CountVectorizer(inputCol="title_tokens", outputCol="title_counts", vocabSize=vocabulary - 2)
    mean = Normalizer(inputCol="title_counts", outputCol="title_mean", p=1.0)
    regression = LogisticRegression(
        featuresCol="title_mean", labelCol="label", regParam=1e-4, maxIter=50,
        probabilityCol="title_probability", rawPredictionCol="title_raw", predictionCol="title_prediction",
    )
    data = tokenised.transform(df.select(F.col(title).alias("title"), F.col(label).cast("double").alias("label")))
    # kept while fitting: the vocabulary, the scales and the regression each go through all titles
    tokens = data.select("label", "title_tokens").persist()
    try:
        counts = counted.fit(tokens)
        return PipelineModel([tokenised, counts, mean, regression.fit(mean.transform(counts.transform(tokens)))])
    finally:
        tokens.unpersist()


def score_titles(
    model: PipelineModel, df: DataFrame, threshold: float = 0.5, title: str = "title"
) -> DataFrame:
    """Add ``score`` and ``is_transaction`` (strictly above the threshold)."""
    named = df if title == "title" else df.withColumn("title", F.col(title))
    scored = model.transform(named).withColumn("score", vector_to_array("title_probability")[1])
    keep = [c for c in df.columns if c not in ("score", "is_transaction")]
    return scored.select(*keep, "score", (F.col("score") > F.lit(threshold)).alias("is_transaction"))
