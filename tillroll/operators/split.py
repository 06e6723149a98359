"""Splits and augmentation. Every choice follows from a key and a seed, never from row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.text import split_words
from tillroll.operators.lookup import lookup
from tillroll.session import reliable_checkpoint

_SLOTS = 1_000_000


def keyed_hash(*parts: Column | int | str) -> Column:
    """Hex digest of the parts joined by ``:``. Any engine with MD5 gives the same."""
    return F.md5(
        F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    )


def _number(digest: Column) -> Column:
    """The first 32 bits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_frac(df: DataFrame, id: str, frac: float, seed: int = 42) -> DataFrame:
    """Add ``is_train``. A row's side depends on its key alone, so no shuffle and no sort is needed."""
    slot = _number(keyed_hash(F.col(id), seed)) % _SLOTS
    return df.withColumn("is_train", slot < F.lit(int(round(frac * _SLOTS))))


def shuffled(df: DataFrame, id: str, seed: int = 42) -> DataFrame:
    """All rows in an order that looks random and is always the same."""
    return df.orderBy(keyed_hash(F.col(id), seed), id)


#: Rows of a class that are ranked in one place, at most.
RANKED = 20_000
#: Hex digits of the digest that a level of counts looks at, and all that it has.
_DIGITS, _ALL = 3, 32


def _cuts(counts: DataFrame, quota: Column) -> DataFrame:
    """Where the quota of each class falls: the bucket ``_cut``, its ``_rows``, and how many of them ``_left`` are held.

    ``counts`` has ``(_class, _bucket, _n)``; at most 4096 rows per class.
    """
    by_class = W.partitionBy("_class")
    upto = F.sum("_n").over(by_class.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0))
    found = counts.select("_class", "_bucket", "_n", upto.alias("_upto"), quota.alias("_quota"))
    here = (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota"))
    left = F.col("_quota") - (F.col("_upto") - F.col("_n"))
    return found.where(here).select(F.col("_class").alias("_cut_class"), F.col("_bucket").alias("_cut"), left.alias("_left"), F.col("_n").alias("_rows"))


def split_stratified(df: DataFrame, id: str, label: str, frac: float, seed: int = 42, ranked: int = RANKED) -> DataFrame:
    """Add ``is_held``: exactly round(frac x rows) of every class, by the smallest digests. NULL is a class.

    Ranking a whole class in one task would fail for a class with a third of all rows. Instead digests are counted per
    class and bucket; every bucket but the one at the boundary is then wholly in or out. A boundary bucket of more than
    ``ranked`` rows is counted again by its next digits, as often as it takes (a level divides it by 4096), and only the
    rows of the last one are ranked. Only rows that repeat an id, and so its digest, cannot be divided.
    """
    keyed = df.withColumns(
        {"_digest": keyed_hash(F.col(id), seed), "_class": F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))}
    )
    first = keyed.groupBy("_class", F.substring("_digest", 1, _DIGITS).alias("_bucket")).agg(F.count("*").alias("_n"))
    # one row per class
    cuts = reliable_checkpoint(_cuts(first, F.round(F.sum("_n").over(W.partitionBy("_class")) * F.lit(frac)).cast("bigint")))
    columns = {c: c for c in ("_cut", "_left", "_rows")}
    large = (F.col("_rows") > ranked) & (F.length("_cut") < _ALL)
    while not cuts.where(large).isEmpty():
        inside = lookup(keyed.select("_class", "_digest"), F.col("_class"), cuts.where(large), "_cut_class", columns).where(F.startswith("_digest", "_cut"))
        bucket = F.substr("_digest", F.lit(1), F.length("_cut") + _DIGITS).alias("_bucket")
        counts = inside.groupBy("_class", "_left", bucket).agg(F.count("*").alias("_n"))
        cuts = reliable_checkpoint(cuts.where(~large).unionByName(_cuts(counts, F.col("_left"))))
    marked = lookup(keyed, F.col("_class"), cuts, "_cut_class", columns)
    head = F.substr("_digest", F.lit(1), F.length("_cut"))
    decided = marked.where(F.col("_cut").isNull() | (head != F.col("_cut"))).withColumn("is_held", F.coalesce(head < F.col("_cut"), F.lit(False)))
    rank = F.row_number().over(W.partitionBy("_class").orderBy("_digest", id))
    tied = marked.where(head == F.col("_cut")).withColumn("is_held", rank <= F.col("_left"))
    out = [*df.columns, "is_held"]
    return decided.select(*out).unionByName(tied.select(*out))


def augment_synonyms(
    df: DataFrame, id: str, text: str, synonyms: DataFrame, n: int = 2, seed: int = 42
) -> DataFrame:
    """Replace ``n`` words per text by their synonym, when they have one.

    ``synonyms`` is the caller's ``(word, synonym)`` table. The word is picked by the key, the round
    and the seed; a later round sees the words as the earlier ones left them. Empty text stays.
    """
    table = synonyms.groupBy(F.col("word").alias("_word")).agg(F.min("synonym").alias("_synonym"))
    out = df.withColumn("_words", split_words(F.coalesce(F.col(text), F.lit(""))))
    for i in range(n):
        at = F.when(
            F.size("_words") > 0,
            (_number(keyed_hash(F.col(id), i, seed)) % F.size("_words")).cast("int"),
        )
        picked = out.withColumn("_at", at).withColumn("_pick", F.get("_words", F.col("_at")))
        joined = lookup(picked, F.col("_pick"), table, "_word", {"_synonym": "_synonym"})
        out = joined.withColumn(
            "_words",
            F.when(
                F.col("_synonym").isNotNull(),
                F.transform(
                    "_words",
                    lambda w, j: F.when(j == F.col("_at"), F.col("_synonym")).otherwise(w),
                ),
            ).otherwise(F.col("_words")),
        ).drop("_at", "_pick", "_synonym")
    return out.withColumn(text, F.array_join("_words", " ")).drop("_words")


def augment_union(df: DataFrame, augmented: DataFrame) -> DataFrame:
    """Original rows followed by the augmented ones, labels and all."""
    return df.unionByName(augmented)
