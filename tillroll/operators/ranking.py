"""Numbering rows by a key over a whole frame, without sorting the frame in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANGES = 256


def numbered(df: DataFrame, key: Column, name: str, descending: bool = False) -> DataFrame:
    """Add ``name``: 1 for the smallest key (the largest with ``descending``). Keys are unique.

    A sample of keys, chosen by their hash, cuts the key space into ranges. Rows are ranked inside
    their range only, and the ranges before it are added from their sizes: at most 256 rows.
    """
    keyed = df.withColumn("_key", key)
    sample = keyed.select("_key").orderBy(F.xxhash64("_key")).limit(_RANGES - 1)
    bounds = sample.agg(F.sort_array(F.collect_list("_key"))).scalar()
    ranged = (
        keyed.withColumn("_bounds", bounds)
        .withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= F.col("_key"))))
        .drop("_bounds")
    )
    upto = W.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select(
            F.col("_range").alias("_r"),
            (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
            F.sum("_n").over(everything).alias("_total"),
        )
    )
    rank = F.row_number().over(W.partitionBy("_range").orderBy("_key"))
    joined = ranged.withColumn("_rank", rank).join(F.broadcast(before), F.col("_range") == F.col("_r"))
    place = F.col("_before") + F.col("_rank")
    if descending:
        place = F.col("_total") - place + 1
    return joined.select(*df.columns, place.cast("int").alias(name))
