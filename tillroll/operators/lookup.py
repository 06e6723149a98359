"""Adding the values of a table to the rows of a large frame, however often single keys occur."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table is sent to every task only if it was counted and is no larger than this; else both sides are dealt out.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
#: Parts into which the rows of one key are dealt beyond that.
SALTS = 64


def small(table: DataFrame) -> bool:
    """Whether the table is within the broadcast bounds. Runs a job that stops counting past the bound."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*table.columns))))
    counted = table.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("bytes"))
    found = counted.first()
    return found.n <= BROADCAST_ROWS and found.bytes <= BROADCAST_BYTES


def lookup(df: DataFrame, key: Column, table: DataFrame, on: str, values: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns ``values`` (new name to column of ``table``) of the row where ``on`` equals ``key``.

    ``on`` is unique in ``table``. Rows without a match, or whose key is NULL, get NULL; a column of ``df`` with a new
    name is replaced. A small table leaves ``df`` where it is. A larger one is repeated for each salt, and a row's salt
    follows from its atomic columns, so that a key with a third of all rows is dealt to as many tasks as there are salts.
    """
    side = table.select(F.col(on).alias("_lookup_on"), *(F.col(c).alias(new) for new, c in values.items()))
    keyed = df.withColumn("_lookup_key", key).drop(*values)
    same = F.col("_lookup_key") == F.col("_lookup_on")
    if small(side):
        return keyed.join(F.broadcast(side), same, "left").drop("_lookup_key", "_lookup_on")
    flat = [f.name for f in keyed.schema if isinstance(f.dataType, T.AtomicType)]
    salted = keyed.withColumn("_lookup_salt", F.pmod(F.xxhash64(*flat), F.lit(SALTS)).cast("int"))
    # Spark sizes the repeated table as if it were not repeated, and would broadcast what is 64 times as large
    each = side.withColumn("_lookup_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    joined = salted.join(each, same & (F.col("_lookup_salt") == F.col("_lookup_part")), "left")
    return joined.drop("_lookup_key", "_lookup_on", "_lookup_salt", "_lookup_part")
