"""Exact de-duplication by progressive refinement, in DataFrame operations only.

Rows are grouped by the length of their text; those of groups that have a second row by a hash of the first
characters; and only those that are still not alone by a digest of the whole text. Everything but the last step
moves an id, a length and a hash. The texts of the last step reach their groups by a join with the surviving
prefixes: Spark broadcasts these as long as their known size is below its threshold, and otherwise deals both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut
from tillroll.operators.lookup import lookup

#: Characters that the second step looks at.
PREFIX = 64


def _groups(rows: DataFrame, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that the first two steps show to be alone, and the rest: distinct ``(id, whole)`` with ``times`` that
    it occurs, the ``keep_id`` and the ``group_size``."""
    sizes = cut(rows.groupBy("size").agg(F.count("*").alias("n")).where("n > 1"))
    # a length that a third of all rows has does not deal them to one task
    alike = lookup(rows.select("size", "head"), F.col("size"), sizes, "size", {"alike": "n"}).where("alike is not null")
    heads = alike.groupBy("size", "head").agg(F.count("*").alias("n"))
    heads = cut(heads.where("n > 1").select("size", "head"))
    alone = rows.drop("value").join(heads, ["size", "head"], "left_anti")
    left = rows.join(heads, ["size", "head"], "left_semi").withColumn("whole", F.sha2("value", 256))
    left = cut(left.groupBy("id", "whole", *carried).agg(F.count("*").alias("times")))
    groups = cut(left.groupBy("whole").agg(F.max("id").alias("keep_id"), F.sum("times").alias("group_size")))
    return alone, left.join(groups, "whole")


def _slim(df: DataFrame, id: str, text: str, carry: dict[str, Column]) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        F.col(id).alias("id"),
        F.octet_length(value).cast("long").alias("size"),
        F.xxhash64(F.substring(value, 1, PREFIX)).alias("head"),
        value.alias("value"),
        *(c.alias(f"carried_{n}") for n, c in carry.items()),
    )


def exact_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """``(id, keep_id, group_size, kept)`` of each row of ``df``; rows with equal texts are one group.

    ``keep_id`` is the largest id of the group and ``group_size`` the number of its rows; ``kept`` marks the one
    row that stays. Texts are equal when identical as they are; null counts as the empty text. Of rows that repeat
    both id and text, one is kept at most. A null id stays only where no row of the group has an id; ``keep_id`` is
    then null. ``carry`` adds columns that follow from id and text.

    Groups of any size are combined before they are shuffled. The way back from a group to its rows is a plain
    join, whose large keys adaptive execution splits: nothing above it needs the rows of a key together.
    """
    carry = carry or {}
    carried = [f"carried_{n}" for n in carry]
    alone, many = _groups(_slim(df, id, text, carry), carried)
    out = [F.col(c).alias(n) for c, n in zip(carried, carry)]
    one = alone.select(F.col("id").alias(id), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *out)
    nth = F.explode(F.sequence(F.lit(1).cast("long"), "times"))
    many = many.withColumn("nth", nth)
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return one.union(many.select(F.col("id").alias(id), "keep_id", "group_size", kept.alias("kept"), *out))


def drop_exact_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay. Of rows that repeat id and text, the smallest by its columns stays."""
    _, many = _groups(_slim(df, id, text, {}), [])
    gone = many.where(~F.col("id").eqNullSafe(F.col("keep_id")) | (F.col("times") > 1))
    keyed = df.select(F.struct(*df.columns).alias("row"), F.col(id).alias("x"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("w"))
    same = lambda t: F.col("x").eqNullSafe(t["id"]) & (F.col("w") == t["whole"])
    out = keyed.join(gone, same(gone), "left_anti").select("row.*")
    twins = cut(gone.where(F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "whole"))
    if twins.isEmpty():
        return out
    again = keyed.join(twins, same(twins), "left_semi").groupBy("x", "w").agg(F.min("row").alias("row"))
    return out.union(again.select("row.*"))
