"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Each source has a share of all words; a document is taken a whole number of times, up to ``most``. What a source
needs beyond whole rounds comes from the documents whose hash lies below a threshold. The threshold is found
without sorting: words are summed by source and hash bucket, running sums over the buckets show the one in which
the budget ends, and only the documents of that bucket are summed again by the next bits of their hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut

#: Fixed value: what a word is, as a pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Hash bits of a histogram, and histograms; together the 48 bits of the hash.
BITS, ROUNDS = 12, 4
#: Sources whose lines (some 100 bytes each) are broadcast to the rows, and parts of a source's rows beyond it.
FEW, _SALTS = 50_000, 64


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, a row for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. No target exceeds
    ``most`` times its source's size; the excess goes to the others by weight until none is above. That level is
    found in one pass over the sources by size a weight: the first ones are full, the others share what is left.
    """
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    rows = sizes.withColumn("weight", F.get(cycle, nth % len(weights))).withColumn("room", F.col("source_size") * most)
    order = Window.orderBy(F.col("room") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.select(
        "*",
        F.row_number().over(order).alias("at"),
        (F.sum("source_size").over(every) - F.coalesce(F.sum("room").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weights"),
    )
    # the first source whose share of what the smaller ones leave has room: it and all later ones share that
    fits = F.col("left") * F.col("weight") <= F.col("room") * F.col("weights")
    level = F.min(F.when(fits, F.struct("at", "left", "weights"))).over(every)
    rows = rows.withColumn("level", level)
    share = F.col("weight") * F.col("level.left") / F.col("level.weights")
    target = F.when(F.col("at") >= F.col("level.at"), share).otherwise(F.col("room").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def _hash(id: Column, seed: str) -> Column:
    """48 bits of the MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, BITS), 16, 10).cast("long")


def thresholds(slim: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``(source, source_size, target, rounds, limit)`` from rows of ``(source, size, hash)``.

    A document is taken ``rounds`` times, and once more if its hash is below ``limit``.
    """
    plan = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rounds = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    plan = plan.withColumn("rounds", rounds)
    plan = plan.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    # one row a source, with the hash prefix that the threshold has, and the words below it
    zero = F.lit(0).cast("long")
    found = cut(plan.select("*", zero.alias("prefix"), zero.alias("below"), zero.alias("words")))
    for r in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - r)
        inside = slim
        if r:
            inside = beside(slim, found.select("source", "prefix")).where(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("sum"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(run), zero))
        sums = _by_source(sums, found.select("source", "budget", "below"))
        # the last bucket that begins within the budget
        start = F.col("below") + F.col("before")
        top = sums.groupBy("source").agg(F.max(F.when(start <= F.col("budget"), F.struct("bucket", start.alias("start"), "sum"))).alias("top"))
        top = top.select("source", F.col("top.bucket").alias("prefix"), F.col("top.start").alias("below"), F.col("top.sum").alias("words"))
        found = cut(_by_source(found.drop("prefix", "below", "words"), top))
    # a hash value across which the budget ends is taken if that comes nearer to it
    nearer = (F.col("below") * 2 + F.col("words") <= F.col("budget") * 2) & (F.col("budget") > 0)
    return found.select("source", "source_size", "target", "rounds", (F.col("prefix") + nearer.cast("long")).alias("limit"))


def mix_sources(
    df: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, id: str = "doc_id", text: str = "text",
    source: str = "source", seed: str = "",
) -> DataFrame:
    """``(id, size, source_size, target, copies, taken)`` of each row of ``df``; ``taken`` is ``copies * size``.

    A source is taken whole as often as its target has room, and once more in documents whose hash is below a
    threshold: the one that brings the source nearest to its target, so it misses it by half the words of one hash
    value at most. Reruns agree.

    Null text and a text of white space have no words; a null source is a source of its own. A source without words
    has target 0. Rows that repeat an id have one hash and are taken alike.
    """
    slim = cut(_slim(df, id, text, source, seed))
    rows = beside(slim, thresholds(slim, tuple(weights), most))
    copies = _copies(most)
    return rows.select(F.col("id").alias(id), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(
    df: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, id: str = "doc_id", text: str = "text",
    source: str = "source", seed: str = "",
) -> DataFrame:
    """The rows of ``df``, each as often as ``mix_sources`` takes it; rows of sources without words are not."""
    slim = cut(_slim(df, id, text, source, seed).select("source", "size", "hash"))
    plan = thresholds(slim, tuple(weights), most)
    held = df.select(F.struct(*df.columns).alias("row"), F.col(source).cast("string").alias("source"), _hash(F.col(id), seed).alias("hash"))
    out = beside(held, plan).withColumn("copies", _copies(most)).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def _slim(df: DataFrame, id: str, text: str, source: str, seed: str) -> DataFrame:
    size = word_count(F.col(text)).alias("size")
    return df.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), size, _hash(F.col(id), seed).alias("hash"))


def _copies(most: int) -> Column:
    more = F.col("rounds") + (F.col("hash") < F.col("limit")).cast("long")
    return F.when(F.col("source_size") == 0, 0).otherwise(F.least(more, F.lit(most))).cast("long")


def _by_source(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join by source, null being a source; neither side has rows of single documents."""
    b = b.withColumnRenamed("source", "other")
    return a.join(b, F.col("source").eqNullSafe(F.col("other"))).drop("other")


def beside(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's line of the plan.

    Up to ``FEW`` sources, counted, the plan is broadcast and rows stay where they are; with more, the rows of each
    source are dealt to many tasks.
    """
    plan = plan.withColumnRenamed("source", "other")
    same = F.col("source").eqNullSafe(F.col("other"))
    if plan.count() <= FEW:
        return rows.join(F.broadcast(plan), same).drop("other")
    salts = F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))
    plan = plan.withColumn("salt", F.explode(salts))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(_SALTS)))
    return rows.join(plan, same & (F.col("part") == F.col("salt"))).drop("other", "salt", "part")
