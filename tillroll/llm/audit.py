"""Source divergence audit by hash-consed segment trees over term ids.

Of each language, the terms that enough documents hold are kept and counted by source. How far apart two sources are is
the sum of a distance over all kept terms. A source's counts are the leaves of a segment tree over the terms; a node is
known by its two children only (hash-consing), so equal subtrees, of one source or of many, are one node. Two sources
are priced by walking both trees at the same time, level by level: what a pair of nodes costs follows from the pair, so
pairs that turn up in many places are walked once and counted as often as they turn up. Most counts of most sources are
zero or small and the terms are in order of how usual they are, so below the top levels a few node pairs are left.

Terms are dealt into blocks by hash and sources into tiles, so a task holds a part of two tiles' trees, of bounded size;
costs add up over blocks. All sums are exact: numbers that may outgrow 64 bits are Python's or Spark's decimals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, ship, slices, stored
from tillroll.operators.lookup import lookup

#: Documents of its language that hold a kept term; terms that a group's report shows.
DOCUMENTS, SHOWN = 10, 10
#: Terms of a block and sources of a tile, about.
BLOCK, TILE = 4096, 64
#: Entries that a task counts before it gives them away.
HELD = 500_000
#: Fixed value: what a probability of one is written as.
UNIT = 1_000_000_000

_ASCII = bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
#: Bytes of terms as they are, A-Z as a-z, all others of ASCII as white space.
_LETTERS = bytes.maketrans(bytes(range(0x41, 0x5B)) + _ASCII, bytes(range(0x61, 0x7B)) + b" " * len(_ASCII))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and all characters beyond ASCII, A-Z in lower case."""
    return text.translate(_LETTERS).split()


def term_counts(df: DataFrame, text: str = "text", group: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of each term in a group, and rows that hold it.

    Counted in each task first: a group with a third of all rows sends a task's distinct terms, not its words.
    """
    ship(df.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]
    slim = df.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in zip(group, names)), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                        names=names,
                    )
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                for lang, source, t in zip(*(part.column(i).to_pylist() for i in range(2)), part.column(2).cast(pa.binary()).to_pylist()):
                    n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    found = Counter(terms(t))
                    n.update(found)
                    docs.update(found.keys())
                if sum(len(n) for n, _ in held.values()) > HELD:
                    yield from given()
        yield from given()

    found = slim.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """``(lang, source, term, n, total)`` of the terms that ``documents`` rows of their language hold."""
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= documents)
    return counts.drop("docs").join(kept.drop("docs"), ["lang", "term"])


def _share(count: Column, of: Column, kinds: Column) -> Column:
    """A smoothed relative frequency in units of one part in ``UNIT``, in exact arithmetic."""
    top = (count.cast("decimal(24,0)") + 2).cast("decimal(25,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (of + 2 * kinds).cast("decimal(38,0)")) + 1


def distance(p, q):
    """What one term adds, of two shares. Both are at most ``UNIT + 1``, so the square fits 64 bits."""
    return (p - q) * (p - q) // (p + q)


class Trees:
    """Hash-consed segment trees over one block of terms: ``nodes[level][k]`` are the children of node ``k``.

    ``counts`` has a row of leaves for each group. Leaves beyond the terms of the block, which fill it up to a power of
    two, are a kind of their own.
    """

    def __init__(self, counts: np.ndarray):
        groups, n = counts.shape
        self.height = max(0, int(n - 1).bit_length())
        self.values, leaves = np.unique(counts, return_inverse=True)
        ids = np.full((groups, 1 << self.height), len(self.values), dtype=np.int64)
        ids[:, :n] = leaves.reshape(counts.shape)
        self.nodes: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(self.height):
            known = int(ids.max()) + 1
            pairs, ids_ = np.unique(ids[:, ::2] * known + ids[:, 1::2], return_inverse=True)
            ids = ids_.reshape(groups, -1)
            self.nodes.append((pairs // known, pairs % known))
        self.roots = ids[:, 0]

    def pairs(self, group: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of leaves of ``group`` and each of ``others``: (place in ``others``, leaf, leaf, how often)."""
        at, x, y = np.arange(len(others)), np.full(len(others), self.roots[group]), self.roots[others]
        times = np.ones(len(others), dtype=np.int64)
        for left, right in reversed(self.nodes):
            at, times = np.concatenate((at, at)), np.concatenate((times, times))
            x, y = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y]))
            wide = int(max(x.max(), y.max())) + 1
            # each pair of nodes is gone on with once, as often as it stands
            key, same = np.unique((at * wide + x) * wide + y, return_inverse=True)
            total = np.zeros(len(key), dtype=np.int64)
            np.add.at(total, same, times)
            at, x, y, times = key // wide // wide, key // wide % wide, key % wide, total
        real = (x < len(self.values)) & (y < len(self.values))
        return at[real], x[real], y[real], times[real]


def shares(values: np.ndarray, of: int, kinds: int) -> np.ndarray:
    """``_share`` of each count, by Python's integers where 64 bits may not do."""
    if len(values) and int(values.max()) >= (1 << 62) // UNIT:
        return np.array([UNIT * (int(v) + 2) // (of + 2 * kinds) + 1 for v in values], dtype=np.int64)
    return UNIT * (values + 2) // max(of + 2 * kinds, 1) + 1


def block_prices(counts: np.ndarray, totals: np.ndarray, kinds: int, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, others, what they are apart in this block) of each group of ``first`` and those of ``second`` above it.

    ``counts`` has the groups' counts of the block's terms, ``totals`` their counts of all kept terms, of which there
    are ``kinds``.
    """
    trees = Trees(counts) if counts.shape[1] else None
    p = [shares(trees.values, int(n), kinds) for n in totals] if trees else []
    for g in first.tolist():
        others = second[second > g]
        price = np.zeros(len(others), dtype=np.int64)
        if trees and len(others):
            at, x, y, times = trees.pairs(g, others)
            q = np.stack([p[h] for h in others.tolist()])[at, y]
            np.add.at(price, at, distance(p[g][x], q) * times)
        if len(others):
            yield g, others, price


def _pair_prices(kept: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """``(lang, source, item, value)`` of all pairs of sources of a language, in both directions."""
    langs = groups.groupBy("lang").agg(F.first("kinds").alias("kinds"), F.count("*").alias("sources"))
    blocks = F.greatest(F.ceil(F.col("kinds") / block), F.lit(1)).cast("long")
    tiles = F.greatest(F.ceil(F.col("sources") / tile), F.lit(1)).cast("long")
    langs = cut(langs.select("lang", "kinds", blocks.alias("blocks"), tiles.alias("tiles")))

    def placed(df: DataFrame) -> DataFrame:
        """Rows in the cells ``(i, j)``, ``i <= j``, of their source's tile."""
        known = lookup(df.drop("kinds"), F.col("lang"), langs, "lang", {"kinds": "kinds", "blocks": "blocks", "tiles": "tiles"})
        own = F.pmod(F.xxhash64("source"), F.col("tiles"))
        every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
        return known.withColumn("cell", F.explode(every)).select("*", "cell.i", "cell.j").drop("cell")

    of_block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    counted = placed(kept).select("lang", of_block, "i", "j", "source", "term", "n", "total")
    n_terms = lookup(kept.select("lang", "term").distinct(), F.col("lang"), langs, "lang", {"blocks": "blocks"})
    n_terms = n_terms.groupBy("lang", of_block).agg(F.count("*").alias("terms"))
    each = placed(groups).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    each = each.join(n_terms, ["lang", "block"], "left").select("lang", "block", "i", "j", "source", "size", "kinds", "tiles", F.coalesce("terms", F.lit(0)).alias("terms"))

    def price(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, _, i, j = (k.as_py() for k in key)
        sources = right.column("source").to_pylist()
        order = sorted(range(len(sources)), key=lambda k: sources[k])
        names = [sources[k] for k in order]
        place = {s: k for k, s in enumerate(names)}
        totals = right.column("size").take(pa.array(order)).to_pylist()
        tile_of = right.column("own").take(pa.array(order)).to_numpy()
        n_terms, kinds = (right.column(c)[0].as_py() for c in ("terms", "kinds"))
        counts = np.zeros((len(names), n_terms), dtype=np.int64)
        seen = left.column("term").to_pylist()
        usual = dict(zip(seen, left.column("total").to_pylist()))
        # rare terms first, after those that none of these sources has
        rank = {t: n_terms - len(usual) + k for k, t in enumerate(sorted(usual, key=lambda t: (usual[t], t)))}
        if seen:
            counts[[place[s] for s in left.column("source").to_pylist()], [rank[t] for t in seen]] = left.column("n").to_numpy()
        a, b, value = [], [], []
        one, two = np.flatnonzero(tile_of == i), np.flatnonzero(tile_of == j)
        # within a tile each pair once; across two tiles all of either, whichever name is the smaller one
        pieces = [(one, two)] if i == j else [(one, two), (two, one)]
        for first, second in pieces:
            for g, others, prices in block_prices(counts, np.array(totals, dtype=object), kinds, first, second):
                for x, y in ((np.full(len(others), g), others), (others, np.full(len(others), g))):
                    a += [names[k] for k in x.tolist()]
                    b += [names[k] for k in y.tolist()]
                    value += prices.tolist()
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": pa.array(a, pa.string()), "item": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})

    each = each.withColumn("own", F.pmod(F.xxhash64("source"), F.col("tiles")))
    cell = ["lang", "block", "i", "j"]
    parts = counted.groupBy(*cell).cogroup(each.groupBy(*cell)).applyInArrow(price, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    df: DataFrame, documents: int = DOCUMENTS, shown: int = SHOWN, text: str = "text", lang: str = "lang", source: str = "source", block: int = BLOCK, tile: int = TILE
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from the others of its language, and by what.

    A term counts ``p = 1 + floor(10^9 * (n + 2) / (N + 2 V))`` in a group, with its ``n`` occurrences there, ``N`` of
    all kept terms, of which the language has ``V``; two shares are ``floor((p - q)^2 / (p + q))`` apart. Part ``pair``
    has the sum over all kept terms for each other source (0 without kept terms), part ``term`` the first ``shown`` terms
    that the group uses more than its language does. Ranks go by value, the largest first, then by item in UTF-8.

    Null in any of the three columns is the empty string, a group of its own. Empty texts and texts of junk have no
    terms, but their group is there. Each row is a document, also a repeated one; an empty table has no rows. Very long
    texts are counted like others. Other columns are not read. ``block`` and ``tile`` only set the size of tasks.
    """
    counts = stored(term_counts(df, text, (lang, source)))
    kept = stored(kept_counts(counts, documents))
    there = df.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    kinds = kept.select("lang", "term", "total").distinct().groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_size"))
    groups = there.join(sizes, ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = cut(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "kinds", "lang_size"))))

    value = lambda p, q: F.call_function("div", (p - q) * (p - q), p + q)
    keyed = groups.select(F.struct("lang", "source").alias("group"), "size", "kinds", "lang_size")
    known = lookup(kept, F.struct("lang", "source"), keyed, "group", {c: c for c in ("size", "kinds", "lang_size")})
    known = known.select("lang", "source", F.col("term").alias("item"), _share(F.col("n"), F.col("size"), F.col("kinds")).alias("p"), _share(F.col("total"), F.col("lang_size"), F.col("kinds")).alias("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = known.where("p > q").select("lang", "source", "item", value(F.col("p"), F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= shown)
    pairs = _pair_prices(kept, groups, block, tile).withColumn("rank", F.row_number().over(by_value))
    both = [x.withColumn("part", F.lit(part)).select("lang", "source", "part", "item", "value", "rank") for x, part in ((pairs, "pair"), (over, "term"))]
    return both[0].union(both[1])
