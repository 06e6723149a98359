"""Exact top-k search by inner product over a bit-sliced index.

Rows are dealt to blocks. In a block every attribute is quantised to a few bits, and each bit of an attribute is a
slice: a bitmap with a bit for each row. The sum of the attributes, weighted by the query's components, is added up
slice by slice with carry-save adders, so a machine word adds 64 rows at a time. It differs from the true score by
what quantising cut off, which has a bound. The k-th best sum is found from the most significant slice downwards;
rows whose sum lies within the bound of it are the boundary and are resolved exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import ship

#: Rows and queries of a block, about.
ROWS, QUERIES = 32_768, 8192
#: Vectors with a larger component are few; their products are summed by Python's integers.
HUGE = 1 << 24
#: Bits that are kept of an attribute.
KEPT_BITS = 6


class SlicedBlock:
    """The index of a block of integer vectors: ``slices[j][b]`` is bit b of attribute j of all rows."""

    def __init__(self, vectors: np.ndarray, bits: int = KEPT_BITS):
        self.n, self.d = vectors.shape
        # products with a query below HUGE are whole numbers that a double holds
        self.exact = vectors.astype(np.float64) if self.d <= 512 and np.abs(vectors, dtype=np.int64).max(initial=0) < 1 << 20 else vectors
        self.low = vectors.min(axis=0, initial=0)
        range_bits = int(vectors.max(initial=0) - self.low.min(initial=0)).bit_length()
        self.shift = max(0, range_bits - bits)
        quantised = (vectors - self.low) >> self.shift
        self.bits = min(bits, max(1, range_bits))
        pad = (-self.n) % 64
        packed = [np.packbits(np.pad(((quantised >> b) & 1).astype(np.uint8), ((0, pad), (0, 0))), axis=0, bitorder="little") for b in range(self.bits)]
        # (attribute, bit, word)
        self.slices = np.stack([np.ascontiguousarray(p.T).view(np.uint64) for p in packed], axis=1) if self.n else np.zeros((self.d, self.bits, 0), np.uint64)
        self.full = np.zeros(self.slices.shape[2], dtype=np.uint64)
        if self.n:
            valid = np.packbits(np.pad(np.ones(self.n, np.uint8), (0, pad)), bitorder="little")
            self.full = valid.view(np.uint64)

    def search(self, query: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) of the k best rows, ties to the smaller number; ``without`` are left out."""
        alive = self.full.copy()
        if without is not None:
            for i in without:
                alive[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        count = int(np.bitwise_count(alive).sum())
        if not count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if count > 4 * k:
            alive = self._candidates(query, k, alive)
        rows = np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))
        scores = self.exact[rows] @ query.astype(self.exact.dtype)
        best = np.lexsort((rows, -scores))[:k]
        return rows[best], scores[best].astype(np.int64)

    def _candidates(self, query: np.ndarray, k: int, alive: np.ndarray) -> np.ndarray:
        # x_j = low_j + 2^shift * y_j + rest_j; the sum is that of q_j * y_j, and the rest is what it leaves out
        width = int((np.abs(query) * ((1 << self.shift) - 1)).sum())
        return self._above(self._weighted_sum(query), k, alive, -(-width >> self.shift))

    def _weighted_sum(self, weight: np.ndarray) -> list[np.ndarray]:
        """Slices of sum(w * y), least significant first. Weights are written with few signed binary digits; a
        negative one adds the complement of y, which is the same up to a constant."""
        columns: list[list[np.ndarray]] = []
        for j in np.flatnonzero(weight).tolist():
            w, place = int(weight[j]), 0
            while w:
                if w & 1:
                    sign = 2 - (w & 3)  # no two digits in a row are set
                    w -= sign
                    while len(columns) < place + self.bits:
                        columns.append([])
                    for b in range(self.bits):
                        columns[place + b].append(self.slices[j, b] if sign > 0 else ~self.slices[j, b])
                w >>= 1
                place += 1
        out: list[np.ndarray] = []
        at = 0
        while at < len(columns):
            pile = columns[at]
            while len(pile) > 1:  # full adder: three slices of a place to one, and a carry
                if at + 1 == len(columns):
                    columns.append([])
                a, b = pile.pop(), pile.pop()
                half = a ^ b
                if pile:
                    c = pile.pop()
                    pile.insert(0, half ^ c)
                    columns[at + 1].append((a & b) | (half & c))
                else:
                    pile.append(half)
                    columns[at + 1].append(a & b)
            out.append(pile[0] if pile else np.zeros_like(self.full))
            at += 1
        return out

    @staticmethod
    def _above(total: list[np.ndarray], k: int, alive: np.ndarray, margin: int) -> np.ndarray:
        """Of the rows alive, those whose sum is at least the k-th largest less ``margin``."""
        # the k-th largest sum, from the most significant slice downwards
        kth, sure, left = 0, k, alive
        for b in range(len(total) - 1, -1, -1):
            ones = left & total[b]
            n = int(np.bitwise_count(ones).sum())
            if n >= sure:
                left, kth = ones, kth | 1 << b
            else:
                sure, left = sure - n, left & ~total[b]
        bound = max(0, kth - margin)
        # rows with a sum of at least the bound, by the same slices
        more, equal = np.zeros_like(alive), alive
        for b in range(len(total) - 1, -1, -1):
            if bound >> b & 1:
                equal = equal & total[b]
            else:
                more = more | (equal & total[b])
                equal = equal & ~total[b]
        return more | equal


def quantise(vector: Column, scale: int = 256) -> Column:
    """Each component x of a vector as floor(scale * x), x as a double; null where the vector is null or holds a
    null, a NaN, an infinity or what has no 64-bit integer form."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(1 << 63)))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(
    df: DataFrame, k: int, is_query: Column, id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``(query_id, rank, id, score)``: for each row for which ``is_query`` holds, the ``k`` rows of the highest
    integer inner product but its own, ties to the smaller id; all of them if there are fewer.

    Every query meets every row, in blocks: rows and queries are dealt by the hash of their id, and each block of
    rows is indexed once for a block of queries. A block has about ``ROWS`` rows, so its memory is bounded.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; vectors
    of another length than the query's aren't compared with it. Rows that repeat an id count once, with the
    smallest of their vectors. Components whose ``floor(scale * x)`` has no 64-bit form count as non-finite. Scores are
    exact, also of huge components; one beyond 64 bits counts as the largest or smallest integer that has them.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id).cast("long").alias("id"), quantise(F.col(vector), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where("id is not null and v is not null")
    total, asked = rows.select(F.count("*"), F.sum(F.col("q").cast("long"))).first()
    blocks, sides = max(1, -(-total // ROWS)), max(1, -(-(asked or 0) // QUERIES))
    place = F.xxhash64("id")
    all_sides = F.sequence(F.lit(0).cast("long"), F.lit(sides - 1).cast("long"))
    all_blocks = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    left = rows.select("id", "v", F.lit(False).alias("q"), F.pmod(place, F.lit(blocks)).alias("block"), F.explode(all_sides).alias("side"))
    right = rows.where("q").select("id", "v", "q", F.explode(all_blocks).alias("block"), F.pmod(place, F.lit(sides)).alias("side"))
    met = left.union(right).groupBy("block", "side")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "found", "score")])
    best = met.applyInArrow(lambda t: _search(t, k), schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "found"))
    best = best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("found").alias(id), "score")


def _search(block: pa.Table, k: int) -> pa.Table:
    """The k best of a block's rows for each of its queries."""
    q = block.column("q").to_numpy()
    ids = block.column("id").to_numpy()
    vectors = block.column("v").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    begins = vectors.offsets.to_numpy()[:-1]
    flat = vectors.values.to_numpy()
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    for d in np.unique(lengths).tolist():
        of = lambda wanted: _distinct(np.flatnonzero((lengths == d) & wanted), ids, flat, begins, d)  # noqa: E731, B023
        rows, queries = of(~q), of(q)
        if not len(rows[0]) or not len(queries[0]):
            continue
        large = (np.abs(rows[1]) >= HUGE).any(axis=1)
        plain, far = [x[~large] for x in rows], [x[large] for x in rows]
        index = SlicedBlock(plain[1])
        for own, v in zip(*queries):
            if (np.abs(v) >= HUGE).any():
                out.append((own, *_exact_best(own, v, *rows, k)))
                continue
            at = np.searchsorted(plain[0], own)
            same = [at] if at < len(plain[0]) and plain[0][at] == own else None
            found, scores = index.search(v, k, same)
            found = plain[0][found]
            if len(far[0]):
                more = _exact_best(own, v, *far, k)
                found, scores = np.concatenate((found, more[0])), np.concatenate((scores, more[1]))
                best = _best(scores.tolist(), found.tolist(), k)
                found, scores = found[best], scores[best]
            out.append((own, found, scores))
    columns = [
        np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64),
        np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64),
        np.concatenate([o[2] for o in out]) if out else np.zeros(0, np.int64),
    ]
    return pa.table(columns, names=["query_id", "found", "score"])


def _best(scores: list[int], ids: list[int], k: int) -> list[int]:
    return sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]


def _exact_best(own: int, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows but ``own``, by integers of any size, brought into 64 bits."""
    other = ids != own
    most = np.iinfo(np.int64)
    scores = [min(max(s, most.min), most.max) for s in (vectors[other].astype(object) @ query.astype(object)).tolist()]
    ids = ids[other]
    best = _best(scores, ids.tolist(), k)
    return ids[best], np.array([scores[i] for i in best], dtype=np.int64)


def _distinct(at: np.ndarray, ids: np.ndarray, flat: np.ndarray, begins: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) sorted by id, one row an id: the smallest vector."""
    v = flat[begins[at][:, None] + np.arange(d)[None, :]] if d else np.zeros((len(at), 0), np.int64)
    order = np.lexsort((*v.T[::-1], ids[at])) if d else np.argsort(ids[at], kind="stable")
    i, v = ids[at][order], v[order]
    first = np.concatenate(([True], i[1:] != i[:-1])) if len(i) else np.zeros(0, bool)
    return i[first], v[first]
