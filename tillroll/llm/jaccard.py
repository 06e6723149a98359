"""Set-similarity join of documents on word shingles by PartEnum signatures.

Two sets whose Jaccard similarity is t or more differ in at most ``(1 - t) / (1 + t)`` of the sum of their sizes.
Sets are dealt into bands of size (``[2^b, 2^(b+1))``; a set also stands in the band above if a partner can be
there), and for each band the domain of shingles is parted by a hash into as many partitions as keep about
``_FILL`` shingles of the largest set in each. The signature of a partition is the digest of the shingles that a
set has there. A pair that differs in k shingles can differ in k partitions at most, so of the partitions that a
set fills (empty ones say nothing and give no signature) all but k agree.

The subsets enumerated are the single partitions, in one order common to all sets, first those that hold a rare
shingle: of the first k + 1 of either set, one is shared. Larger subsets would be more selective, but need more
signatures and admit empty ones; the order does better against passages that many documents share. Which shingles
are common is read off a share of the documents, and only the order follows from it: results never do.

Sets that share a signature are candidates; links are then decided on the whole sets. To find components, a
signature's sets are first held against one of them, and then only across what is still apart: thousands of near
copies need no pair each, and no pair of the rest is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut, emptied, kept, mix, ship, slices, stored
from tillroll.llm.components import components

#: One in so many documents shows which shingles are common: those that ``COMMON`` of them hold.
SAMPLE, COMMON = 12, 6
#: Most common shingles sent to the tasks (8 bytes each).
COMMON_MOST = 1 << 19
#: Shards of a signature made of common shingles only.
_SHARDS = 64
#: Shingles of a band's largest set in each partition; in bands of small sets each shingle is one.
_FILL = {False: 1.0, True: 2.0}
_SMALL, _LARGE = 64, 256
#: Least and most bits of the cells that a set is counted by.
_CELL_BITS = 6, 13
#: Numbers of 64 bits in a sketch.
_SKETCH = 16
_BLOCK = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse
_STEP = np.uint64(0xD1342543DE82EF95)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BLOCK, _BASE), _powers(_BLOCK, pow(_BASE, -1, 1 << 64))


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= _BLOCK:
        return _UP, _DOWN
    return _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))


def word_hashes(data: np.ndarray, letters: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of bytes that are no white space, A-Z taken as a-z unless ``letters`` tell them apart.

    A polynomial hash by prefix sums, block by block; a block ends at white space.
    """
    starts, hashes, at = [], [], 0
    white = _WHITE[data]
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        if end < len(data):
            gaps = np.flatnonzero(white[at:end])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word longer than a block
                rest = np.flatnonzero(white[end:])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        w = white[at:end]
        edge = np.diff(np.concatenate(([True], w, [True])).view(np.int8))
        a, b = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(a):
            up, down = _powers_of(end - at)
            total = np.empty(end - at + 1, dtype=np.uint64)
            total[0] = 0
            np.cumsum(letters[data[at:end]] * up[: end - at], out=total[1:])
            hashes.append(mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * _STEP))
            starts.append(a + at)
        at = end
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (none.astype(np.int64), none)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle digests of each text; fewer words than ``width`` are one shingle together."""
    data = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
    starts, words = word_hashes(data)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    cuts = np.concatenate(([0], np.searchsorted(starts, ends)))
    rolled = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for i in range(width):
        rolled = rolled * _STEP + words[i : i + len(rolled)]
    rolled = mix(rolled + np.uint64(width))
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            one = np.zeros(1, dtype=np.uint64)
            for h in words[a:b]:
                one = one * _STEP + h
            out.append(mix(one + np.array([b - a], dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)))
        else:
            out.append(words[:0])
    return out


def set_digest(s: np.ndarray) -> int:
    """A 64-bit digest of a set: equal sets are one node of the join."""
    return int(mix(mix(s + _STEP).sum(keepdims=True) + np.uint64(len(s)))[0].view(np.int64))


def signatures(
    sets: list[np.ndarray], common: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, signature, whether only common shingles made it) of the sets, none of them empty."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    band = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    most = sizes * 100 // percent  # size of the largest partner
    top = np.left_shift(1, band + 1) - 1
    which, above = np.arange(len(sets)), np.flatnonzero(most > top)
    return tuple(
        np.concatenate(x)
        for x in zip(
            _in_band(sets, which, band, np.minimum(most, top), common, percent),
            _in_band([sets[i] for i in above], above, band[above] + 1, most[above], common, percent),
        )
    )


def _in_band(
    sets: list[np.ndarray], which: np.ndarray, band: np.ndarray, partner: np.ndarray, common: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(sets):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    differ = (sizes + partner) * (100 - percent) // (100 + percent)
    top = np.left_shift(1, band + 1)
    parts = np.where(top <= _SMALL, 0, np.where(top <= _LARGE, top / _FILL[False], top / _FILL[True]).astype(np.int64))
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    tag = np.uint64(0xC2B2AE3D27D4EB4F) * band.astype(np.uint64)
    place = mix(every ^ np.uint64(0x2545F4914F6CDD1D))
    small = parts[row] == 0
    bucket = np.where(small, place, place % np.maximum(parts, 1).astype(np.uint64)[row])
    order = np.lexsort((bucket, row))
    row, bucket, every = row[order], bucket[order], every[order]
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1]))))
    owner = row[first]
    content = np.add.reduceat(mix(every), first)
    sig = mix(content + mix(bucket[first] ^ tag[owner]))
    if len(common):
        at = np.minimum(np.searchsorted(common, every), len(common) - 1)
        plain = np.logical_and.reduceat(common[at] == every, first)
    else:
        plain = np.zeros(len(first), dtype=bool)
    order = np.lexsort((sig, plain, owner))
    owner, sig, plain = owner[order], sig[order], plain[order]
    begins = np.searchsorted(owner, np.arange(len(sets)))
    taken = np.arange(len(owner)) - begins[owner] <= differ[owner]
    return which[owner[taken]], sig[taken], plain[taken]


def _bytes(a: pa.Array) -> list[bytes | None]:
    return a.cast(pa.binary()).to_pylist()


def _common(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that ``COMMON`` documents of a sample hold, the most common ones up to ``COMMON_MOST``.

    The sample is a share of the documents, so a passage of some dozen documents is seen in any input.
    """
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(_bytes(part.column("text")), width)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["s"])

    found = some.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= COMMON)
    rows = found.orderBy(F.desc("count"), "s").limit(COMMON_MOST).select("s").toArrow()
    return np.sort(rows.column("s").to_numpy().astype(np.int64).view(np.uint64))


def _collisions(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """What the signatures tell, by ``kind``: ``DOC`` a row of ``docs`` (``a`` its node, ``b`` the digest of its text,
    ``c`` its id, with the counts by cell), ``STAR`` a candidate pair (``a``, ``b``) of the first node of a group and another one that its size
    allows, ``MEMBER`` a node ``b`` of a group ``a`` of three or more, or of a group of any size that was dealt over
    shards (``c`` is then the key of the node's shard)."""
    common = _common(docs, width)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(_bytes(part.column("text")), width)
                nodes = np.array([set_digest(s) for s in sets], dtype=np.int64)
                sizes = np.array([len(s) for s in sets], dtype=np.int32)
                ids = part.column("doc_id")
                spread = mix(np.arange(len(nodes), dtype=np.uint64) + nodes.view(np.uint64)).view(np.int64)
                yield _signed(spread, nodes, -1 - sizes, ids, pa.array([_sketch(s) + _cells(s) for s in sets], pa.binary()), part.column("digest"))
                new = []
                for i, ok in enumerate(ids.is_valid().to_pylist()):
                    if ok and sizes[i] and nodes[i] not in seen:
                        seen.add(nodes[i])
                        new.append(i)
                if len(seen) > 1_000_000:
                    seen.clear()
                if not new:
                    continue
                new = np.array(new)
                who, sig, plain = signatures([sets[i] for i in new], common, percent)
                who = new[who]
                shard = (nodes[who].view(np.uint64) % np.uint64(_SHARDS) + np.uint64(1)) * _STEP
                g = np.where(plain, mix(sig ^ shard), sig).view(np.int64)
                whole = pa.array(sig.view(np.int64), mask=~plain)
                yield _signed(g, nodes[who], sizes[who], whole, pa.nulls(len(who), pa.binary()), pa.nulls(len(who), pa.int64()))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shared(batches, percent)

    rows = docs.mapInArrow(sign, _SIGNED)
    dealt = rows.repartition("g").sortWithinPartitions("g", "node", "size")
    first = stored(dealt.mapInArrow(share, _SHARED))
    # the shards of a signature meet in their first nodes; their members all stand under the whole signature already
    heads = first.where(F.col("kind") == HEAD).select(F.col("c").alias("g"), F.col("b").alias("node"), "size", F.lit(None).cast("long").alias("c"), "cells", F.lit(None).cast("long").alias("digest"))
    second = heads.repartition("g").sortWithinPartitions("g", "node", "size").mapInArrow(share, _SHARED)
    return first.where(F.col("kind") != HEAD).union(stored(second.where(F.col("kind") == STAR)))


DOC, STAR, MEMBER, HEAD = range(4)
_SIGNED = "g long, node long, size int, c long, cells binary, digest long"
_SHARED = "kind int, a long, b long, size int, c long, cells binary"


def _signed(g, node, size, c, cells, digest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(g), pa.array(node), pa.array(size.astype(np.int32)), c, cells, digest], names=["g", "node", "size", "c", "cells", "digest"])


def _cells(s: np.ndarray) -> bytes:
    """How many members of a set fall into each of some cells, about two each: by the first bits of a hash, so that
    neighbours can be added up to fewer cells."""
    bits = min(max(int(len(s) // 2).bit_length(), _CELL_BITS[0]), _CELL_BITS[1])
    cell = (mix(s) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _sketch(s: np.ndarray) -> bytes:
    """Whether each of 1024 parts of the domain holds an odd number of members. Where two sets are not the same there,
    one of them at least has a member that the other lacks."""
    odd = np.bincount((mix(s ^ _STEP) >> np.uint64(54)).astype(np.int64), minlength=64 * _SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sketched(cells: str) -> list[Column]:
    """The sketch that stands before the cells, as numbers of 64 bits."""
    return [F.conv(F.hex(F.substring(cells, 8 * i + 1, 8)), 16, -10).cast("long").alias(f"s{i}") for i in range(_SKETCH)]


def _apart(a: bytes, b: bytes) -> int:
    """A lower bound of how many members of two sets are in one of them only."""
    x, y = (np.frombuffer(c, dtype=np.uint8, offset=8 * _SKETCH).astype(np.int32) for c in (a, b))
    while len(x) > len(y):
        x = x[::2] + x[1::2]
    while len(y) > len(x):
        y = y[::2] + y[1::2]
    return int(np.abs(x - y).sum())


def _shared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and node to rows of ``_SHARED``; document rows (negative size) as they are.

    Only the last row of a batch and its group's first are carried over, so groups may have any size. The rows of a
    group that is a shard are all members of its whole signature, and the first is also given as ``HEAD``.
    """
    held, head = None, None  # the last row, not given yet; (node, size) of its group's first and its place there
    for batch in chain(batches, (None,)):
        columns = []
        if batch is not None and batch.num_rows:
            g, node, size = (batch.column(i).to_numpy() for i in range(3))
            single = size < 0
            docs = batch.filter(pa.array(single))
            if docs.num_rows:
                yield _given(DOC, docs.column(1), docs.column(5), -1 - size[single], docs.column(3), docs.column(4))
            whole = batch.column(3)
            columns = [g, node, size, np.asarray(whole.is_valid()), whole.fill_null(0).to_numpy()]
            columns = [c[~single] for c in columns]
        if batch is not None and (not columns or not len(columns[0])):
            continue
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns)] if columns else held
        if not columns:
            return
        fresh = np.concatenate(([True], (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])))
        g, node, size, known, whole = columns = [c[fresh] for c in columns]
        begins = np.concatenate(([head is None or head[2] == 0], g[1:] != g[:-1]))
        firsts = np.flatnonzero(begins)
        nth = np.arange(len(g)) - np.concatenate(([0], firsts) if not begins[0] else (firsts,))[np.cumsum(begins) - begins[0]]
        rep, rep_size = node[firsts], size[firsts]
        if not begins[0]:  # the first row goes on a group
            rep, rep_size = np.concatenate(([head[0]], rep)), np.concatenate(([head[1]], rep_size))
            nth[: firsts[0] if len(firsts) else len(nth)] += head[2]
        of = np.cumsum(begins) - begins[0]
        rep, rep_size = rep[of], rep_size[of]
        more = np.append(g[1:] == g[:-1], False)
        now = np.ones(len(g), dtype=bool)
        now[-1] = batch is None  # what follows the last row is not known yet
        star = now & (nth > 0) & (np.minimum(size, rep_size) * 100 >= np.maximum(size, rep_size) * percent)
        if star.any():
            pairs = np.unique(np.stack([rep[star], node[star]]), axis=1)
            yield _given(STAR, pairs[0], pairs[1])
        second = now & (nth == 1) & more & ~known
        for at, n, s in ((now & (nth > 1) & ~known | second, node, size), (second, rep, rep_size)):
            if at.any():
                yield _given(MEMBER, g[at], n[at], s[at])
        dealt = now & known
        if dealt.any():
            yield _given(MEMBER, whole[dealt], node[dealt], size[dealt], g[dealt])
        first = now & (nth == 0) & known
        if first.any():
            yield _given(HEAD, g[first], node[first], size[first], whole[first])
        held, head = [c[-1:] for c in columns], (rep[-1], rep_size[-1], nth[-1])


def _given(kind, a, b=None, size=None, c=None, cells=None) -> pa.RecordBatch:
    n = len(a)
    arrays = [np.full(n, kind, np.int32), a, b, size if size is None else size.astype(np.int32), c, cells]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    arrays = [pa.nulls(n, k) if x is None else x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(arrays, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "a", "b", "size", "c", "cells"])


#: Members of a group, apart from its largest component and in all, that are held against each other in one place.
_LEFT, _RIGHT = 4096, 8192


def _across(members: DataFrame, known: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that share a group and no component, as far as sizes and sketches allow.

    ``members`` are the ``MEMBER`` rows ``(g, node, size, shard)``. Large groups are dealt in blocks. Sketches bound the
    difference from below before there is a pair: a group of texts that have a passage in common and little else gives
    no pairs, however large it is.
    """
    info = cells.select("node", *_sketched("cells")).join(known, "node", "left")
    placed = members.join(info, "node").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("g", "shard", "component").count()
    shards = sizes.select("g", "shard").distinct()
    sizes = sizes.groupBy("g", "component").agg(F.sum("count").alias("count"))
    main = sizes.groupBy("g").agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("n"), F.sum("count").alias("all")).where("n > 1")
    main = main.select("g", F.col("top.component").alias("main"), F.ceil((F.col("all") - F.col("top.count")) / _LEFT).alias("rows"), F.ceil(F.col("all") / _RIGHT).alias("columns"))
    apart, path = kept(placed.join(cut(main.join(shards, "g")), ["g", "shard"]))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    bits = range(_SKETCH)
    left = apart.where("component <> main").select("g", F.col("node").alias("a"), F.col("size").alias("n"), F.col("component").alias("x"), *(F.col(f"s{i}").alias(f"p{i}") for i in bits), deal("rows").alias("i"), every("columns").alias("j"))
    right = apart.select("g", F.col("node").alias("b"), F.col("size").alias("m"), F.col("component").alias("y"), "main", *(F.col(f"s{i}").alias(f"q{i}") for i in bits), every("rows").alias("i"), deal("columns").alias("j"))
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    differ = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in bits), F.lit(0))
    close = differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    once = (F.col("a") < F.col("b")) | (F.col("y") == F.col("main"))
    left, right = left.alias("l"), right.alias("r")
    same = (F.col("l.g") == F.col("r.g")) & (F.col("l.i") == F.col("r.i")) & (F.col("l.j") == F.col("r.j"))
    pairs = left.join(right, same & (F.col("x") != F.col("y")) & once & fits & close)
    found = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    emptied(apart, path)
    return found


#: Documents whose ids or digests (at most 17 bytes each) are broadcast to find or drop them.
_FEW = 200_000


def _members(docs: DataFrame, pairs: DataFrame, names: DataFrame, width: int) -> DataFrame:
    """``(node, members)``, the whole set, of the nodes of pairs.

    Up to ``_FEW`` nodes, counted, the ids are broadcast and texts stay where they are; beyond, both are dealt.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = cut(nodes.join(names, "node").select("node", F.col("name").alias("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # an id may stand in many rows
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(_bytes(part.column("text")), width)
                found = [set_digest(s) for s in sets]
                same = [i for i, (x, y) in enumerate(zip(found, part.column("node").to_pylist())) if x == y and x not in seen]
                same = list({found[i]: i for i in same}.values())
                seen.update(found[i] for i in same)
                if len(seen) > 1_000_000:
                    seen.clear()
                if same:
                    ends = np.cumsum([0, *(len(sets[i]) for i in same)]).astype(np.int32)
                    values = pa.array(np.concatenate([sets[i] for i in same]).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([found[i] for i in same], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values)], names=["node", "members"])

    if wanted.count() <= _FEW:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, "doc_id").select("node", "text").mapInArrow(run, "node long, members array<long>")


def _linked(docs: DataFrame, pairs: DataFrame, names: DataFrame, cells: DataFrame, width: int, percent: int) -> DataFrame:
    """Of candidate pairs ``(a, b)`` of nodes, those that are similar.

    First the counts by cell, which bound the difference from below, then the whole sets.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "c_a"):
                differ = map(_apart, *(part.column(f"c_{x}").to_pylist() for x in "ab"))
                differ = np.fromiter(differ, dtype=np.int64, count=part.num_rows)
                n = sum(part.column(f"n_{x}").to_numpy().astype(np.int64) for x in "ab")
                ok = differ * (100 + percent) <= n * (100 - percent)
                yield part.select(["a", "b"]).filter(pa.array(ok))

    one, two = (cells.select(F.col("node").alias(x), F.col("size").alias(f"n_{x}"), F.col("cells").alias(f"c_{x}")) for x in "ab")
    close = cut(pairs.join(one, "a").join(two, "b").mapInArrow(near, "a long, b long"))
    sets, path = kept(_members(docs, close, names, width))
    one, two = (sets.select(F.col("node").alias(x), F.col("members").alias(f"m_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("m_a", "m_b"))
    union = F.size("m_a") + F.size("m_b") - shared
    found = cut(close.join(one, "a").join(two, "b").where(shared * 100 >= union * percent).select("a", "b"))
    emptied(sets, path)
    return found


def _digest() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _links(df: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``(doc, node, digest, size, cells)`` of ``df``; of each node its smallest id (``name``) and smallest id with
    text digest (``first``); links ``(a, b)`` of nodes, as far as its component needs them."""
    ship(df.sparkSession)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _digest().alias("digest"))
    rows = _collisions(docs, width, percent)
    every = rows.where(F.col("kind") == DOC).select(F.col("c").alias("doc"), F.col("a").alias("node"), F.col("b").alias("digest"), "size", "cells")
    named = every.where("size > 0 and doc is not null")
    names = cut(named.groupBy("node").agg(F.min("doc").alias("name"), F.min(F.struct("doc", "digest")).alias("first")))
    stars = cut(rows.where(F.col("kind") == STAR).select("a", "b").distinct())
    cells = named.groupBy("node").agg(F.min("size").alias("size"), F.min("cells").alias("cells"))
    links = _linked(docs, stars, names, cells, width, percent)

    # across what is still apart in a group of three or more, shards of a signature together
    known = cut(components(links))
    members = rows.where(F.col("kind") == MEMBER).select(F.col("a").alias("g"), F.col("b").alias("node"), "size", F.coalesce("c", F.lit(0)).alias("shard"))
    pairs = _across(members, known, cells, percent).join(stars, ["a", "b"], "left_anti")
    more = _linked(docs, pairs, names, cells, width, percent)

    return every, names, links.union(more)


def _ends(names: DataFrame, tied: DataFrame, by: str) -> DataFrame:
    """``(node, component)``: the smallest value of ``by`` that links lead to, nodes of one value taken together."""
    tied = tied.join(names.select(F.col("node").alias("a"), F.col(by).alias("u")), "a").join(names.select(F.col("node").alias("b"), F.col(by).alias("v")), "b")
    found = components(tied, "u", "v").withColumnRenamed("node", by)
    return cut(names.join(found, by, "left").select("node", F.coalesce("component", by).alias("component")))


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``df`` (its ``doc_id`` and ``text`` are read).

    Documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets of distinct ``width``-word shingles
    (words by ASCII white space, A-Z lower-cased; fewer words are one shingle together). ``component_id`` is the
    smallest ``doc_id`` reachable by links, itself included. Exact up to 64-bit digests of shingles and sets.

    Null and empty texts and texts of white space have no shingles and link with nothing. Repeated rows are given
    repeatedly, with one component. A null ``doc_id`` takes no part: its ``component_id`` is null. An id that has
    several texts is linked through each of them, and its rows tell the component of their own text.
    """
    every, names, tied = _links(df, width, percent)
    ends = _ends(names, tied, "name")
    return every.join(ends, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("doc").isNotNull() & (F.col("size") > 0), F.col("component")).otherwise(F.col("doc")).alias("component_id"),
    )


def drop_near_duplicates(df: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``df`` but those whose text is linked to one with a smaller ``doc_id``, or with the same one and a
    smaller digest. Of rows that repeat id and text, the smallest by its columns stays. Rows without an id or without
    shingles stay as they are."""
    every, names, tied = _links(df, width, percent)
    rows = every.where("size > 0 and doc is not null").join(_ends(names, tied, "first"), "node")
    rows = rows.groupBy(F.col("doc").alias("x"), F.col("digest").alias("w"), "component").agg(F.count("*").alias("times"))
    first = (F.col("x") == F.col("component.doc")) & (F.col("w") == F.col("component.digest"))
    gone = cut(rows.where(~first | (F.col("times") > 1)).select("x", "w", first.alias("first")))
    if gone.count() <= _FEW:
        gone = F.broadcast(gone)
    keyed = df.select(F.struct(*df.columns).alias("row"), F.col("doc_id").cast("long").alias("x"), _digest().alias("w"))
    out = keyed.join(gone, ["x", "w"], "left_anti").select("row.*")
    twins = gone.where("first")
    if twins.isEmpty():
        return out
    again = keyed.join(twins, ["x", "w"], "left_semi").groupBy("x", "w").agg(F.min("row").alias("row"))
    return out.union(again.select("row.*"))
