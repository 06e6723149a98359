"""Removal of repeated word spans by suffix automata of reference shards.

A suffix automaton of a set of texts reads any document word by word and tells at each place the longest string of the
set that ends there, its matching statistic; a state also knows the smallest document that holds its strings. Where the
statistic reaches the threshold and that document is smaller than the one that is read, the span goes.

An automaton of the whole corpus fits no task, and sending each shard of it to all documents would cost the square of
the corpus. So shards are made by content, and only go where something can match them: each window of ``span`` words is
given to the smallest hash of the ``GRAM``-word runs in it, and consecutive windows with the same one are a fragment.
Equal windows always have the same smallest hash, so a shard with all fragments of some hashes is the whole reference
for all windows in it, and the fragments are the documents' parts to be read against it.

Most fragments need no automaton: one whose hash stands in one document has no match elsewhere; of equal fragments the
first by document stands for all, and the others go as they are. The texts of what is left, the first ones of fragments
that share a hash and differ, are gathered in shards of bounded size. A hash that more than ``KINDS`` different fragments
share (what stands around a passage that is everywhere) would make a shard too large: its windows are dealt out one by
one, by their own digests. Both ways are exact; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import mix, ship, slices, stored
from tillroll.llm.jaccard import _STEP, _powers_of, word_hashes

#: Words of the shortest span that is removed.
SPAN = 50
#: Words of the runs that decide where a window goes, at most.
GRAM = 8
#: Windows of a fragment at most.
LONGEST = 96
#: Different fragments of one hash that an automaton takes, and words after which it is read and begun anew.
KINDS, SHARD = 256, 1 << 15

#: Bytes as they are: words differ by case.
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _texts(a: pa.Array) -> list[bytes]:
    return [t or b"" for t in a.cast(pa.binary()).to_pylist()]


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where those of each text begin (a place more than texts)."""
    starts, words = word_hashes(np.frombuffer(b"\n".join(texts), dtype=np.uint8), _LETTERS)
    return words, np.concatenate(([0], np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))))


def span_digests(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A digest of the words in each ``[begin, end)``, by prefix sums of a polynomial."""
    up, down = _powers_of(len(words) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * _STEP)


def fragments(words: np.ndarray, cuts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in all words, number of windows, smallest hash) of the fragments of texts."""
    n = len(words) - span + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64)
    gram = min(GRAM, span)
    wide = span - gram + 1
    rolled = np.zeros(len(words) - gram + 1, dtype=np.uint64)
    for i in range(gram):
        rolled = rolled * _STEP + words[i : i + len(rolled)]
    rolled = mix(rolled)
    # minimum of each ``wide`` neighbours: blocks of that many, from their begin and from their end
    blocks = np.concatenate((rolled, np.full(-len(rolled) % wide, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, wide)
    up, down = (np.minimum.accumulate(x, axis=1) for x in (blocks, blocks[:, ::-1]))
    least = np.minimum(down[:, ::-1].ravel()[:n], up.ravel()[wide - 1 : wide - 1 + n])
    of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    whole = np.flatnonzero(of[:n] == of[span - 1 : span - 1 + n])  # windows within a text
    if not len(whole):
        return none, none, none, none.view(np.uint64)
    fresh = np.concatenate(([True], (least[whole[1:]] != least[whole[:-1]]) | (of[whole[1:]] != of[whole[:-1]])))
    nth = np.arange(len(whole)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    first = np.flatnonzero(nth % LONGEST == 0)
    begin = whole[first]
    return of[begin], begin, np.diff(np.append(first, len(whole))), least[begin]


class Automaton:
    """A suffix automaton of sequences; each state knows the smallest owner of the sequences that hold its strings."""

    def __init__(self) -> None:
        self.arcs: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def add(self, sequence: list, owner) -> None:
        """Sequences are added by owner, smallest first."""
        arcs, link, length, owners = self.arcs, self.link, self.length, self.owner
        last = 0
        for c in sequence:
            to = arcs[last].get(c)
            if to is not None:
                if length[to] == length[last] + 1:
                    last = to
                else:
                    last = self._split(last, to, c)
            else:
                new = len(arcs)
                arcs.append({})
                length.append(length[last] + 1)
                link.append(0)
                owners.append(None)
                at = last
                while at >= 0 and c not in arcs[at]:
                    arcs[at][c] = new
                    at = link[at]
                if at >= 0:
                    to = arcs[at][c]
                    link[new] = to if length[to] == length[at] + 1 else self._split(at, to, c)
                last = new
            if owners[last] is None:
                owners[last] = owner

    def _split(self, at: int, to: int, c) -> int:
        """A state for the strings of ``to`` that are no longer than those of ``at`` and ``c``."""
        arcs, link = self.arcs, self.link
        new = len(arcs)
        arcs.append(arcs[to].copy())
        self.length.append(self.length[at] + 1)
        link.append(link[to])
        self.owner.append(None)
        link[to] = new
        while at >= 0 and arcs[at].get(c) == to:
            arcs[at][c] = new
            at = link[at]
        return new

    def close(self) -> None:
        """Owners of longer strings also hold their suffixes."""
        owner, link = self.owner, self.link
        for s in np.argsort(-np.array(self.length), kind="stable").tolist()[:-1]:
            up = link[s]
            if owner[up] is None or owner[s] < owner[up]:
                owner[up] = owner[s]

    def statistics(self, sequence: list, most: int) -> Iterator[tuple[int, object]]:
        """At each place the length of the longest string, ``most`` at most, that ends there, and its smallest owner."""
        arcs, link, length, owner = self.arcs, self.link, self.length, self.owner
        state, n = 0, 0
        for c in sequence:
            while state and c not in arcs[state]:
                state = link[state]
                n = length[state]
            if c in arcs[state]:
                state, n = arcs[state][c], n + 1
            while state and length[link[state]] >= most:
                state = link[state]
            yield min(n, most), owner[state]


def _matched(rows: list[tuple], span: int) -> list[list[tuple[int, int]]]:
    """Of sequences ``(owner, words)``, the spans ``[begin, end)`` of whole matches with a smaller owner."""
    machine = Automaton()
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        machine.add(rows[i][1], rows[i][0])
    machine.close()
    out = []
    for owner, words in rows:
        spans: list[tuple[int, int]] = []
        for end, (n, first) in enumerate(machine.statistics(words, span), 1):
            if n == span and first < owner:
                begin = end - span
                if spans and spans[-1][1] >= begin:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((begin, end))
        out.append(spans)
    return out


def _version(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(df: DataFrame, span: int = SPAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, version, spans)``: word numbers ``[begin, end)`` of the spans that also stand in a smaller document.

    ``version`` is a digest of the text, by which rows that repeat an id are told apart; spans may overlap. Rows without
    an id are left out: they are neither smaller nor larger than others.
    """
    ship(df.sparkSession)
    kind = df.schema[id].dataType.simpleString()
    docs = df.where(F.col(id).isNotNull() & F.col(text).isNotNull()).select(F.col(id).alias("id"), _version(text).alias("version"), F.col(text).alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, cuts = _words(_texts(part.column("text")))
                of, begin, windows, gram = fragments(words, cuts, span)
                if len(of):
                    digest = span_digests(words, begin, begin + windows + span - 1)
                    own = pa.array(of)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(own), part.column("version").take(own), pa.array((begin - cuts[of]).astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(digest.view(np.int64))],
                        names=["id", "version", "begin", "windows", "gram", "digest"],
                    )

    marks = docs.mapInArrow(mark, f"id {kind}, version long, begin int, windows int, gram long, digest long")
    equal = marks.groupBy("gram", "digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    grams = equal.groupBy("gram").agg(F.min("first").alias("low"), F.max("last").alias("high"), F.count("*").alias("kinds")).where("low < high")
    shared = equal.join(grams, "gram").where("kinds > 1 or first < last").select("gram", "digest", "first", "kinds")
    found = stored(marks.join(shared, ["gram", "digest"]).where("id > first or kinds > 1").drop("digest"))
    copies = found.where("id > first").select("id", "version", "begin", (F.col("begin") + F.col("windows") + span - 1).alias("end"))

    # the texts of first fragments
    asked = F.struct("begin", "windows", "gram", (F.col("kinds") > KINDS).alias("hot"))
    asked = found.where("id = first").groupBy("id", "version").agg(F.collect_list(asked).alias("asked"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for i, (t, pieces) in enumerate(zip(_texts(part.column("text")), part.column("asked").to_pylist())):
                    words, _ = _words([t])
                    rows = [(p["gram"], p["begin"], words[p["begin"] : p["begin"] + p["windows"] + span - 1].view(np.int64)) for p in pieces if not p["hot"]]
                    at = [np.arange(p["begin"], p["begin"] + p["windows"]) for p in pieces if p["hot"]]
                    if at:
                        at = np.concatenate(at)
                        rows += zip(span_digests(words, at, at + span).view(np.int64).tolist(), at.tolist(), [None] * len(at))
                    own = pa.array(np.full(len(rows), i))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(own), part.column("version").take(own), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.list_(pa.int64()))))],
                        names=["id", "version", "gram", "begin", "words"],
                    )

    texts = stored(docs.join(asked, ["id", "version"]).mapInArrow(fetch, f"id {kind}, version long, gram long, begin int, words array<long>"))

    # windows around what is everywhere: equal ones by digest
    single = texts.where("words is null").select("id", "version", "gram", "begin")
    smallest = single.groupBy("gram").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    alike = single.join(smallest.select("gram", "low"), "gram").where("id > low").select("id", "version", "begin", (F.col("begin") + span).alias("end"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size, gram = 0, None
        for row in chain(_rows(batches), (None,)):
            # a shard ends between two hashes
            if rows and (row is None or size >= SHARD and row["gram"] != gram):
                out = [(r["id"], r["version"], r["begin"] + b, r["begin"] + e) for r, s in zip(rows, _matched([(r["id"], r["words"]) for r in rows], span)) for b, e in s]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (id_type, pa.int64(), pa.int32(), pa.int32()))], names=["id", "version", "begin", "end"])
                rows, size = [], 0
            if row is not None:
                rows.append(row)
                size, gram = size + len(row["words"]), row["gram"]

    id_type = _arrow(df.schema[id].dataType)
    dealt = texts.where("words is not null").repartition("gram").sortWithinPartitions("gram")
    read = dealt.mapInArrow(match, f"id {kind}, version long, begin int, end int")
    spans = copies.union(read).union(alike)
    return spans.groupBy("id", "version").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def drop_repeated_spans(df: DataFrame, span: int = SPAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without spans that a smaller document has, with ``n_words`` and ``n_removed``.

    Words are runs of bytes other than ASCII white space, taken as they are. A window is ``span`` consecutive words; all
    words of a window that also stands in a document with a smaller ``id`` go, so overlapping windows go as one span.
    Windows are those of ``df``, not of what is left. ``text`` becomes the words that stay, joined by a space.

    Null stays null and has no words; shorter texts keep all words. Windows that a document repeats in itself stay, and
    so do those of rows with the same id (ties), which are judged row by row. Rows without an id keep all words and take
    none from others. Columns named as the two new ones are replaced. Exact up to 64-bit digests of words and spans.
    """
    kept = [c for c in df.columns if c not in ("n_words", "n_removed")]
    spans = repeated_spans(df, span, id, text).withColumnsRenamed({"id": "spans_id", "version": "spans_version"})
    rows = df.select(F.struct(*kept).alias("row"), F.col(id).alias("i"), _version(text).alias("v"))
    known = F.col("i").isNotNull() & F.col("row").getField(text).isNotNull()
    same = (F.col("i") == F.col("spans_id")) & (F.col("v") == F.col("spans_version"))
    none = F.lit(None).cast("array<struct<begin:int,end:int>>").alias("spans")
    joined = rows.where(known).join(spans, same, "left").select("row", "spans").union(rows.where(~known).select("row", none))
    inner = [f"kept_{n}" for n in range(len(kept))]  # names of ``df`` may be any
    joined = joined.select(*(F.col("row").getField(c).alias(n) for c, n in zip(kept, inner)), "spans")
    value = inner[kept.index(text)]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, value):
                out, n, gone = [], [], []
                for t, found in zip(part.column(value).cast(pa.binary()).to_pylist(), part.column("spans").to_pylist()):
                    words = (t or b"").split()  # bytes are split at ASCII white space
                    n.append(len(words))
                    if found:
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                        np.add.at(edge, [s["begin"] for s in found], 1)
                        np.add.at(edge, [s["end"] for s in found], -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        words = [words[i] for i in np.flatnonzero(stay)]
                    gone.append(n[-1] - len(words))
                    out.append(None if t is None else b" ".join(words))
                new = {value: pa.array(out, pa.binary()).cast(pa.string())}
                yield pa.RecordBatch.from_arrays([*(new.get(c, part.column(c)) for c in inner), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*kept, "n_words", "n_removed"])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(strip, schema)
