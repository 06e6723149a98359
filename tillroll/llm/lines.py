"""Line de-duplication by fingerprints of whole runs.

Lines are hashed. From each line on, the shortest run of lines that holds ``min_words`` words is a window, and so is the
shortest one that ends at each line; a fingerprint is the digest of a window's lines. Winnowing them is not possible
without loss: a fingerprint of fewer words may stand first where less than a whole run is shared, and a run of just
``min_words`` words has one window only. Every line of a longer run lies in one of the run's windows. All occurrences of
a fingerprint but the first in the corpus (by document id, then line) are deleted, unless they overlap the first: what
goes is always equal to a whole run that stands earlier and apart from it, so a text that repeats itself keeps its first
period whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import cut, mix, ship, slices

#: Words of the shortest run that is deleted.
MIN_WORDS = 50

_STEP = np.uint64(0xD1342543DE82EF95)


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Digest and number of words of each line. Lines end at a line feed and are equal when identical."""
    lines = text.split(b"\n")
    h = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in lines), dtype=np.uint64, count=len(lines))
    return h, np.fromiter((len(x.split()) for x in lines), dtype=np.int64, count=len(lines))


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``[begin, end)`` of the shortest runs with ``least`` words from each line on and up to each line."""
    total = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    ends = np.searchsorted(total, total[:-1] + least, side="left")
    begins = np.searchsorted(total, total[1:] - least, side="right") - 1
    from_, to = np.flatnonzero(ends <= n), np.flatnonzero(begins >= 0)
    both = np.unique(np.concatenate((from_ * (n + 1) + ends[from_], begins[to] * (n + 1) + to + 1)))
    return both // (n + 1), both % (n + 1)


def digests(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A digest of the line hashes of each window: of its length and the two blocks of ``2^k`` lines that cover it."""
    out = np.zeros(len(begin), dtype=np.uint64)
    if not len(begin):
        return out
    n = end - begin
    level = np.frexp(n.astype(np.float64))[1] - 1
    block = mix(h + _STEP)
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            block = mix(mix(block[:-half]) * _STEP + block[half:])
        at = np.flatnonzero(level == k)
        out[at] = mix(mix(mix(block[begin[at]]) * _STEP + block[end[at] - (1 << k)]) + n[at].astype(np.uint64))
    return out


def fingerprints(h: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first line, digest) of the windows of a text."""
    begin, end = windows(words, least)
    return begin, digests(h, begin, end).view(np.int64)


def repeated_runs(df: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, version, runs)`` of the documents of which lines go: ``runs`` are their ``[begin, end)`` line numbers.

    ``version`` is a digest of the text: rows that repeat id and text are one document.
    """
    ship(df.sparkSession)
    docs = df.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), F.coalesce(text, F.lit("")).alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, begins, ends, keys = [], [], [], []
                for i, t in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    h, words = line_hashes(t)
                    begin, end = windows(words, max(1, min_words))
                    rows.append(np.full(len(begin), i))
                    begins.append(begin)
                    ends.append(end)
                    keys.append(digests(h, begin, end).view(np.int64))
                of = pa.array(np.concatenate(rows))
                spans = [pa.array(np.concatenate(x).astype(np.int32)) for x in (begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(of), part.column("version").take(of), *spans, pa.array(np.concatenate(keys))],
                    names=["id", "version", "begin", "end", "key"],
                )

    marks = docs.mapInArrow(mark, "id long, version long, begin int, end int, key long")
    where = F.struct("id", "version", "begin", "end")
    first = cut(marks.groupBy("key").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first"))
    # the first occurrence overlaps itself, too
    overlaps = (F.col("id") == F.col("first.id")) & (F.col("version") == F.col("first.version")) & (F.col("begin") < F.col("first.end"))
    found = marks.join(first, "key").where(~overlaps)
    return found.groupBy(F.col("id").alias(id), "version").agg(F.collect_set(F.struct("begin", "end")).alias("runs"))


def drop_repeated_lines(df: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without later occurrences of runs of lines, with ``n_lines`` and ``n_deleted``.

    Null stays null and has no line; the empty text has one line. Rows that repeat id and text keep and lose the
    same lines; rows without an id are left as they are and are nobody's first occurrence. Columns named as the two
    new ones are replaced. A passage that any number of documents hold costs each of them a row, not each pair.

    A line goes if a run of ``min_words`` words around it is equal to an earlier one that it does not overlap: of a
    line that a text repeats on end, as many stay as hold ``min_words`` words, and more where the rest is too short.
    """
    runs = repeated_runs(df, min_words, id, text).withColumnsRenamed({id: "runs_id", "version": "runs_version"})
    kept = [c for c in df.columns if c not in ("n_lines", "n_deleted")]
    rows = df.select(F.struct(*kept).alias("row"), F.col(id).cast("long").alias("i"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("v"))
    runs = cut(runs)
    rows = rows.join(runs, (F.col("i") == F.col("runs_id")) & (F.col("v") == F.col("runs_version")), "left").select("row.*", "runs")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                out, n, gone = [], [], []
                for t, spans in zip(part.column(text).to_pylist(), part.column("runs").to_pylist()):
                    lines = t.split("\n") if t is not None else []
                    drop = np.zeros(len(lines), dtype=bool)
                    for s in spans or []:
                        drop[s["begin"] : s["end"]] = True
                    n.append(len(lines))
                    gone.append(int(drop.sum()))
                    out.append("\n".join(x for x, d in zip(lines, drop) if not d) if spans else t)
                new = {text: pa.array(out, pa.string())}
                yield pa.RecordBatch.from_arrays(
                    [*(new.get(c, part.column(c)) for c in kept), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*kept, "n_lines", "n_deleted"]
                )

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())])
    return rows.mapInArrow(strip, schema)
