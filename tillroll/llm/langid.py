"""Language identification by multilingual mixture inference.

A language is a distribution over hashed character n-grams, learned from labelled documents. A document is a mixture
of languages: expectation-maximisation estimates its proportions from the likelihoods of its n-grams. The set of
languages is selected by penalised likelihood: the weakest language goes as long as the likelihood loses less than
the penalty of a parameter (half the logarithm of the number of n-grams).

One more distribution, even over all n-grams, stands for what is no language; its share is reported apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import BATCH_BYTES, mix, ship, slices

#: Buckets of the n-grams of each length, and the lengths in bytes.
BUCKETS = 1 << 12
LENGTHS = (3,)
#: Rounds of expectation-maximisation at most.
ROUNDS = 12
#: Documents that are worked on together.
_ROWS = 256

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# digits, marks and controls of ASCII are one: what they are says nothing about a language
_LOWER[[b for b in range(128) if not chr(b).isalpha()]] = 32


@dataclass
class Model:
    """``theta[l]`` is the distribution of language ``labels[l]``; the last row is the even one."""

    labels: list[str]
    theta: np.ndarray


def counts(texts: list[bytes]) -> np.ndarray:
    """N-gram counts by bucket, a row for each text. A run of bytes that are no letters counts as one space."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, t in enumerate(texts):
        for start in range(0, max(len(t), 1), BATCH_BYTES):  # very long texts piece by piece
            b = _LOWER[np.frombuffer(t[start : start + BATCH_BYTES + 2], dtype=np.uint8)]
            space = b == 32
            b = np.concatenate(([32], b[~(space & np.concatenate(([True], space[:-1])))], [32])).astype(np.uint64)
            for n in LENGTHS:
                if len(b) >= n:
                    code = b[: len(b) - n + 1].copy()
                    for k in range(1, n):
                        code = code << np.uint64(8) | b[k : len(b) - n + 1 + k]
                    out[i] += np.bincount((mix(code) >> np.uint64(20)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    return out


def learn(df: DataFrame, most: int, lang: str = "lang", text: str = "text") -> Model:
    """A model of all labelled rows of ``df``: those whose ``lang`` and ``text`` aren't null.

    Counts are made in each task and summed by language and bucket; what reaches the driver is a table of languages
    times buckets, which ``most`` bounds: more labels than the caller has languages are an error. Without any labelled row the model has no language.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for name in set(langs.tolist()):
                    of = np.flatnonzero(langs == name)
                    sums = total.setdefault(name, np.zeros(BUCKETS))
                    for at in range(0, len(of), _ROWS):
                        sums += counts([texts[i] for i in of[at : at + _ROWS]]).sum(axis=0, dtype=np.float64)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    found = languages.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} languages")
    found = sorted(found, key=lambda r: r.lang)
    theta = np.ones((len(found) + 1, BUCKETS))
    for row, r in zip(theta, found):
        for bucket, n in r.counts:
            row[bucket] += n
    theta[:-1] += 0.5
    return Model([r.lang for r in found], theta / theta.sum(axis=1, keepdims=True))


def _fit(c: np.ndarray, theta: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each row of counts; ``used`` says which distributions a row may have."""
    n = np.maximum(c.sum(axis=1, keepdims=True), 1)
    share = used / used.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        new = share * ((c / np.maximum(share @ theta, 1e-30)) @ theta.T) / n
        new /= np.maximum(new.sum(axis=1, keepdims=True), 1e-30)
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, (c * np.log(np.maximum(share @ theta, 1e-30))).sum(axis=1)


def proportions(c: np.ndarray, model: Model) -> np.ndarray:
    """Proportions of all distributions in each row of counts, with the set of languages that the penalty leaves."""
    theta = model.theta.astype(np.float32)
    used = np.ones((len(c), len(theta)), dtype=np.float32)
    share, fit = _fit(c, theta, used)
    penalty = 0.5 * np.log(np.maximum(c.sum(axis=1), 2))
    open = np.arange(len(c))
    while len(open):
        # without their weakest distribution, documents that have more than one
        open = open[used[open].sum(axis=1) > 1]
        if not len(open):
            break
        fewer = used[open].copy()
        weakest = np.where(fewer > 0, share[open], np.inf).argmin(axis=1)
        fewer[np.arange(len(open)), weakest] = 0
        s, f = _fit(c[open], theta, fewer)
        better = f + penalty[open] >= fit[open]
        open, s, f, fewer = open[better], s[better], f[better], fewer[better]
        used[open], share[open], fit[open] = fewer, s, f
    return share


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``languages`` and ``other`` to each row; columns of these names are replaced.

    ``lang_pred`` is the language of the largest proportion (ties to the smaller label) and ``score`` that proportion
    among the languages; ``languages`` maps the languages selected to their proportions, and ``other`` is the share
    that no language explains. A text that is null or has no letter, and any text under a model without languages,
    is ``und`` with score 0, no languages and ``other`` 1. Whole texts are read; repeated rows give equal results.
    The model travels with the tasks (languages times buckets, see ``learn``).
    """
    ship(df.sparkSession)
    new = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("other", T.DoubleType()),
    ]
    kept = [c for c in df.columns if c not in {f.name for f in new}]
    if text not in kept:
        raise ValueError(f"{text} is the name of a result")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for big in slices(batch, text):
                for at in range(0, big.num_rows, _ROWS):
                    part = big.slice(at, _ROWS)
                    texts = part.column(text).to_pylist()
                    pred, score, sets, other = [UNKNOWN] * len(texts), [0.0] * len(texts), [{} for _ in texts], [1.0] * len(texts)
                    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model.labels else []
                    if known:
                        share = proportions(counts([texts[i].encode() for i in known]), model)
                        for i, s in zip(known, share.astype(float)):
                            total = s[:-1].sum()
                            other[i] = min(max(1 - total, 0.0), 1.0)
                            of = s[:-1] / total if total > 0 else np.full(len(s) - 1, 1 / (len(s) - 1))
                            best = int(of.argmax())
                            pred[i], score[i] = model.labels[best], min(float(of[best]), 1.0)
                            sets[i] = {model.labels[j]: float(of[j]) for j in np.flatnonzero(of > 1e-3)}
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                            pa.array([list(x.items()) for x in sets], pa.map_(pa.string(), pa.float64())), pa.array(other, pa.float64()),
                        ],
                        names=[*kept, *(f.name for f in new)],
                    )

    return df.select(*kept).mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *new]))


def held_out(id: Column) -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_languages(df: DataFrame, model: Model, text: str = "text", most_other: float = 0.9, wanted: Sequence[str] | None = None, into: str | None = None) -> DataFrame:
    """The rows of ``df`` in some language: those with a letter of which no more than ``most_other`` is no language.

    ``wanted`` names the languages to keep (default: all that the model has); ``into`` is a column that takes the
    prediction. Null and empty texts have no language and go, as all rows do under a model without languages; rows that
    repeat are kept or go together; an empty table stays empty.
    """
    marked = identify(df.withColumnsRenamed({c: f"kept_{n}" for n, c in enumerate(df.columns)}), model, f"kept_{df.columns.index(text)}")
    found = (F.col("lang_pred") != UNKNOWN) & (F.col("other") <= most_other)
    if wanted is not None:
        found = found & F.col("lang_pred").isin(*wanted)
    columns = [F.col("lang_pred" if c == into else f"kept_{n}").alias(c) for n, c in enumerate(df.columns)]
    return marked.where(found).select(*columns)
