"""Cross-tokenizer alignment by merge-path partitioning.

Both tokenizers cut the same bytes, so the ends of their tokens are two sorted lists, and aligning them is a merge:
where both lists have an end a group ends, and between two neighbouring ends of either list lies the overlap of just
one token of A with one of B. Diagonals of the merge grid divide that merge into pieces of equal work: a binary search
on each diagonal finds how many ends of A and of B lie before it. Pieces know nothing of each other; each gives its
overlaps and the common ends that it has seen. An end of B whose equal in A fell into the piece before is recognised by
looking back one place, and groups that go over a boundary are put together when all common ends are known.

The counts of linked id pairs are Spark's: each document gives its distinct pairs with how often it holds them, pairs
are counted over documents, and the counts go back to the documents. Pairs that hold a fixed share of all rows are few
by that definition; they are broadcast, so neither join has a hot key.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import cut, ship, slices, stored

#: Ends that a piece of the merge holds.
PIECE = 1 << 16
#: A pair is broadcast with its count if it has one in so many of all rows; there are no more such pairs than this.
HOT = 50_000

_SPACE = "▁"  # how pieces write a space
#: ASCII and the accented Latin letters.
_OLD = re.compile("[\x00-\x7f\u00c0-\u024f]*")


class Pair:
    """Two vocabularies: a byte-level BPE file (A) and a piece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        from tillroll.llm.bpe import _PATTERN, _byte_letters

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            plain = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if plain else token.encode()
        special = set(self.a.get_added_tokens_decoder())
        ranks = {t: i for i, t in enumerate(self.a_bytes) if i not in special}
        self.a_fast = Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        # what stands after an id: 0 nothing, 1 and 2 go on in the group, 3 ends the group's A side, 4 the group
        self.marks = ["", ",", ",", "|", ";"]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A for a space and the text, and of B for the text, which puts a space first itself; no ids for empty
        texts and where the bytes of the tokens are not that text.

        Texts of letters that have been in Unicode from its first version go through the faster library, which reads the
        same vocabulary and knows the same letters there.
        """
        none = np.zeros(0, dtype=np.int64)
        a, b = [none] * len(texts), [none] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        late = [i for i in some if not _OLD.fullmatch(texts[i])]
        slow = dict(zip(late, self.a.encode_batch_fast([" " + texts[i] for i in late], add_special_tokens=False)))
        for i, y in zip(some, self.b.encode([texts[i] for i in some], num_threads=1)):
            want = " " + texts[i]
            if want.encode("utf-8") != b"".join(map(self.b_bytes.__getitem__, y)):
                continue
            x = np.array(slow[i].ids) if i in slow else self.a_fast.encode_to_numpy(want, disallowed_special=())
            if int(self.a_size[x].sum()) == int(self.b_size[y].sum()):  # a byte-level vocabulary changes no byte
                a[i], b[i] = x.astype(np.int64), np.array(y, dtype=np.int64)
        return a, b


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first ``at`` elements of the merge of ``a`` and ``b`` are of ``a``; equal ones of ``a`` go first.

    A binary search on each diagonal, all of them at once.
    """
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        # a[mid] is among the first if it goes before the last of b that could be
        taken = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(at - 1 - mid, 0, len(b) - 1)])
        low = np.where(taken, mid + 1, low)
        high = np.where(open_ & ~taken, mid, high)
    return low


def piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps (number of the A token, of the B token) and common ends (the same) of one piece of the merge."""
    own_a, own_b = a[i0:i1], b[j0:j1]
    before = np.searchsorted(own_a, own_b)
    tied = np.zeros(len(own_b), dtype=bool)
    if len(own_a):
        tied = own_a[np.minimum(before, len(own_a) - 1)] == own_b
    if i0 and len(own_b):
        tied[0] |= a[i0 - 1] == own_b[0]  # its equal ended the piece before
    i = np.arange(i0, i1)
    single = np.flatnonzero(~tied)
    common = np.flatnonzero(tied)
    ends = np.searchsorted(a, own_b[common]) if len(common) else common
    return (
        np.concatenate((i, i0 + before[single])),
        np.concatenate((j0 + np.searchsorted(own_b, own_a), j0 + single)),
        ends,
        j0 + common,
    )


def merge(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps and common ends of two lists of ends that stop at the same place, piece by piece."""
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, size), total)
    i = diagonals(a, b, at) if len(a) and len(b) else np.minimum(at, len(a))
    j = at - i
    parts = [piece(a, b, *x) for x in zip(i, i[1:], j, j[1:])]
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts))


def group_texts(pair: Pair, a: np.ndarray, b: np.ndarray, a_of: np.ndarray, b_of: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, rows: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text: ids of A and of B group by group, for tokens in order of their texts.

    ``a_of`` and ``b_of`` are the tokens' texts, ``a_end`` and ``b_end`` the last tokens of all groups, in order.
    """
    a_group = np.searchsorted(a_end, np.arange(len(a)))
    b_group = np.searchsorted(b_end, np.arange(len(b)))
    a_at = np.arange(len(a)) + np.concatenate(([0], b_end + 1))[a_group]  # B tokens of the groups before
    b_at = np.arange(len(b)) + (a_end + 1)[b_group]  # A tokens up to this group
    a_mark, b_mark = np.full(len(a), 1), np.full(len(b), 2)
    a_mark[a_end] = 3
    b_mark[b_end] = 4
    b_mark[np.append(b_of[1:] != b_of[:-1], True)[: len(b)]] = 0
    code, mark = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    code[a_at], code[b_at] = a, b
    mark[a_at], mark[b_at] = a_mark, b_mark
    words = list(map(_written(pair).__getitem__, (code * 5 + mark).tolist()))
    ends = np.searchsorted(a_of, np.arange(rows), side="right") + np.searchsorted(b_of, np.arange(rows), side="right")
    return ["".join(words[s:e]) for s, e in zip([0, *ends.tolist()], ends.tolist())]


@lru_cache(maxsize=2)
def _written(pair: Pair) -> list[str]:
    """An id and what stands after it, by ``id * 5 + mark``."""
    return [f"{i}{m}" for i in range(max(len(pair.a_bytes), len(pair.b_bytes))) for m in pair.marks]


_NEW = "n_a long, n_b long, n_groups long, n_links long, groups string"


def _aligned(df: DataFrame, kept: list[str], a_path: str, b_path: str, text: str, digest: bool) -> DataFrame:
    """``kept``, the columns of ``_NEW``, a number ``row`` of the row and its distinct ``pairs`` with ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        of = TaskContext.get()
        row = (of.partitionId() if of else 0) << 40
        for batch in batches:
            for part in slices(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                x, y = both.encode(texts)
                n_a, n_b = (np.array([len(v) for v in z], dtype=np.int64) for z in (x, y))
                a, b = (np.concatenate(z) for z in (x, y))
                of_a, of_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
                # texts follow each other, so that their ends are one sorted list
                i, j, a_end, b_end = merge(np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]))
                written = group_texts(both, a, b, of_a, of_b, a_end, b_end, len(texts))
                if digest:
                    written = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
                kinds = len(both.a_bytes) * len(both.b_bytes)
                code, times = np.unique(of_a[i] * kinds + a[i] * len(both.b_bytes) + b[j], return_counts=True)
                number, code = code // kinds, code % kinds
                at = pa.array(np.searchsorted(number, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in kept),
                        pa.array(n_a),
                        pa.array(n_b),
                        pa.array(np.bincount(of_a[a_end], minlength=len(texts))),
                        pa.array(np.bincount(of_a[i], minlength=len(texts))),
                        pa.array(written, pa.string()),
                        pa.array(row + np.arange(len(texts))),
                        pa.ListArray.from_arrays(at, pa.array(code)),
                        pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))),
                    ],
                    names=[*kept, "n_a", "n_b", "n_groups", "n_links", "groups", "row", "pairs", "times"],
                )
                row += len(texts)

    schema = T.StructType([*(df.schema[c] for c in kept), *T.StructType.fromDDL(f"{_NEW}, row long, pairs array<long>, times array<int>").fields])
    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None, digest: bool = False, hot: int = HOT) -> DataFrame:
    """Align the tokens of two tokenizers on each text; add how they align and how usual that is in the corpus.

    ``n_a`` and ``n_b`` are the numbers of tokens, ``groups`` the smallest groups of tokens that cover the same bytes,
    written ``a1,a2|b1;a3|b2,b3`` (with ``digest`` the SHA-256 of that, but nothing where there is no token),
    ``n_groups`` their number and ``n_links`` the number of token pairs that overlap. Of an id pair, its count is the
    number of documents that hold it linked: ``count_sum`` adds it up over links, ``n_best`` counts links whose count is
    the highest that their A id has. The A side reads a space and the text, which is what the B side reads.

    Null and empty texts have no tokens: zeros and an empty string; so have texts whose tokens do not spell them (a
    text with U+2581, which pieces use for the space). Strings of special tokens are plain text. Each row counts as a
    document, also where it repeats another; rows that repeat get equal results. Very long texts are merged in pieces.
    ``keep`` are the columns to return (default: all); columns named as new ones are replaced. Paths must be readable on
    every executor.
    """
    ship(df.sparkSession)
    new = [f.name for f in T.StructType.fromDDL(_NEW)] + ["count_sum", "n_best"]
    kept = [c for c in (keep if keep is not None else df.columns) if c not in new]
    inner = {c: f"kept_{n}" for n, c in enumerate(kept)}
    slim = df.select(*(F.col(c).alias(n) for c, n in inner.items()), F.col(text).alias("text"))
    rows = stored(_aligned(slim, list(inner.values()), a_path, b_path, "text", digest))

    held = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    held = cut(held.withColumn("a", F.floor(F.col("pair") / F.lit(_b_size(b_path)))))
    top = held.groupBy("a").agg(F.max("n").alias("top"))
    counts = cut(held.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    total = counts.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    # a table of no more than ``hot`` pairs is sent whole; of a larger one those that ``hot`` of at most can be
    least = 0 if total.kinds <= hot else total.n // hot + 1
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    often = links.join(F.broadcast(counts.where(F.col("n") >= least)), "pair", "left")
    sums = [F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best")]
    found = often.where("n is not null").groupBy("row").agg(*sums)
    if least:
        rest = often.where("n is null").select("row", "pair", "times").join(counts.where(F.col("n") < least), "pair")
        found = found.union(rest.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = rows.drop("pairs", "times").join(found, "row", "left")
    last = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("count_sum", "n_best")]
    return out.select(*(F.col(n).alias(c) for c, n in inner.items()), "n_a", "n_b", "n_groups", "n_links", "groups", *last)


@lru_cache(maxsize=2)
def _b_size(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
