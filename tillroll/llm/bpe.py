"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over, so every place where such a
pair stands is a certain cut. A text is first parted as the tokenizer's own pattern parts it (a cut is not
enough: the pattern looks at what stands around it), each part is cut at its forced boundaries, and the
resulting fragments are encoded independently of each other. Ids of the parts are concatenated.

Since fragments are independent, their ids are kept: a text of words already seen costs one lookup a word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.common import ship, slices

#: Parts and fragments whose ids a worker keeps; beyond it starts anew. A bound on memory, not on results.
KEPT = 400_000
#: Longer parts and fragments (no words) are encoded each time.
KEPT_BYTES = 64

#: Fixed value: the part pattern of byte-level vocabularies.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Vocabulary files write bytes as letters: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _newer_letters(path: str) -> tuple[regex.Pattern | None, regex.Pattern | None]:
    """Letters and digits of a later Unicode than the tokenizers library knows, and the pattern for texts with them.

    The library is asked once for the class of each such character. An executor without it fails: guessed classes would
    give other ids.
    """
    from tokenizers import Tokenizer

    ask = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    odd = []
    for kind, mate in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        every = regex.findall(kind, "".join(map(chr, (*range(0x100, 0xD800), *range(0xE000, 0x110000)))))
        for start in range(0, len(every), 4096):
            some = every[start : start + 4096]
            # one part where the library takes the character for what its mate is, two where not
            ends = {end for _, (_, end) in ask("".join(f"{mate}{c} " for c in some))}
            odd += [c for i, c in enumerate(some) if 3 * i + 1 in ends]
    if not odd:
        return None, None
    codes = np.array(sorted(map(ord, odd)))
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    listed = "".join(f"{regex.escape(chr(r[0]))}-{regex.escape(chr(r[-1]))}" for r in runs)
    one = lambda kind: rf"(?:(?![{listed}]){kind})"
    rest = rf"(?:[^\s\p{{L}}\p{{N}}]|[{listed}])"
    return regex.compile(f"[{listed}]"), regex.compile(
        _PATTERN.replace(r"[^\s\p{L}\p{N}]+", rest + "+").replace(r" ?\p{L}+", " ?" + one(r"\p{L}") + "+").replace(r" ?\p{N}+", " ?" + one(r"\p{N}") + "+")
    )


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizer file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.ids = vocab
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for t, i in [*vocab.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.tokens[i] = t
        self.byte_ids = [vocab[bytes([b])] for b in range(256)]
        # (left id, right id) -> rank; results: what the merge of a rank gives
        self.ranks: dict[tuple[int, int], int] = {}
        self.results: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.ranks.setdefault((vocab[a], vocab[b]), rank)
            self.results.append(vocab[a + b])
        self.none = len(self.results)
        self.joined = np.zeros((256, 256), dtype=bool)
        for t in vocab:
            for a, b in zip(t, t[1:]):
                self.joined[a, b] = True
        self._inside = self.joined.tobytes()  # by 256 * left + right
        self._part = regex.compile(_PATTERN)
        self._odd, self._odd_part = _newer_letters(path)
        special = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self._special = regex.compile(f"({special})") if special else None
        self._parts = _Parts(self)
        self._fragments: dict[bytes, bytes] = {}

    def cuts(self, part: bytes) -> list[bytes]:
        """Fragments of a part: it is cut wherever no token holds the two bytes that meet."""
        if len(part) < 64:
            inside, out, start = self._inside, [], 0
            for i, (a, b) in enumerate(zip(part, part[1:]), 1):
                if not inside[a << 8 | b]:
                    out.append(part[start:i])
                    start = i
            return [*out, part[start:]] if part else []
        b = np.frombuffer(part, dtype=np.uint8)
        at = [0, *(np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1).tolist(), len(part)]
        return [part[i:j] for i, j in zip(at, at[1:])]

    def fragment(self, f: bytes) -> bytes:
        """Ids of a fragment as little-endian 32-bit integers: the pair of lowest rank merges, leftmost first."""
        known = self._fragments.get(f)
        if known is not None:
            return known
        ids = [self.byte_ids[b] for b in f]
        ids = self._merge_short(ids) if len(ids) <= KEPT_BYTES else self._merge_long(ids)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(f) <= KEPT_BYTES:
            if len(self._fragments) >= KEPT:
                self._fragments.clear()
            self._fragments[f] = out
        return out

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.ranks.get, self.none
        found = [get(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            at = found.index(best)
            ids[at : at + 2] = [self.results[best]]
            del found[at]
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]), none)
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a linked list and a heap, for runs of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.ranks.get
        heap = [(m, i, *p) for i, p in enumerate(zip(ids, ids[1:])) if (m := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            to = ids[i] = self.results[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := get((to, ids[k]))) is not None:
                    heapq.heappush(heap, (m, i, to, ids[k]))
            if (h := before[i]) >= 0 and (m := get((ids[h], to))) is not None:
                heapq.heappush(heap, (m, h, ids[h], to))
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; strings of special tokens become those."""
        part = self._part
        if not text.isascii() and self._odd is not None and self._odd.search(text):
            part = self._odd_part
        if self._special is None or not any(s in text for s in self.special):
            return b"".join(map(self._parts.__getitem__, part.findall(text)))
        out = []
        for i, piece in enumerate(self._special.split(text)):
            if i % 2:
                out.append(np.array([self.special[piece]], dtype="<u4").tobytes())
            else:
                out += map(self._parts.__getitem__, part.findall(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        values = np.frombuffer(ids, dtype="<u4")
        if len(values) and int(values.max()) >= len(self.tokens):
            values = values[values < len(self.tokens)]
        return b"".join(map(self.tokens.__getitem__, values.tolist())).decode("utf-8", errors="replace")


class _Parts(dict):
    """Ids by part of a text, filled as parts turn up."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, part: str) -> bytes:
        out = b"".join(map(self.bpe.fragment, self.bpe.cuts(part.encode("utf-8"))))
        if len(part) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[part] = out
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def _with(batch: pa.RecordBatch, kept: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new.values()], names=[*kept, *new])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add the token ids of ``text`` as an ``array<int>`` column.

    A narrow job: no shuffle, a batch of bounded size at a time. Null counts as empty and gives no ids; a
    repeated row gives its row again. ``keep`` are the columns to return (default: all but ``ids``); a column
    that has the name of the new one is replaced. ``path`` must be readable on every executor.
    """
    ship(df.sparkSession)
    kept = [c for c in (keep if keep is not None else df.columns) if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, text):
                coded = [bpe.encode(t or "") for t in part.column(text).to_pylist()]
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
                yield _with(part, kept, {ids: pa.ListArray.from_arrays(pa.array(ends), values)})

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, _schema(df, kept, f"{ids} array<int>"))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of ``ids``, special tokens written out. Null or no ids give the empty text."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(np.array([] if v is None else v, dtype="<u4").tobytes()) for v in _lists(batch.column(ids))]
            yield _with(batch, kept, {text: pa.array(texts, pa.string())})

    return df.mapInArrow(run, _schema(df, kept, f"{text} string"))


def _lists(a: pa.Array) -> Iterator[np.ndarray | None]:
    for v in a:
        yield v.values.drop_null().to_numpy(zero_copy_only=False) if v.is_valid else None


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode in one pass, returning digests of both: ``n_tokens``, ``ids_sha256`` (ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256`` (UTF-8 of the decoded text).

    Null counts as empty: no ids, digests of nothing. A very long text is a batch of its own; a repeated row gives its
    row again; an empty table has no rows. ``keep`` are the columns to return (default: all); columns named as new ones
    are replaced.
    """
    ship(df.sparkSession)
    new = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = [c for c in (keep if keep is not None else df.columns) if c not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in slices(batch, text):
                n, a, b = [], [], []
                for t in part.column(text).to_pylist():
                    coded = bpe.encode(t or "")
                    n.append(len(coded) // 4)
                    a.append(sha(coded))
                    b.append(sha(bpe.decode(coded).encode("utf-8")))
                yield _with(part, kept, {new[0]: pa.array(n, pa.int64()), new[1]: pa.array(a, pa.string()), new[2]: pa.array(b, pa.string())})

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(
        run, _schema(df, kept, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    )


def _schema(df: DataFrame, kept: list[str], new: str) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in kept), *T.StructType.fromDDL(new).fields])
