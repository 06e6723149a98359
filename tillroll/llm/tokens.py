"""Token counts by a finite-state transducer compiled from a piece vocabulary.

A vocabulary of scored pieces (BPE with byte fallback) joins the two neighbours that make the best piece, the
leftmost first. Three facts turn that into a deterministic machine that reads a text once, from left to right:

* A sequence of pieces is the tokenizer's own for its text if and only if each two neighbours are so for theirs.
* Hence the last piece of every prefix follows from the last pieces of shorter prefixes: it is the piece that
  ends here, stands alone, and fits what ends where it starts. Only prefixes that a piece can still reach matter.
* Characters that meet inside no piece are a certain cut: the machine is then where it was at the start.

A state is therefore the reachable tail with the last piece and the relative count at each of its places; an arc
carries the number of tokens that it emits. States and arcs are compiled when a text first needs them. The number
of states is finite, and a worker starts anew beyond ``STATES``.

Long texts are read in chunks. What a chunk does to any state is its map: the characters before its first cut, the
tokens between, the characters after its last cut. Maps compose associatively, so chunks can be read in any order: a
count composes neighbours in rounds, ``scan`` gives the maps of all prefixes by doubling. A word without a cut is put
together and read by one worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.common import ship, slices, value_bytes

#: States and known words that a worker keeps. Bounds on memory, not on results.
STATES = 400_000
WORDS = 1_000_000
#: Longer runs without a space are read by the machine each time.
WORD_CHARS = 64
#: Characters of a chunk.
CHUNK = 1 << 16

_SPACE = "▁"  # how pieces write a space


class Transducer:
    """The machine of a sentencepiece BPE model with byte fallback and no normaliser."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        plain = not norm.precompiled_charsmap and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or not plain:
            raise ValueError(f"{path}: not a plain BPE model with byte fallback")
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError(f"{path}: user-defined pieces are not read")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        if any(c not in self.score for p in self.score for c in p):
            raise ValueError(f"{path}: a piece has a character that is no piece")
        self.lead = _SPACE if norm.add_dummy_prefix else ""
        self.joined = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.begun = {p[:i] for p in self.score for i in range(1, len(p))}
        # a space after another character is a cut, so words are fragments of their own
        self.by_word = not any(b == _SPACE != a for a, b in self.joined)
        self._word = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+" if self.by_word else r"(?s).+")
        self.words = _Words(self)
        self._alone: dict[str, bool] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._clear()

    def _clear(self) -> None:
        start = ("", "", ("",), (0,))
        self._of = {start: 0}
        self._keys = [start]
        self._arcs: list[dict[str, tuple[int, int]]] = [{}]

    # --- the tokenizer's rule, used to compile arcs ---

    def pieces(self, text: str) -> list[str]:
        """Pieces of a short run by joining neighbours, best score first, then leftmost."""
        parts, score = list(text), self.score
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            s = score.get(parts[i] + parts[j])
            if s is not None:
                heapq.heappush(heap, (-s, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p]

    def _stands(self, piece: str) -> bool:
        known = self._alone.get(piece)
        if known is None:
            known = self._alone[piece] = self.pieces(piece) == [piece]
        return known

    def _fit(self, a: str, b: str) -> bool:
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) > 4 * STATES:
                self._fits.clear()
            known = self._fits[a, b] = self.pieces(a + b) == [a, b]
        return known

    # --- the machine ---

    def step(self, state: int, c: str) -> tuple[int, int]:
        """Follow the arc of a character: (next state, tokens emitted)."""
        arc = self._arcs[state].get(c)
        return arc if arc is not None else self._compile(state, c)

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        previous, tail, lasts, counts = self._keys[state]
        if c not in self.score:
            arc = (0, len(c.encode("utf-8")))  # a token a byte, and a cut on either side
        elif previous and previous + c not in self.joined:
            arc = self.step(0, c)
        else:
            tail += c
            for start in range(len(tail)):
                piece, last = tail[start:], lasts[start]
                if piece in self.score and self._stands(piece) and (not last or self._fit(last, piece)):
                    break
            else:
                raise AssertionError(f"no piece ends at {tail!r}")
            emitted = counts[start] + 1
            lasts, counts = (*lasts, piece), (*(n - emitted for n in counts), 0)
            drop = next((i for i in range(len(tail)) if tail[i:] in self.begun), len(tail))
            key = (c, tail[drop:], lasts[drop:], counts[drop:])
            to = self._of.get(key)
            if to is None:
                to = self._of[key] = len(self._keys)
                self._keys.append(key)
                self._arcs.append({})
            arc = (to, emitted)
        self._arcs[state][c] = arc
        return arc

    def run(self, fragment: str) -> int:
        """Tokens of a run of characters that has a cut on either side."""
        if len(self._keys) > STATES:
            self._clear()
        state, total, arcs = 0, 0, self._arcs
        for c in fragment:
            arc = arcs[state].get(c)
            if arc is None:
                if len(self._keys) > 2 * STATES:  # only texts of one endless word get here
                    key = self._keys[state]
                    self._clear()
                    arcs, state = self._arcs, self._enter(key)
                arc = self._compile(state, c)
            state, n = arc
            total += n
        return total

    def _enter(self, key: tuple) -> int:
        if key not in self._of:
            self._of[key] = len(self._keys)
            self._keys.append(key)
            self._arcs.append({})
        return self._of[key]

    # --- texts ---

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(characters before the first cut, tokens between, characters after the last cut); no cut: (all, None, "")."""
        words = self._word.findall(chunk)
        # the first word may go on a word of the chunk before, the last may be gone on with
        if len(words) < 2:
            return chunk, None, ""
        return words[0], sum(map(self.words.__getitem__, words[1:-1])), words[-1]

    def compose(self, a: tuple[str, int | None, str], b: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two chunks that follow each other. Associative; ("", None, "") changes nothing."""
        if a[1] is None and b[1] is None:
            return self._joint(a[0], b[0])
        if a[1] is None:
            left = self._joint(a[0], b[0])
            return (left[0], b[1], b[2]) if left[1] is None else (left[0], left[1] + self.words[left[2]] + b[1], b[2])
        if b[1] is None:
            right = self._joint(a[2], b[0])
            return (a[0], a[1], right[0]) if right[1] is None else (a[0], a[1] + self.words[right[0]] + right[1], right[2])
        middle = self._joint(a[2], b[0])
        whole = self.words[middle[0]] + (0 if middle[1] is None else middle[1] + self.words[middle[2]])
        return a[0], a[1] + whole + b[1], b[2]

    def _joint(self, left: str, right: str) -> tuple[str, int | None, str]:
        """The map of two pieces of words put together: one word, or two where a cut lies between."""
        if not left or not right or not self.by_word or right[0] != _SPACE or left[-1] == _SPACE:
            return left + right, None, ""
        return left, 0, right

    def scan(self, maps: list[tuple[str, int | None, str]]) -> list[tuple[str, int | None, str]]:
        """Maps of all prefixes, by doubling: after each round a map covers twice as many chunks."""
        out, reach = list(maps), 1
        while reach < len(out):
            out = [self.compose(out[i - reach], m) if i >= reach else m for i, m in enumerate(out)]
            reach *= 2
        return out

    def total(self, maps: list[tuple[str, int | None, str]]) -> tuple[str, int | None, str]:
        """The map of all chunks together, neighbours first: a word over many chunks is copied once a round."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text, without begin or end marks; strings of control pieces are ordinary text."""
        if not text:
            return 0
        text = self.lead + text.replace(" ", _SPACE)
        if len(text) <= chunk:
            return sum(map(self.words.__getitem__, self._word.findall(text)))
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        head, between, tail = self.total(maps)
        return (self.words[head] if head else 0) + (between or 0) + (self.words[tail] if tail else 0)


class _Words(dict):
    """Tokens of words seen before: whole runs of the machine from its start."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        n = self.machine.run(word)
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS:
                self.clear()
            self[word] = n
        return n


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(
    df: DataFrame, path: str, text: str = "text", limit: int = 4096, keep: list[str] | None = None
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of each text.

    A narrow job without a shuffle. Null counts as empty: 0 bytes, 0 tokens. A repeated row gives its row again.
    ``keep`` are the columns to return (default: all); columns with the names of new ones are replaced. ``path``
    must be readable on every executor.
    """
    ship(df.sparkSession)
    new = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    kept = [c for c in (keep if keep is not None else df.columns) if c not in {f.name for f in new}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for part in slices(batch, text):
                n = np.array([machine.count(t or "") for t in part.column(text).to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(value_bytes(part.column(text))), pa.array(n), pa.array(n > limit)],
                    names=[*kept, *(f.name for f in new)],
                )

    schema = T.StructType([*(df.schema[c] for c in kept), *new])
    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
