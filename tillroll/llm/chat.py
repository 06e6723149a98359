"""Chat formatting by columnar byte assembly.

A turn is written as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Control strings
inside a text are broken by a backslash after their first character, and a backslash is doubled, so what a template
marks can't be forged and every text can be read back.

A batch of turns is assembled as columns: the lengths of all segments (headers, roles, texts, ends) give the offsets
of each by a running sum, and the bytes of every column of segments are scattered into one preallocated buffer,
which becomes an Arrow column as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import flat, ship, slices

#: The marks of the template, and control strings of this and other templates.
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_TURN = re.compile(re.escape(START) + r"((?:[^\\\n]|\\[\s\S])*)\n([\s\S]*?)" + re.escape(END) + "\n")
_ESCAPED = re.compile(r"\\([\s\S])")


def escape(texts: pa.Array) -> pa.Array:
    """Texts in which no control string stands; null is empty."""
    out = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    for c in CONTROLS:
        out = pc.replace_substring(out, c, f"{c[0]}\\{c[1:]}")
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def assemble(columns: list[pa.Array | bytes], rows: int) -> tuple[pa.Array, list[np.ndarray]]:
    """Concatenate columns of segments row by row, each a string array or the same bytes for all rows.

    Returns the rows as strings, and where each column's segment begins in its row (in bytes).
    """
    data, lengths = [], []
    for c in columns:
        if isinstance(c, bytes):
            data.append((np.frombuffer(c, dtype=np.uint8), None))
            lengths.append(np.full(rows, len(c), dtype=np.int64))
        else:
            raw, offsets = flat(c)
            data.append((raw, offsets[:-1]))
            lengths.append(np.diff(offsets))
    within = np.cumsum([np.zeros(rows, np.int64), *lengths], axis=0)
    offsets = np.concatenate(([0], np.cumsum(within[-1])))
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    for (raw, begins), length, at in zip(data, lengths, within):
        to = np.repeat(offsets[:-1] + at - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(int(length.sum()))
        out[to] = raw if begins is not None else np.tile(raw, rows)
    array = pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    return array, list(within[:-1])


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = "assistant") -> DataFrame:
    """``(conv, turn, seq, formatted, loss_from, loss_to)``: the formatted bytes of each turn and its loss mask.

    The mask is the part of ``formatted``, in bytes, that holds the text of a turn of the role ``learned``; it is
    empty for others. The turns of a conversation, in the order of ``turn`` (null first), then role and text, put
    together are the formatted conversation; ``seq`` counts them. Null roles and texts are empty; repeated rows are
    repeated turns; rows without a conversation id form one conversation of their own.

    Turns are dealt by conversation and sorted there, so a conversation of any length needs no memory of its own.
    """
    ship(df.sparkSession)
    blank = F.lit("")
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"),
    )
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    kinds = f"conv {rows.schema['conv'].dataType.simpleString()}, turn {rows.schema['turn'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seq = None, 0
        for batch in batches:
            for part in slices(batch, "text"):
                roles = pc.replace_substring(escape(part.column("role")), "\n", "\\\n")
                texts = escape(part.column("text"))
                made, begins = assemble([START.encode(), roles, b"\n", texts, (END + "\n").encode()], part.num_rows)
                is_learned = np.asarray(pc.equal(part.column("role"), learned))
                begin = np.where(is_learned, begins[3], 0)
                end = np.where(is_learned, begins[4], 0)
                seqs = []
                for c in part.column("conv").to_pylist():
                    seq = seq + 1 if (c,) == at else 0
                    at = (c,)
                    seqs.append(seq)
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), part.column("turn"), pa.array(seqs, pa.int64()), made.cast(pa.string()), pa.array(begin), pa.array(end)],
                    names=["conv", "turn", "seq", "formatted", "loss_from", "loss_to"],
                )

    out = dealt.mapInArrow(run, f"{kinds}, seq long, formatted string, loss_from long, loss_to long")
    return out.withColumnsRenamed({"conv": conv, "turn": turn})


def format_conversations(df: DataFrame, **names: str) -> DataFrame:
    """``(conv, formatted)``: whole conversations, for those that fit into a row (2 GB)."""
    conv = names.get("conv", "conv_id")
    turns = format_turns(df, **names).groupBy(conv).agg(F.array_sort(F.collect_list(F.struct("seq", "formatted"))).alias("t"))
    return turns.select(conv, F.array_join(F.col("t.formatted"), "").alias("formatted"))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def read_conversation(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    found = list(_TURN.finditer(formatted))
    if sum(m.end() - m.start() for m in found) != len(formatted):
        raise ValueError("not a formatted conversation")
    return [(unescape(m[1]), unescape(m[2])) for m in found]


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted turns of each conversation hold, read back from them.

    ``n_turns``, ``turns_sha256`` (role, line end, text, line end of each turn), ``loss_chars`` and ``loss_sha256``
    (all text under the mask, unescaped, code points and digest) and ``formatted_chars``. ``turns`` must come dealt
    by conversation and sorted, as ``format_turns`` gives it; digests go on over the batches of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, kind = None, None
        for batch in batches:
            done, kind = [], batch.schema.field(conv).type
            columns = [batch.column(c).to_pylist() for c in (conv, "formatted", "loss_from", "loss_to")]
            for c, formatted, a, b in zip(*columns):
                if state is None or state[0] != c:
                    if state is not None:
                        done.append(state)
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(formatted)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if b > a:
                    loss = unescape(formatted.encode()[a:b].decode())
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += len(formatted)
            if done:
                yield _read(done, kind, conv)
        if state is not None:
            yield _read([state], kind, conv)

    schema = f"{conv} {turns.schema[conv].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return turns.select(conv, "formatted", "loss_from", "loss_to").mapInArrow(run, schema)


def _read(states: list, kind: pa.DataType, conv: str) -> pa.RecordBatch:
    values = [[s[0] for s in states], [s[1] for s in states], [s[2].hexdigest() for s in states], [s[3] for s in states], [s[4].hexdigest() for s in states], [s[5] for s in states]]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)
