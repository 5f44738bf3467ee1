"""Substring dedup over bytes: a run-length index of repeated text.

Windows of 50 bytes are dealt by minimiser (see ``shared_windows``), so all copies of a window meet
in one bucket. A bucket writes its distinct strings behind one another, in ascending order of the
least document that holds them, and builds a Burrows-Wheeler transform of order 50: rows are the
text positions sorted by their next 50 bytes, equal ones by position. The transform is kept as
runs of equal characters, cut also where a context that occurs more than once begins or ends; each
run keeps its character, the rank of that character before it, and the sampled text position of
its first row. In a repetitive text the runs are far fewer than the rows.

Every string then streams backwards through the index, from the sampled row of its last window: a
step finds the run of the current row and maps to the row of the byte before it, so that the
matching statistic, cut at 50, stays at its full length. The first row of a context that occurs
more than once is a run's sampled head, and names the smallest document with that window.

Defined results: a null text is empty; a text under 50 bytes is kept whole; rows with the same
doc_id never remove from each other; a row without doc_id is kept whole and removes nothing;
matches never cross texts; an empty table gives no rows; all other columns are carried.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared_windows import Method, Tokens, judged
from .textbytes import blocks, covered, text_bytes

LENGTH = 50
GRAM = 20
#: a byte that UTF-8 never has, behind every string
_END = 0xFF


def byte_tokens(raw: np.ndarray, off: np.ndarray) -> Tokens:
    at = np.arange(len(raw))
    return Tokens(raw, at, at + 1, off, raw.astype(np.uint64) + np.uint64(1))


def _numbered(key: np.ndarray, bits: int = 64) -> np.ndarray:
    """The rank of each key among the distinct ones; keys of few bits are sorted with their places in the rest."""
    low = max(1, len(key).bit_length())
    if bits + low <= 63:
        ordered = np.sort((key << low) | np.arange(len(key)))
        order, ordered = ordered & ((1 << low) - 1), ordered >> low
    else:
        order = np.argsort(key)
        ordered = key[order]
    new = np.zeros(len(key), np.int32)
    new[1:] = ordered[1:] != ordered[:-1]
    del ordered
    rank = np.empty(len(key), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return rank


def contexts(text: np.ndarray, length: int) -> np.ndarray:
    """For every position the rank of its next length bytes; the text's end counts as byte 0xFF."""
    n, width = len(text), min(8, 1 << (length.bit_length() - 1))
    padded = np.concatenate([text, np.full(length, _END, np.uint8)]).astype(np.uint64)
    key = np.zeros(n + length - width, np.uint64)
    for j in range(width):
        key = (key << np.uint64(8)) | padded[j : j + len(key)]
    rank = _numbered(key)
    while width < length:
        step = min(width, length - width)
        half = (n + length).bit_length()
        rank = _numbered((rank[:-step].astype(np.int64) << half) | rank[step:], 2 * half)
        width += step
    return rank[:n]


class RunLengthIndex(NamedTuple):
    rows: int
    start: np.ndarray  # first row of each run
    context: np.ndarray  # first row of the run's context, or -1 if its rows are contexts that occur once
    sample: np.ndarray  # text position of that row
    key: np.ndarray  # runs by byte and first row
    head: np.ndarray  # in that order: the row that the run's first row comes from
    first: np.ndarray  # in that order: first row
    size: np.ndarray  # in that order: rows
    of_last: np.ndarray  # row of the last full context of each string

    @classmethod
    def build(cls, text: np.ndarray, last: np.ndarray, length: int) -> RunLengthIndex:
        rank = contexts(text, length)
        keyed = np.sort((rank.astype(np.int64) << 32) | np.arange(len(rank)))  # ties by position
        order, ordered = keyed & 0xFFFFFFFF, keyed >> 32
        bwt = text[order - 1]
        opens = np.ones(len(order), bool)
        opens[1:] = ordered[1:] != ordered[:-1]
        several = ~(opens & np.append(opens[1:], True))
        cut = np.ones(len(order), bool)
        cut[1:] = (bwt[1:] != bwt[:-1]) | (opens[1:] & (several[1:] | several[:-1]))
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(order)))
        first_row = np.flatnonzero(opens)[np.cumsum(opens)[start] - 1]
        by_byte = np.argsort(bwt[start], kind="stable")
        head = np.cumsum(size[by_byte]) - size[by_byte]
        key = bwt[start][by_byte].astype(np.int64) * len(order) + start[by_byte]
        context = np.where(several[start], first_row, -1)
        of_last = np.flatnonzero(opens)[rank[last]]  # ranks are dense
        return cls(len(order), start, context, order[first_row], key, head, start[by_byte], size[by_byte], of_last)

    def back(self, row: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """A row whose context is the byte before that of row; the byte does come before it somewhere."""
        at = np.searchsorted(self.key, byte.astype(np.int64) * self.rows + row, "right") - 1
        inside = row - self.first[at]
        after = (at < 0) | (inside < 0) | (inside >= self.size[at]) | (self.key[at] - self.first[at] != byte.astype(np.int64) * self.rows)
        return np.where(after, self.head[np.minimum(at + 1, len(self.head) - 1)], self.head[at] + inside)

    def opened(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row of each row's context, text position sampled there or -1 if it occurs once)."""
        run = np.searchsorted(self.start, row, "right") - 1
        context = self.context[run]
        return np.where(context < 0, row, context), np.where(context < 0, -1, self.sample[run])


def smallest_holders(texts: list[bytes], least: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of every string, the least document of the strings that hold it."""
    size = np.array([len(t) for t in texts], np.int64)
    text = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    end = np.cumsum(size + 1) - 1
    index = RunLengthIndex.build(text, end - length, length)
    count = size - length + 1
    out = np.repeat(least, count)
    window = np.cumsum(count) - 1  # the last of each string
    # all strings step back together, the longest first, so that those at their start fall off the end
    order = np.argsort(-count, kind="stable")
    window, count, place = window[order], count[order], (end - length)[order]
    row, sample = index.opened(index.of_last[order])
    for back in range(int(count[0])):
        if back:
            active = int(np.searchsorted(-count, -back, "left"))
            window, place = window[:active] - 1, place[:active] - 1
            row, sample = index.opened(index.back(row[:active], text[place]))
        seen = np.flatnonzero(sample >= 0)
        out[window[seen]] = least[np.searchsorted(end, sample[seen])]
    return out


def method(length: int = LENGTH, gram: int = GRAM) -> Method:
    return Method(
        size=length,
        gram=gram,
        tokens=byte_tokens,
        owners=lambda texts, least: smallest_holders(texts, least, length),
        windows=lambda text: len(text) - length + 1,
    )


_RESULT = StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")


def _finish(length: int, carried: list[str]):
    def run(table: pa.Table, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Table:
        raw, off = text_bytes(table.column("text"))
        order = np.argsort(row, kind="stable")
        row, first, last = row[order], first[order], last[order]
        removed, spans, kept = [], [], []
        for lo, hi in blocks(off):
            edge = off[lo : hi + 1] - off[lo]
            a, b = np.searchsorted(row, [lo, hi])
            base = edge[row[a:b] - lo]
            gone = covered(base + first[a:b], base + last[a:b] + length, int(edge[-1]))
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            heads = edge[:-1][edge[:-1] < edge[1:]]
            opens[heads] = gone[heads]
            running = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=running[1:])
            opened = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(opens, out=opened[1:])
            removed.append(np.diff(running[edge]))
            spans.append(np.diff(opened[edge]))
            text = raw[off[lo] : off[hi]][~gone].tobytes()
            cut = (edge - running[edge]).tolist()
            kept += [text[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
        empty = np.zeros(0, np.int64)
        out = {c: table.column(c) for c in carried}
        out["n_bytes"] = pa.array(np.diff(off))
        out["n_removed"] = pa.array(np.concatenate([*removed, empty]))
        out["n_spans"] = pa.array(np.concatenate([*spans, empty]))
        out["kept"] = pa.array(kept, pa.binary())
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, others, n_bytes, n_removed, n_spans, kept): others holds the remaining columns of docs."""
    kept = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("_")).alias("others"),
    )
    schema = StructType([kept.schema["doc_id"], kept.schema["others"], *_RESULT])
    return judged(kept, method(length, gram), _finish(length, ["doc_id", "others"]), schema)
