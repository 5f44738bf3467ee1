"""Substring dedup over words: super-k-mer partitioning.

Consecutive windows of words that share a minimiser travel as one packed string to the
minimiser's bucket (see ``shared_windows``). There the words of all strings are numbered, windows
are ranked by doubling the ranked length, and sorting the ranks brings equal windows together: a
group's size is the window's exact count and its least document the one that keeps it.

Defined results: a null or empty text has no words and keeps nothing; a text shorter than a window
is kept whole; rows with the same doc_id never remove from each other; a row without doc_id is
kept whole and removes nothing; an empty table gives no rows; all other columns are carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared_windows import Method, Tokens, judged
from .textbytes import SPACED, blocks, covered, span_hashes, text_bytes, words

WINDOW = 13
GRAM = 5


def packed_words(raw: np.ndarray, off: np.ndarray) -> Tokens:
    """Words of the texts, each followed by one space in the packed bytes."""
    start, end, edge = words(raw, off, SPACED)
    length = end - start + 1
    stop = np.cumsum(length)
    packed = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    keep = np.ones(len(packed), bool)
    keep[stop - 1] = False
    packed[keep] = raw[SPACED[raw]]
    begin, stop = stop - length, stop - 1
    return Tokens(packed, begin, stop, edge, span_hashes(packed, begin, stop) if len(begin) else np.zeros(0, np.uint64))


def ranks(token: np.ndarray, size: int) -> np.ndarray:
    """For every run of size tokens a number, equal for equal runs and ascending with them."""
    rank, width = np.unique(token, return_inverse=True)[1], 1
    while width < size:
        step = min(width, size - width)
        if len(rank) <= step:
            return rank[:0]
        rank = np.unique(rank[:-step] * (1 << 32) + rank[step:], return_inverse=True)[1]
        width += step
    return rank


def least_documents(texts: list[bytes], least: np.ndarray, size: int = WINDOW) -> np.ndarray:
    number: dict[bytes, int] = {}
    cut = [t.split(b" ") for t in texts]
    token = np.array([number.setdefault(w, len(number)) for t in cut for w in t], np.int64)
    count = np.array([len(t) for t in cut], np.int64)
    window = np.ones(len(token), bool)
    stop = np.cumsum(count)
    for back in range(1, size):
        window[stop - back] = False
    at = np.flatnonzero(window)
    rank = ranks(token, size)[at]
    owner = np.repeat(least, count)[at]
    order = np.argsort(rank, kind="stable")
    new = np.ones(len(at), bool)
    new[1:] = rank[order][1:] != rank[order][:-1]
    lowest = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    out = np.empty(len(at), np.int64)
    out[order] = lowest[np.cumsum(new) - 1]
    return out


def method(window: int = WINDOW, gram: int = GRAM) -> Method:
    return Method(
        size=window,
        gram=gram,
        tokens=packed_words,
        owners=lambda texts, least: least_documents(texts, least, window),
        windows=lambda text: text.count(b" ") + 2 - window,
    )


_RESULT = StructType().add("n_words", "long").add("n_removed", "long").add("kept_text", "string")


def _finish(window: int, kept_columns: list[str], verbatim: bool):
    def run(table: pa.Table, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Table:
        raw, off = text_bytes(table.column("text"))
        order = np.argsort(row, kind="stable")
        row, first, last = row[order], first[order], last[order]
        n_words, n_removed, kept = [], [], []
        for lo, hi in blocks(off):
            tokens = packed_words(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            a, b = np.searchsorted(row, [lo, hi])
            base = tokens.edge[row[a:b] - lo]
            gone = covered(base + first[a:b], base + last[a:b] + window, len(tokens.start))
            stays = np.repeat(~gone, tokens.end - tokens.start + 1)
            running = np.zeros(len(tokens.raw) + 1, np.int64)
            np.cumsum(stays, out=running[1:])
            text = tokens.raw[stays].tobytes()
            word_at = np.append(tokens.start, len(tokens.raw))
            cut = running[word_at[tokens.edge]].tolist()
            kept += [text[x : y - 1] if y > x else b"" for x, y in zip(cut[:-1], cut[1:], strict=True)]
            words_gone = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=words_gone[1:])
            n_words.append(np.diff(tokens.edge))
            n_removed.append(np.diff(words_gone[tokens.edge]))
        empty = np.zeros(0, np.int64)
        out = {c: table.column(c) for c in kept_columns}
        out["n_words"] = pa.array(np.concatenate([*n_words, empty]))
        out["n_removed"] = pa.array(np.concatenate([*n_removed, empty]))
        text = pa.array(kept, pa.binary()).cast(pa.string())
        if verbatim:
            given = table.column("text").combine_chunks()
            text = pc.if_else(pc.equal(out["n_removed"], 0), given, text)
        out["kept_text"] = text
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, verbatim: bool = False) -> DataFrame:
    """(doc_id, others, n_words, n_removed, kept_text): others holds the remaining columns of docs.

    kept_text is the kept words joined by one space; verbatim: a text that keeps all stays as it is.
    """
    kept = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("_")).alias("others"),
    )
    schema = StructType([kept.schema["doc_id"], kept.schema["others"], *_RESULT])
    return judged(kept, method(window, gram), _finish(window, ["doc_id", "others"], verbatim), schema)
