"""Benchmark decontamination by winnowing.

A text's fingerprints are the hashes of its k-word grams; of every ``width`` consecutive ones the
least is kept, with all that tie. Two texts that share k + width - 1 words or more therefore share a
kept fingerprint inside that span, whatever surrounds it. Fingerprints of the items are joined with
those of the documents, and each hit is extended to both sides to every whole window around it. With
k = 5 and width = 6 no shared run of 10 words is missed. A window counts if an item has it word for
word: hashes only choose what is compared. Each window of a document is looked up once, however
many places of however many items it occurs in, so repeated words cost no more than others.

An item of fewer than 10 words is one window of its own length n; a document is then fingerprinted
for that n too (k = n, width 1, at most nine such lengths).

Items are sent to every task if they are at most ``most_sent`` words (checked by a sum). Beyond that
the documents' fingerprints are joined with the items' by a shuffle, and each task extends the hits of
its documents against the items that were hit there.

Defined results: a null or empty text has no words and no hits; an item without words is never
hit; items with equal text are all reported; rows with equal doc_id are judged each for itself; a
null item_id counts as no item; empty tables give no rows, or rows without hits; all other columns
are carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sizes import dealt, parts
from .textbytes import ALNUM, blocks, covered, gram_hashes, lowered, sliding_min, span_hashes, text_bytes, words

WINDOW = 10
GRAM = 5
#: words of all items together that are sent to every task, about 200 bytes each there with the window they begin
MOST_SENT = 1_000_000
_NONE = np.zeros(0, np.int64)


class Texts:
    """Words of a block of texts: bytes, hashes, and the first word of each text and the end."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        raw = lowered(raw)
        self.start, self.end, self.edge = words(raw, off, ALNUM)
        self.hashes = span_hashes(raw, self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)
        self.text = np.repeat(np.arange(len(self.edge) - 1), np.diff(self.edge))
        self.stop = self.edge[1:][self.text]
        self.data = raw.tobytes()

    def windows(self, first: np.ndarray, n: int) -> Iterator[bytes]:
        """The n words from each of these on, with a blank between."""
        for a in first.tolist():
            yield b" ".join([self.data[x:y] for x, y in zip(self.start[a : a + n].tolist(), self.end[a : a + n].tolist(), strict=True)])

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of the k-word grams that lie in one text."""
        h = gram_hashes(self.hashes, k)
        at = np.flatnonzero(np.arange(k, k + len(h)) <= self.stop[: len(h)])
        return h[at], at

    def fingerprints(self, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The winnowed grams: the least, all that tie, of every width consecutive ones of a text."""
        h, at = self.grams(k)
        if width == 1 or not len(h):
            return h, at
        least = sliding_min(h, width)
        inside = self.text[at[: len(least)]] == self.text[at[width - 1 :]] if len(least) else np.zeros(0, bool)
        chosen = np.zeros(len(h), bool)
        for back in range(width):  # a gram is kept if it is the least of a window that holds it
            part = h[back : back + len(least)] == least
            chosen[back : back + len(least)] |= part & inside
        return h[chosen], at[chosen]


class Items:
    """Benchmark items: for each window length, fingerprints and window hashes, sorted, and who has each window."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int, gram: int):
        if gram >= window:
            raise ValueError("a window needs more than one gram")
        raw, off = text_bytes(texts)
        block = Texts(raw, off)
        self.ids = ids
        length = np.minimum(np.diff(block.edge), window)
        self.lengths: list[tuple[int, int, int]] = []
        self.prints: dict[int, np.ndarray] = {}
        self.hashes: dict[int, np.ndarray] = {}
        self.holders: dict[int, dict[bytes, list[int]]] = {}
        for n in np.unique(length[length > 0]).tolist():
            k, width = _gram(n, window, gram)
            h, at = block.fingerprints(k, width)
            self.prints[n] = np.unique(h[length[block.text[at]] == n])
            whole, first = block.grams(n)
            mine = length[block.text[first]] == n
            self.hashes[n] = np.unique(whole[mine])
            holders = self.holders[n] = {}
            for text, item in zip(block.windows(first[mine], n), block.text[first[mine]].tolist(), strict=True):
                held = holders.setdefault(text, [])
                if not held or held[-1] != item:
                    held.append(item)
            self.lengths.append((n, k, width))


def _gram(n: int, window: int, gram: int) -> tuple[int, int]:
    """Words of a gram and grams of a winnowing window, for windows of n words."""
    return (gram, window - gram + 1) if n == window else (n, 1)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Mask of the values in an ascending array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def hits(doc: Texts, items: Items) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
    """(first word, word behind the last) of every window that an item has, and the items of each text."""
    begin, end = [_NONE], [_NONE]
    seen: list[dict[bytes, list[int]]] = [{} for _ in range(len(doc.edge) - 1)]
    for n, k, width in items.lengths:
        h, at = doc.fingerprints(k, width)
        at = at[_among(h, items.prints[n])]
        if not len(at):
            continue
        # all windows of the text that hold the gram
        around = (at[:, None] - np.arange(n - k + 1)).ravel()
        text = np.repeat(doc.text[at], n - k + 1)
        around = np.unique(around[(around >= doc.edge[text]) & (around + n <= doc.edge[text + 1])])
        around = around[_among(gram_hashes(doc.hashes, n)[around], items.hashes[n])]
        holders, same = items.holders[n], np.zeros(len(around), bool)
        for i, (key, text) in enumerate(zip(doc.windows(around, n), doc.text[around].tolist(), strict=True)):
            held = holders.get(key)
            if held is not None:
                same[i] = True
                seen[text][key] = held
        begin.append(around[same])
        end.append(around[same] + n)
    return np.concatenate(begin), np.concatenate(end), [{item for held in found.values() for item in held} for found in seen]


_RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<first:bigint,end:bigint>>"


def _judge(table: pa.Table, items: Items, carried: list[str]) -> pa.Table:
    raw, off = text_bytes(table.column("text"))
    n_words, n_hit, names, spans = [], [], [], []
    for lo, hi in blocks(off):
        doc = Texts(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        first, end, found = hits(doc, items)
        inside = covered(first, end, len(doc.hashes))
        running = np.zeros(len(inside) + 1, np.int64)
        np.cumsum(inside, out=running[1:])
        n_words.append(np.diff(doc.edge))
        n_hit.append(np.diff(running[doc.edge]))
        names += [sorted({items.ids[i] for i in own}) for own in found]
        own: list[list[dict]] = [[] for _ in range(hi - lo)]
        # runs of words that are hit, cut where texts end
        heads = np.zeros(len(inside) + 1, bool)
        heads[doc.edge] = True
        after = np.append(False, inside[:-1]) if len(inside) else inside
        starts = np.flatnonzero(inside & (heads[:-1] | ~after))
        before = np.append(inside[1:], False) if len(inside) else inside
        stops = np.flatnonzero(inside & (heads[1:] | ~before)) + 1
        text = doc.text[starts]
        for t, a, b in zip(text.tolist(), (starts - doc.edge[text]).tolist(), (stops - doc.edge[text]).tolist(), strict=True):
            own[t].append({"first": a, "end": b})
        spans += own
    out = {c: table.column(c) for c in carried}
    out["n_words"] = pa.array(np.concatenate([*n_words, _NONE]))
    out["n_hit"] = pa.array(np.concatenate([*n_hit, _NONE]))
    out["items"] = pa.array(names, pa.list_(pa.string()))
    out["spans"] = pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
    return pa.table(out)


def _with_sent(build: Callable[[], Items], carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = build()
        for batch in batches:
            yield from _judge(pa.Table.from_batches([batch]), items, carried).to_batches()

    return run


def _item_table(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, most_sent: int = MOST_SENT) -> DataFrame:
    """(doc_id, others, n_words, n_hit, items, spans); others holds the remaining columns of docs, text among them."""
    kept = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("_")).alias("others"),
    )
    carried = ["doc_id", "text", "others"]
    schema = StructType([*kept.schema, *StructType.fromDDL(_RESULT)])
    items = _item_table(benchmark)
    # a text of n bytes has at most n / 2 + 1 words
    bound = items.agg(F.sum(F.octet_length("text") / 2 + 1).alias("n")).first()["n"] or 0
    if bound <= most_sent:
        rows = items.distinct().toArrow()
        ids, texts = rows.column("item_id").to_pylist(), rows.column("text").to_pylist()
        sent = kept.sparkSession.sparkContext.broadcast((ids, texts))
        build = lambda: Items(sent.value[0], pa.array(sent.value[1], pa.string()), window, gram)
        return kept.mapInArrow(_with_sent(build, carried), schema)
    return _shuffled(kept, items, window, gram, carried, schema)


_PRINT = "print bigint, owner {}"


def _print_rows(lengths: list[int], window: int, gram: int, key: str):
    """Distinct fingerprints of a batch, for every gram length in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_bytes(batch.column("text"))
            for lo, hi in blocks(off):
                block = Texts(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                for n in lengths:
                    h, at = block.fingerprints(*_gram(n, window, gram))
                    if not len(h):
                        continue
                    pairs = np.unique(np.stack([h.view(np.int64) ^ np.int64(n), block.text[at]]), axis=1)
                    owner = batch.column(key).take(pa.array(pairs[1] + lo))
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), owner], names=["print", "owner"])

    return run


def _in_parts(kept: DataFrame) -> DataFrame:
    """kept with the part of each row; copies of one text under several ids go to several parts."""
    return kept.withColumn("part", dealt(parts(kept), "doc_id", "text"))


def _shuffled(kept: DataFrame, items: DataFrame, window: int, gram: int, carried: list[str], schema: StructType) -> DataFrame:
    """The way for more items than may be sent: parts of documents meet the items hit in them."""
    rows = _in_parts(kept)
    every = list(range(1, window + 1))
    of_docs = rows.mapInArrow(_print_rows(every, window, gram, "part"), _PRINT.format("int")).distinct()
    of_items = items.mapInArrow(_print_rows(every, window, gram, "item_id"), _PRINT.format("string")).distinct()
    met = of_docs.withColumnRenamed("owner", "part").join(of_items.withColumnRenamed("owner", "item_id"), "print").select("part", "item_id").distinct()
    needed = met.join(items.distinct(), "item_id").select("part", "item_id", F.col("text").alias("item_text"))

    def run(table: pa.Table, own: pa.Table) -> pa.Table:
        found = Items(own.column("item_id").to_pylist(), own.column("item_text"), window, gram)
        return _judge(table, found, carried)

    return rows.groupBy("part").cogroup(needed.groupBy("part")).applyInArrow(run, schema)
