"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded by what can be
counted in it (shares of character classes, word lengths, repeats) and a learned tanh layer; gated
attention gives each passage a weight from the same encoding, and the document's score is a
logistic function of the weighted mean. Only documents carry labels; the weights of passages are
learned from them.

The classifier is fitted on at most ``MOST_DOCUMENTS`` labelled documents outside the held-out fold,
of whole length. Passages are counted where the texts are; if the sample has more than
``MOST_PASSAGES``, documents are taken by the hash of the id as long as they fit, and one that does
not fit is passed over alone: whole documents are left out of the fit, never parts of one. A row
repeated with its text is fitted once. Scoring reads every passage of every text.

Defined results: a null or empty text is one passage of nothing and gets its score; without labels
of both kinds the score is the share of ones, or one half; rows with equal doc_id are scored each
for itself; an empty table gives no rows; all other columns are carried and never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .labelled import remainder, sample
from .textbytes import SPACED, blocks, gram_hashes, span_hashes, text_bytes, words

PASSAGE = 64
FOLDS, HELD_OUT = 5, 0
MOST_DOCUMENTS = 4000
MOST_PASSAGES = 60_000
HIDDEN, ATTENTION = 24, 12
STEPS = 150
THRESHOLD = 0.3
#: classes of bytes; those not named are lower-case ASCII letters and control bytes
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",;:", b"!?", b"#*$%&", b"|", b"<>{}[]()/\\=_+~^`@", b"\"'-", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
_WIDTH = len(_CLASSES) + 1
_TABLE = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES):
    _TABLE[list(_c)] = _i + 1
N_FEATURES = _WIDTH + 7


def _seen_before(key: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier in the array."""
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), bool)
    out[order[1:]] = key[order][1:] == key[order][:-1]
    return out


def passages(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, first passage of each text and the end); a text has one at least."""
    start, end, edge = words(raw, off, SPACED)
    count = np.diff(edge)
    number = np.maximum(1, -(-count // PASSAGE))
    first = np.zeros(len(number) + 1, np.int64)
    np.cumsum(number, out=first[1:])
    total = int(first[-1])
    text = np.repeat(np.arange(len(number)), count)
    of_word = first[text] + (np.arange(len(start)) - edge[text]) // PASSAGE
    # a passage reaches to the next one's first word; the text's first passage from its first byte
    inner = np.arange(total) - np.repeat(first[:-1], number)
    owner = np.repeat(np.arange(len(number)), number)
    head = np.where(inner == 0, off[owner], 0)
    later = np.flatnonzero(inner)
    head[later] = start[edge[owner[later]] + inner[later] * PASSAGE]
    tail = np.append(head[1:], off[-1]) if total else head
    kinds = np.bincount(np.repeat(np.arange(total), tail - head) * _WIDTH + _TABLE[raw], minlength=total * _WIDTH).reshape(total, _WIDTH)
    size = np.maximum(tail - head, 1)
    n = np.bincount(of_word, minlength=total).astype(float)
    words_or_one = np.maximum(n, 1)
    out = np.zeros((total, N_FEATURES))
    out[:, :_WIDTH] = np.sqrt(kinds / size[:, None])
    out[:, _WIDTH] = np.log1p(n) / np.log1p(PASSAGE)
    if len(start):
        h = span_hashes(raw, start, end)
        share = lambda mask: np.bincount(of_word, mask, minlength=total) / words_or_one
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        by_text = h ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        threes = gram_hashes(by_text, 3)
        again = np.zeros(len(h), bool)
        again[: len(threes)] = _seen_before(threes)
        length = end - start
        odd = _TABLE[raw[end - 1]]
        out[:, _WIDTH + 1] = np.bincount(of_word, length, minlength=total) / words_or_one / 10
        out[:, _WIDTH + 2] = share(same)
        out[:, _WIDTH + 3] = share(again)
        out[:, _WIDTH + 4] = share(_seen_before(h ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
        out[:, _WIDTH + 5] = share(length > 20)
        out[:, _WIDTH + 6] = share((odd == 7) | (odd == 8))
    return out, first


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray  # features and 1 to hidden
    value: np.ndarray  # hidden to attention
    gate: np.ndarray
    weight: np.ndarray  # attention to 1
    out: np.ndarray  # hidden and 1 to 1

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _forward(self[2:], _scaled(x, self.mean, self.scale), first)[-1]

    def attention(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The weight of every passage; those of a document add to 1."""
        return _forward(self[2:], _scaled(x, self.mean, self.scale), first)[3]


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack([np.clip((x - mean) / scale, -6, 6), np.ones(len(x))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(p, x: np.ndarray, first: np.ndarray):
    encode, value, gate, weight, out = p
    h = np.tanh(x @ encode)
    t, s = np.tanh(h @ value), _sigmoid(h @ gate)
    e = np.exp(np.clip((t * s) @ weight, -30, 30))
    size = np.diff(first)
    a = e / np.repeat(np.add.reduceat(e, first[:-1]), size)
    z = np.add.reduceat(a[:, None] * h, first[:-1])
    return h, t, s, a, z, _sigmoid(z @ out[:-1] + out[-1])


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS, seed: int = 7) -> Model:
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = _scaled(x, mean, scale)
    rng = np.random.default_rng(seed)
    shapes = [(x.shape[1], HIDDEN), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN + 1,)]
    p = [rng.normal(0, 0.3 / np.sqrt(s[0]) * 2, s) for s in shapes]
    m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    size, n = np.diff(first), len(label)
    for step in range(1, steps + 1):
        h, t, s, a, z, y = _forward(p, x, first)
        d = (y - label) / n
        g_out = np.append(z.T @ d, d.sum())
        dz = np.repeat(d[:, None] * p[4][:-1], size, axis=0)
        dh = a[:, None] * dz
        da = (h * dz).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first[:-1]), size))
        g_weight = (t * s).T @ de
        ds = de[:, None] * p[3]
        dt, dg = ds * s * (1 - t * t), ds * t * s * (1 - s)
        g_value, g_gate = h.T @ dt, h.T @ dg
        dh += dt @ p[1].T + dg @ p[2].T
        grads = [x.T @ (dh * (1 - h * h)), g_value, g_gate, g_weight, g_out]
        for i, g in enumerate(grads):
            g = g + 1e-5 * p[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
    return Model(mean, scale, *p)


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of passages of every text."""
    for batch in batches:
        raw, off = text_bytes(batch.column("text"))
        found = [np.zeros(0, np.int64)]
        for lo, hi in blocks(off):
            edge = words(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], SPACED)[2]
            found.append(np.maximum(1, -(-np.diff(edge) // PASSAGE)))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "doc_id", "tie")), pa.array(np.concatenate(found))], names=["label", "doc_id", "tie", "n"])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = text_bytes(batch.column("text"))
        for lo, hi in blocks(off):
            x, first = passages(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c)[lo:hi] for c in ("label", "doc_id", "tie")), pa.array(rows, pa.binary())], names=["label", "doc_id", "tie", "bag"])


def fitting(sizes: list[int], most: int) -> np.ndarray:
    """Which of the sizes, in their order, are taken: each that still fits beside those before it."""
    out, used = np.zeros(len(sizes), bool), 0
    for i, n in enumerate(sizes):
        if used + n <= most:
            out[i], used = True, used + n
    return out


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS) -> Model | float:
    """A model, or the share of ones if the sample has one kind of label only."""
    chosen = sample(docs, labels, "quality", FOLDS, HELD_OUT, most).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    chosen = chosen.withColumn("tie", F.xxhash64("text"))
    numbers = chosen.mapInArrow(_numbers, "label int, doc_id bigint, tie bigint, n bigint").dropDuplicates(["doc_id", "tie"])
    numbers = numbers.withColumn("place", F.xxhash64("doc_id")).toArrow().sort_by([(c, "ascending") for c in ("place", "doc_id", "tie")])
    label = numbers.column("label").to_numpy().astype(float)
    if not len(label) or label.min() == label.max():
        return float(label.mean()) if len(label) else 0.5
    room = fitting(numbers.column("n").to_pylist(), MOST_PASSAGES)
    if not room.any() or label[room].min() == label[room].max():
        return float(label.mean())
    kept = pa.table({c: numbers.column(c) for c in ("doc_id", "tie")}).filter(pa.array(room))
    taken = docs.sparkSession.createDataFrame(kept)
    bags = chosen.join(F.broadcast(taken), ["doc_id", "tie"]).mapInArrow(_bags, "label int, doc_id bigint, tie bigint, bag binary")
    rows = bags.dropDuplicates(["doc_id", "tie"]).toArrow().sort_by([("doc_id", "ascending"), ("tie", "ascending")])
    kept = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows.column("bag").to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(b) for b in kept])])
    return fit(np.concatenate(kept).astype(float), first, rows.column("label").to_numpy().astype(float))


def _score(model: Model | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_bytes(batch.column("text"))
            found = []
            for lo, hi in blocks(off):
                if isinstance(model, float):
                    found.append(np.full(hi - lo, model))
                    continue
                x, first = passages(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                found.append(model.scores(x, first))
            score = pa.array(np.concatenate([*found, np.zeros(0)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("others"), score], names=["doc_id", "text", "others", "score"])

    return run


def scored(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, text, others, held_out, score, predicted); others holds the remaining columns of docs."""
    kept = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("_")).alias("others"),
    )
    schema = StructType([*kept.schema]).add("score", "double")
    rows = kept.mapInArrow(_score(model), schema)
    held_out = F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return rows.select("doc_id", "text", "others", held_out.alias("held_out"), "score", predicted.alias("predicted"))
