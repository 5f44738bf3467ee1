"""Toxicity by noisy-channel deobfuscation.

Hidden words are restored first: every suspicious span (digits or signs inside a word, letters
spaced or dotted apart, a letter three times or more) becomes a lattice of what each character may
stand for, and a Viterbi search picks the reading that the channel and a character language model
find likeliest. The language model is a trigram model counted over the words of all documents;
what is gathered grows with the corpus up to the cube of the alphabet.

Then the text with the restored words is scored. Signs of toxicity are words and word beginnings,
weighed by their log odds in at most ``MOST_DOCUMENTS`` labelled documents outside the held-out
fold (equal texts count once); a small logistic model over a document's strongest signs gives the
score. In that fit each document's own count is taken out of the odds it meets.

Defined results: null and empty texts have no signs and get the score of that; without labels of
both kinds the score is the share of ones, or zero; rows with equal doc_id are scored each for
itself; an empty table gives no rows; all other columns are carried and never looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workspace import hold
from .labelled import remainder, sample
from .textbytes import blocks, byte_table, span_hashes, text_bytes, words

FOLDS, HELD_OUT = 4, 2
MOST_DOCUMENTS = 12_000
#: signs kept, by log odds; fewer if fewer have MIN_POSITIVE documents
MOST_SIGNS = 8192
MIN_POSITIVE = 4
PRIOR = 4.0
THRESHOLD = 0.3
#: bytes of a word that make its beginnings
BEGINNINGS = (3, 4, 5, 6, 8)
ALPHABET = 64
_LETTERS = byte_table([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_U = np.uint64

# ---------------------------------------------------------------- language model


def _letter_ids() -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a-z, 27 to 63 shared by all other letters."""
    ids = np.zeros(0x3000, np.int64)
    for code in range(0x3000):
        if chr(code).isalpha():
            ids[code] = code - 0x60 if 0x61 <= code <= 0x7A else 27 + code % (ALPHABET - 27)
    return ids


_IDS = _letter_ids()


def _id(char: str) -> int:
    code = ord(char)
    return int(_IDS[code]) if code < len(_IDS) else 27 + code % (ALPHABET - 27)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(ALPHABET**3, np.int64)
    for batch in batches:
        texts, lo, size = [], 0, 0
        column = pc.fill_null(pc.utf8_lower(batch.column(0)), "").to_pylist()
        for i, text in enumerate(column):
            texts.append(text)
            size += len(text)
            if size >= 1 << 18 or i + 1 == len(column):
                code = np.frombuffer((" ".join(texts) + "  ").encode("utf-32-le", "replace"), np.uint32)
                ids = np.where(code < len(_IDS), _IDS[np.minimum(code, len(_IDS) - 1)], 27 + code % (ALPHABET - 27))
                three = (ids[:-2] * ALPHABET + ids[1:-1]) * ALPHABET + ids[2:]
                counts += np.bincount(three[(ids[1:-1] > 0) | (ids[2:] > 0)], minlength=len(counts))
                texts, size = [], 0
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["code", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over the alphabet, from the words of all documents."""
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_trigrams, "code int, n bigint")
    rows = counted.groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # at most ALPHABET ** 3 rows
    n = np.zeros(ALPHABET**3)
    n[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    n = n.reshape(ALPHABET, ALPHABET, ALPHABET)
    one = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * ALPHABET)
    two = (n.sum(0) + 8 * one) / (n.sum((0, 2))[:, None] + 8)
    return np.log((n + 4 * two[None]) / (n.sum(2)[:, :, None] + 4)).astype(np.float32)


# ---------------------------------------------------------------- restoring

#: fixed values: what a sign is written for
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
_SIGNS = re.escape("".join(LEET))
_TRIGGER = re.compile(rf"[{_SIGNS}]+[^\W\d_]|([^\W\d_])\1\1")
_SPACED = re.compile(rf"(?<![\w{_SIGNS}])(?:[a-z{_SIGNS}][ .\-_*]){{2,}}[a-z{_SIGNS}](?![\w{_SIGNS}])")
_MEMBER = re.compile(rf"(?:[^\W_]|[{_SIGNS}])+")
#: a longer span is read in pieces of so many characters
MOST_SPAN = 48
_SWAP, _DROP_REPEAT, _DROP_SIGN, _KEEP_REPEAT = math.log(0.4), math.log(0.5), math.log(0.05), math.log(0.5)


def restore(span: str, model: np.ndarray) -> str:
    """The likeliest word for a span, letters only."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for at, char in enumerate(span):
        arcs = [(c, _SWAP) for c in LEET.get(char, "")]
        again = at > 0 and span[at - 1] == char
        if char.isalpha():
            arcs.append((char, _KEEP_REPEAT if again else 0.0))
        drop = None if char.isalpha() and not again else _DROP_REPEAT if again else 0.0 if not arcs else _DROP_SIGN
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in states.items():
            for c, cost in arcs:
                k = _id(c)
                new = score + cost + float(model[a, b, k])
                if new > after.get((b, k), (-math.inf, ""))[0]:
                    after[(b, k)] = (new, text + c)
            if drop is not None and score + drop > after.get((a, b), (-math.inf, ""))[0]:
                after[(a, b)] = (score + drop, text)
        states = after
    return max(((s + float(model[a, b, 0]), t) for (a, b), (s, t) in states.items()), default=(0, ""))[1]


def suspicious(text: str) -> list[str]:
    """Spans of lower-case text that may hide a word."""
    found, seen = [], -1
    for hit in _TRIGGER.finditer(text):
        if hit.start() < seen:
            continue
        lo = hit.start()
        while lo > 0 and _MEMBER.fullmatch(text[lo - 1]):
            lo -= 1
        whole = _MEMBER.match(text, lo)
        seen = whole.end()
        found.append(whole[0])
    found += [m[0] for m in _SPACED.finditer(text)]
    return [s[i : i + MOST_SPAN] for s in found for i in range(0, len(s), MOST_SPAN)]


class Restorer:
    def __init__(self, model: np.ndarray):
        self.known = lru_cache(maxsize=200_000)(lambda span: restore(span, model))

    def column(self, column: pa.Array) -> pa.Array:
        """Lower-case texts with the restored words behind them."""
        texts = pc.fill_null(pc.utf8_lower(column), "").to_pylist()
        return pa.array([" ".join([t, *map(self.known, s)]) if (s := suspicious(t)) else t for t in texts], pa.large_string())


# ---------------------------------------------------------------- signs


def signs(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text number) of every word, then of every word's beginnings of each length."""
    start, end, edge = words(raw, off, _LETTERS)
    if not len(start):
        return
    text = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    yield span_hashes(raw, start, end), text
    for size in BEGINNINGS:
        long = np.flatnonzero(end - start > size)
        yield span_hashes(raw, start[long], start[long] + size) ^ _U(0x9E3779B97F4A7C15), text[long]


def _distinct(raw: np.ndarray, off: np.ndarray, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, text) of a block, only hashes among a sorted array if one is given."""
    hashes, texts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for h, text in signs(raw, off):
        if among is not None:
            keep = _find(among, h)[1]
            h, text = h[keep], text[keep]
        hashes.append(h)
        texts.append(text)
    h, text = np.concatenate(hashes), np.concatenate(texts)
    order = np.lexsort((text, h))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def _find(among: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in among, places of h that are in it); a bitmap of high bits spares most searches."""
    bits = np.zeros(1 << 20, bool)
    bits[(among >> _U(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(h >> _U(44)).astype(np.int64)])
    place = np.searchsorted(among, h[maybe])
    real = place < len(among)
    real[real] = among[place[real]] == h[maybe][real]
    return place[real], maybe[real]


def _texts(column: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(restorer.column(column))


def _counts(sent, positives_only: bool):
    """(sign, pos, neg): in how many positive texts, or among given signs in how many of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, among = sent.value
        restorer = Restorer(model)
        for batch in batches:
            label = batch.column("label").to_numpy()
            if positives_only:
                batch = batch.filter(pa.array(label == 1))
                label = label[label == 1]
            raw, off = _texts(batch.column("text"), restorer)
            for lo, hi in blocks(off):
                h, text = _distinct(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], None if positives_only else among)
                if not len(h):
                    continue
                name, which = np.unique(h, return_inverse=True)
                pos = np.bincount(which, label[lo:hi][text] == 1, minlength=len(name)).astype(np.int64)
                neg = np.bincount(which, minlength=len(name)) - pos
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(pos), pa.array(neg)], names=["sign", "pos", "neg"])

    return run


class Model(NamedTuple):
    language: np.ndarray
    sign: np.ndarray  # sorted
    pos: np.ndarray
    neg: np.ndarray
    total: tuple[int, int]  # positive and other documents of the sample
    weight: np.ndarray
    base: float  # the share of ones, if nothing was learned

    def odds(self, label: int | None = None) -> np.ndarray:
        """Log odds of each sign against the sample's own; label: as if a document of it were not counted."""
        pos = self.pos - (label == 1)
        neg = self.neg - (label == 0)
        share = self.total[0] / sum(self.total)
        return np.log((pos + PRIOR * share) / (neg + PRIOR * (1 - share))) - math.log(share / (1 - share))


N_STRENGTHS = 4


def strengths(raw: np.ndarray, off: np.ndarray, sign: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """For each text: its strongest sign, the next strongest of another word or beginning, the number
    of strong signs, and those for each hundred words."""
    n = len(off) - 1
    out = np.zeros((n, N_STRENGTHS))
    h, text = _distinct(raw, off, sign)
    if len(h):
        value = odds[np.searchsorted(sign, h)]
        order = np.lexsort((-value, text))
        value, text = value[order], text[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        for k in range(2):
            top = rank == 3 * k
            out[text[top], k] = np.maximum(value[top], 0)
        strong = np.bincount(text, value > 1.5, minlength=n)
        out[:, 2] = np.log1p(strong)
        out[:, 3] = strong / (1 + np.diff(off) / 600)
    return out


def _strength_rows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        restorer, odds = Restorer(model.language), [model.odds(0), model.odds(1)]
        for batch in batches:
            raw, off = _texts(batch.column("text"), restorer)
            label = batch.column("label").to_numpy()
            for lo, hi in blocks(off):
                block = raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                both = [strengths(*block, model.sign, o) for o in odds]
                x = np.where((label[lo:hi] == 1)[:, None], both[1], both[0])
                yield pa.RecordBatch.from_arrays([pa.array(label[lo:hi].astype(np.int32)), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([0.01] * (x.shape[1] - 1) + [1e-6]) * 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), gradient)
    return w


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS) -> Model:
    spark = docs.sparkSession
    language = language_model(docs)
    chosen = sample(docs, labels, "toxic", FOLDS, HELD_OUT, most).select("text", "label").dropDuplicates(["text", "label"])
    chosen = hold(chosen, "labelled-sample")
    kinds = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = kinds.get(1, 0), kinds.get(0, 0)
    none = np.zeros(0, _U)
    empty = Model(language, none, np.zeros(0), np.zeros(0), (pos, neg), np.zeros(N_STRENGTHS + 1), pos / (pos + neg) if pos + neg else 0.0)
    if not pos or not neg:
        return empty
    schema = "sign bigint, pos bigint, neg bigint"
    add = lambda rows: rows.groupBy("sign").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sent = spark.sparkContext.broadcast((language, none))
    seen = add(chosen.mapInArrow(_counts(sent, True), schema)).where(F.col("pos") >= MIN_POSITIVE)
    among = np.sort(seen.select("sign").toArrow().column("sign").to_numpy().view(_U))  # bounded by the sample
    sent = spark.sparkContext.broadcast((language, among))
    rows = add(chosen.mapInArrow(_counts(sent, False), schema)).toArrow()
    sign = rows.column("sign").to_numpy().view(_U)
    order = np.argsort(sign)
    counts = [rows.column(c).to_numpy().astype(float)[order] for c in ("pos", "neg")]
    model = empty._replace(sign=sign[order], pos=counts[0], neg=counts[1])
    best = np.sort(np.lexsort((model.sign, -model.odds()))[:MOST_SIGNS])
    model = model._replace(sign=model.sign[best], pos=model.pos[best], neg=model.neg[best])
    sent = spark.sparkContext.broadcast(model)
    found = chosen.mapInArrow(_strength_rows(sent), "label int, x array<double>").toArrow()
    y = found.column("label").to_numpy().astype(float)
    x = np.array(found.column("x").to_pylist()).reshape(len(y), N_STRENGTHS)
    return model._replace(weight=_logistic(x, y))


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        learned = len(model.sign) > 0
        restorer, odds = Restorer(model.language), model.odds() if learned else None
        for batch in batches:
            raw, off = _texts(batch.column("text"), restorer) if learned else (None, np.zeros(batch.num_rows + 1))
            scores = [np.zeros(0)]
            for lo, hi in blocks(off) if learned else ():
                x = strengths(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], model.sign, odds)
                scores.append(1 / (1 + np.exp(-np.clip(x @ model.weight[:-1] + model.weight[-1], -30, 30))))
            score = np.concatenate(scores) if learned else np.full(batch.num_rows, model.base)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("others"), pa.array(score)], names=["doc_id", "others", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, others, held_out, score, predicted); others holds the remaining columns of docs."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("_"))
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), others.alias("others"))
    schema = StructType([kept.schema["doc_id"], kept.schema["others"]]).add("score", "double")
    rows = kept.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), schema)
    held_out = F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", "others", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
