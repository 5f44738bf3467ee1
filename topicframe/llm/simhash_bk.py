"""SimHash near duplicates with BK-trees.

A BK-tree keys a node's children by their integer Hamming distance to it; a search of radius r
follows only the edges within r of the query's own distance. One tree over all fingerprints would
be walked almost whole by every query, so fingerprints are sharded first: two that differ in at
most three bits agree in one of four 16-bit bands, and each band value is a shard with a tree of
its own, dealt to tasks beside its queries. A shard with more than ``most`` fingerprints is cut
again by four 12-bit bands of its remaining bits, by the same argument; one still larger is sent
to several tasks, each of which answers a part of the queries. No link is lost at any size.

Equal fingerprints collapse before anything is sharded. A task returns, for each shard, the links
of a spanning forest, not all pairs.

Defined results: a text without words (null, empty) has fingerprint zero, linked like any other;
repeated rows fall together; a null doc_id is carried but never the id of a component with another
id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import hold
from .components import roots
from .sizes import LEAST_PARTS, dealt

RADIUS = 3
SHINGLE = 3
SEED = 42
#: fingerprints in one tree before its shard is cut again
MOST_IN_SHARD = 8192
#: fingerprints, counted once for each band, that one task gets
PART_ROWS = 100_000
_VISITS = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the lower-cased word shingles, repeats included."""
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    size = np.array([len(w) for w in words], np.int64) + 1
    joined = b" ".join(words)
    end = np.cumsum(size) - 1
    start = end - size + 1
    width = min(shingle, len(words))
    spans = zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist(), strict=True)
    h = np.array([hash64(joined[a:b], SEED) for a, b in spans], np.uint64)
    count = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[lo : lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.cast(batch.column(1), pa.binary())
        found = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit integer."""
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints of one word each, or of a row of words each."""
    bits = np.bitwise_count(a ^ b)
    return bits.astype(np.int64) if bits.ndim == 1 else bits.sum(axis=1, dtype=np.int64)


class Forest:
    """BK-trees over fingerprints, one for each shard; shards need not be sorted."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        self.most = 64 * (fp.shape[1] if fp.ndim == 2 else 1)
        _, first, which = np.unique(shard, return_index=True, return_inverse=True)
        self.root = first[which]
        rest = np.flatnonzero(self.root != np.arange(len(fp)))
        at = self.root[rest]
        keys, nodes = [], []
        while len(rest):
            key = at * (self.most + 1) + _apart(fp[rest], fp[at])
            own, lead, which = np.unique(key, return_index=True, return_inverse=True)
            keys.append(own)
            nodes.append(rest[lead])
            at = rest[lead][which]
            left = np.ones(len(rest), bool)
            left[lead] = False
            rest, at = rest[left], at[left]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.node = (np.concatenate(nodes) if nodes else np.zeros(0, np.int64))[order]

    def search(self, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, other) within radius of each other."""
        waiting = [(queries, self.root[queries])]
        while waiting:
            query, node = waiting.pop()
            if len(query) > _VISITS:
                half = len(query) // 2
                waiting += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = _apart(self.fp[query], self.fp[node])
            hit = (d <= radius) & (node != query)
            if hit.any():
                yield query[hit], node[hit]
            lo = np.searchsorted(self.key, node * (self.most + 1) + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.key, node * (self.most + 1) + np.minimum(d + radius, self.most), "right")
            n = hi - lo
            if n.any():
                run = np.cumsum(n)
                waiting.append((np.repeat(query, n), self.node[np.repeat(lo - run + n, n) + np.arange(run[-1])]))


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = up


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n vertices the least vertex joined to it by the pairs."""
    parent = np.arange(n)
    for a, b in pairs:
        while True:
            a, b = _find(parent, a), _find(parent, b)
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return _find(parent, parent)


def _links(table: pa.Table) -> pa.Table:
    shard = table.column("shard").to_numpy()
    fp = table.column("fp").to_numpy().view(np.uint64)
    asks = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
    least = spanning(len(fp), Forest(shard, fp).search(asks))
    joined = np.flatnonzero(least != np.arange(len(fp)))
    signed = fp.view(np.int64)
    return pa.table({"u": signed[joined], "v": signed[least[joined]]})


def _first_cut(distinct: DataFrame) -> DataFrame:
    """(fp, band, shard): shard is unique for a 16-bit band and its value."""
    band = F.explode(F.array(*(F.lit(i) for i in range(4)))).alias("band")
    value = F.expr("shiftrightunsigned(fp, 16 * band) & 65535L")
    return distinct.select("fp", band).withColumn("shard", F.col("band") * 65536 + value)


def _second_cut(rows: DataFrame) -> DataFrame:
    """(fp, band, shard) cut again by four 12-bit bands of the 48 bits beside the first band."""
    rest = F.expr(
        "(case when band = 0 then 0L else fp & (shiftleft(1L, 16 * band) - 1L) end)"
        " | (case when band = 3 then 0L else shiftleft(shiftrightunsigned(fp, 16 * (band + 1)), 16 * band) end)"
    )
    inner = F.explode(F.array(*(F.lit(i) for i in range(4)))).alias("inner")
    value = F.expr("shiftrightunsigned(rest, 12 * inner) & 4095L")
    cut = rows.withColumn("rest", rest).select("fp", "band", "shard", "rest", inner).withColumn("value", value)
    return cut.select("fp", "band", (F.lit(1 << 40) + (F.col("shard") * 4 + F.col("inner")) * 4096 + F.col("value")).alias("shard"))


def _search(rows: DataFrame, number: int) -> DataFrame:
    return (
        rows.select("shard", "fp", "asks", dealt(number, "shard", "turn").alias("part"), "turn")
        .select("part", F.when(F.col("turn") == 0, F.col("shard")).otherwise(F.xxhash64("shard", "turn")).alias("shard"), "fp", "asks")
        .groupBy("part")
        .applyInArrow(_links, "u bigint, v bigint")
    )


def _all_ask(rows: DataFrame) -> DataFrame:
    return rows.select("shard", "fp", F.lit(True).alias("asks"), F.lit(0).alias("turn"))


def links(distinct: DataFrame, most: int = MOST_IN_SHARD) -> DataFrame:
    """(u, v): enough links within the radius to join all fingerprints that links reach."""
    number = max(LEAST_PARTS, -(-4 * distinct.count() // PART_ROWS))
    rows = _first_cut(distinct)
    found = []
    for cut in (_second_cut, None):
        large = hold(rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most), "large-shards")
        if large.isEmpty():
            return _union([*found, _search(_all_ask(rows), number)])
        found.append(_search(_all_ask(rows.join(large, "shard", "left_anti")), number))
        if cut:
            rows = cut(rows.join(large, "shard", "left_semi"))
        else:
            found.append(_search(_in_turns(rows.join(large, "shard"), most), number))
    return _union(found)


def _in_turns(rows: DataFrame, most: int) -> DataFrame:
    """A shard's tree goes to several tasks; each fingerprint asks in one of them."""
    turns = F.ceil(F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("fp"), turns).cast("int") + 1
    every = rows.select("shard", "fp", own.alias("own"), F.explode(F.sequence(F.lit(1), turns)).alias("turn"))
    return every.select("shard", "fp", (F.col("own") == F.col("turn")).alias("asks"), "turn")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def near_duplicates(docs: DataFrame, most: int = MOST_IN_SHARD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = hold(fingerprints(docs), "fingerprints")
    distinct = hold(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    joined = roots(links(distinct.select("fp"), most))
    placed = hold(
        distinct.join(joined.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = hold(placed.join(least, "root").select("fp", "component_id"), "labels")
    return prints.join(labels, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")
