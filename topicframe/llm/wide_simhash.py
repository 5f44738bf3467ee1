"""SimHash near duplicates at a Jaccard similarity of 0.8 of five-word shingles, with BK-trees.

Texts that share 0.8 of their distinct shingles differ in about 15 % of the bits of a SimHash:
ten of 64, so three bits would miss them, and no few bands of 64 would be sure to agree. A sketch
here is nine SimHashes of 64 bits. Each of its 36 bands of 16 bits is a shard; a pair at 0.8 agrees
in at least one of them 93 times in 100, at 0.85 98 times. A shard's BK-tree holds 256 bits of the
sketch beside the band's own, where a pair at 0.8 differs in 39 bits on average and in at most
``RADIUS`` 95 times in 100.

So two texts link if they agree in a band and differ in at most ``RADIUS`` of the 256 bits that
belong to it. The rule estimates the similarity; there is no second pass over the texts.

Equal sketches collapse before anything is sharded. A task returns the
links of a spanning forest of a shard, not all pairs. A shard with more than ``most`` sketches goes
to several tasks, each of which answers a part of the queries, so no link is lost at any size.

Defined results: a text of fewer than five words is one shingle; a text without words (null, empty)
has a sketch of zeros, linked like any other; repeated rows fall together; a null doc_id is carried but never the id of a component
with another id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import hold
from .components import roots
from .simhash_bk import MOST_IN_SHARD, PART_ROWS, SEED, Forest, spanning
from .sizes import LEAST_PARTS, dealt
from .textbytes import mix

SHINGLE = 5
WORDS = 9
BANDS = 4 * WORDS
#: words of the sketch in a shard's tree, those that follow the band's own
TREE = 4
RADIUS = 48
_STEP = np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_SKETCH = [f"w{i}" for i in range(WORDS)]
_TREE = [f"t{i}" for i in range(TREE)]


def sketch(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Nine unsigned 64-bit SimHashes of the distinct shingles of the lower-cased words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(WORDS, np.uint64)
    joined = b" ".join(words)
    size = np.array([len(w) for w in words], np.int64) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    width = min(shingle, len(words))
    spans = zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist(), strict=True)
    h = np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64))
    count = np.zeros(64 * WORDS, np.int64)
    for lo in range(0, len(h), 1 << 12):
        each = mix(h[lo : lo + (1 << 12), None] + _STEP)
        count += np.unpackbits(each.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(count * 2 > len(h), bitorder="little").view(np.uint64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sketch(t.as_py() or b"") for t in pc.cast(batch.column(1), pa.binary())]
        words = np.array(found, np.uint64).reshape(-1, WORDS).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(words[:, i]) for i in range(WORDS))], names=["doc_id", *_SKETCH])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, w0 .. w8), the words as signed integers."""
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(_sketches, "doc_id bigint, " + ", ".join(f"{w} bigint" for w in _SKETCH))


def _shards(distinct: DataFrame) -> DataFrame:
    """(vertex, shard, t0 .. t3): a row for each band of a sketch."""

    def one(band: int):
        word, slot = divmod(band, 4)
        value = F.shiftrightunsigned(_SKETCH[word], 16 * slot).bitwiseAND(65535)
        tree = [F.col(_SKETCH[(word + 1 + i) % WORDS]).alias(_TREE[i]) for i in range(TREE)]
        return F.struct((F.lit(band * 65536) + value).alias("shard"), *tree)

    return distinct.select("vertex", F.inline(F.array(*(one(band) for band in range(BANDS)))))


def _links(table: pa.Table) -> pa.Table:
    shard, vertex = table.column("shard").to_numpy(), table.column("vertex").to_numpy()
    asks = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
    bits = np.stack([table.column(t).to_numpy() for t in _TREE], axis=1).view(np.uint64)
    least = spanning(len(vertex), Forest(shard, bits).search(asks, RADIUS))
    joined = np.flatnonzero(least != np.arange(len(vertex)))
    return pa.table({"u": vertex[joined], "v": vertex[least[joined]]})


def _search(rows: DataFrame, number: int) -> DataFrame:
    parted = rows.withColumn("part", dealt(number, "shard", "turn"))
    own = F.when(F.col("turn") == 0, F.col("shard")).otherwise(F.xxhash64("shard", "turn"))
    return parted.select("part", own.alias("shard"), "vertex", "asks", *_TREE).groupBy("part").applyInArrow(_links, "u bigint, v bigint")


def links(distinct: DataFrame, most: int = MOST_IN_SHARD) -> DataFrame:
    """(u, v): enough links to join all vertices that links reach, of rows (vertex, w0 .. w8)."""
    number = max(LEAST_PARTS, -(-BANDS * distinct.count() // PART_ROWS))
    rows = _shards(distinct)
    large = hold(rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most), "large-shards")
    if large.isEmpty():
        return _search(rows.withColumns({"asks": F.lit(True), "turn": F.lit(0)}), number)
    small = rows.join(large, "shard", "left_anti").withColumns({"asks": F.lit(True), "turn": F.lit(0)})
    turns = F.ceil(F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("vertex"), turns).cast("int") + 1
    every = rows.join(large, "shard").select("*", own.alias("own"), F.explode(F.sequence(F.lit(1), turns)).alias("turn"))
    hot = every.withColumn("asks", F.col("own") == F.col("turn"))
    return _search(small.unionByName(hot.select(small.columns)), number)


def near_duplicates(docs: DataFrame, most: int = MOST_IN_SHARD) -> DataFrame:
    """(doc_id, component_id) of every row."""
    prints = hold(sketches(docs), "sketches")
    collapsed = prints.groupBy(*_SKETCH).agg(F.min("doc_id").alias("least"))
    distinct = hold(collapsed.withColumn("vertex", F.monotonically_increasing_id()), "distinct-sketches")
    joined = roots(links(distinct.select("vertex", *_SKETCH), most))
    met = distinct.join(joined.withColumnRenamed("u", "vertex"), "vertex", "left")
    placed = hold(met.select(*_SKETCH, "least", F.coalesce("root", "vertex").alias("root")), "rooted")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = hold(placed.join(least, "root").select(*_SKETCH, "component_id"), "labels")
    return prints.join(labels, _SKETCH).select("doc_id", "component_id")
