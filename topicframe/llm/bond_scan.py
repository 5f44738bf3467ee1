"""Hard negatives by a vertical scan with branch and bound.

Vectors are turned on their side: a block holds up to ``BLOCK`` of them as one column a dimension,
with each column's least and greatest value, and is written once. An anchor reads a block's columns
in the order of its own components, largest magnitude first. After every few columns a row has a
partial score, and the columns not yet read can add no more than the sum of their greatest possible
contributions and no less than that of their least. Rows that can no longer reach the anchor's window
leave the candidate bitmap, so most columns are read for few rows. The bounds tighten: k rows whose
bounds lie inside a window raise its lower end to the k-th of their least scores. What is left at the
last column has its exact score.

The first scan asks for the best rows of the anchor's label (its positives), the second for rows of
other labels in the window below each positive. Anchors are a stated query set: they are sent to the
tasks in packs of bounded bytes, and each pack is one job over all blocks. A task keeps the best k a
window over all its blocks and returns those alone; their merge is a window function with a limit.
All scores are exact integers, in whatever number type holds the block's largest possible score.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no
part; vectors of another dimension than the anchor's are not compared with it; a vector without
components scores 0; a score or component beyond a long counts as the nearest long; repeated rows are
candidates each for itself, an anchor given twice is one anchor, and no row is a positive of its own
vec_id; ties go to the smaller vec_id; an anchor alone in its label gives no rows; an empty table gives
none; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import fresh_path, hold

#: rows of a block, fewer for vectors of over 1024 components
BLOCK = 8192
BLOCK_CELLS = 1 << 23
#: rows a task gathers before it closes blocks, whatever their dimensions
GATHERED_CELLS = 1 << 24
#: columns read between two prunings
STEP = 8
#: bytes of anchors sent to the tasks at once
PACK_BYTES = 2 << 20
POSITIVES, NEGATIVES = 5, 5
#: a negative scores at least this share, in hundredths, of its positive
LEAST_SHARE = 80

_LONG = np.iinfo(np.int64)
_BLOCK_SCHEMA = "n int, vec_ids binary, labels binary, width int, columns array<binary>, lows array<bigint>, highs array<bigint>"
_BEST_SCHEMA = "anchor int, slot int, score bigint, vec_id bigint"


def whole_vectors(rows: DataFrame, scale: int, label: Column | None = None, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector): components x become floor(scale * x); rows with anything missing take no part."""
    finite = f"not exists({vector}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    kept = rows.where(f"vec_id is not null and label is not null and {vector} is not null and {finite}")
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    label = F.col("label") if label is None else label
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), scaled.alias("vector"))


def _block(ids: list, labels: list, rows: list) -> pa.RecordBatch:
    table = np.stack(rows, axis=1) if len(rows[0]) else np.empty((0, len(rows)), np.int64)
    lows, highs = (table.min(axis=1), table.max(axis=1)) if len(table) else (table[:, 0], table[:, 0])
    small = not len(table) or (lows.min() >= -(1 << 31) and highs.max() < 1 << 31)
    packed = table.astype(np.int32 if small else np.int64)
    one = [
        [len(ids)],
        [np.array(ids, np.int64).tobytes()],
        [np.array(labels, np.int64).tobytes()],
        [packed.itemsize],
        [[column.tobytes() for column in packed]],
        [lows.tolist()],
        [highs.tolist()],
    ]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [x.split()[0] for x in _BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(one, kinds, strict=True)], names=names)


def _stood_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gathered: dict[int, tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
    cells = 0
    for batch in batches:
        lists = batch.column("vector")
        flat, ends = np.asarray(lists.values), np.asarray(lists.offsets)
        for k, (vec_id, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
            vector = flat[ends[k] : ends[k + 1]]
            own = gathered[len(vector)]
            for part, value in zip(own, (vec_id, label, vector), strict=True):
                part.append(value)
            cells += len(vector) + 2
            if len(own[0]) >= min(BLOCK, max(1, BLOCK_CELLS // max(1, len(vector)))):
                cells -= len(own[0]) * (len(vector) + 2)
                yield _block(*gathered.pop(len(vector)))
        if cells >= GATHERED_CELLS:
            yield from (_block(*own) for own in gathered.values())
            gathered.clear()
            cells = 0
    yield from (_block(*own) for own in gathered.values())


def blocks(vectors: DataFrame) -> DataFrame:
    """The stored vertical blocks of (vec_id, label, vector)."""
    return hold(vectors.select("vec_id", "label", "vector").mapInArrow(_stood_up, _BLOCK_SCHEMA), "vertical-blocks")


def _kind(most: int) -> type:
    """A number type in which sums up to most are exact."""
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


class Block:
    """A block opened in a task; its columns as the number type that an anchor needs."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["vec_ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        kind = np.int32 if row["width"] == 4 else np.int64
        columns = [np.frombuffer(c, kind) for c in row["columns"]]
        self._whole = np.stack(columns) if columns else np.empty((0, row["n"]), kind)
        self.lows, self.highs = row["lows"], row["highs"]
        self._as: dict[type, np.ndarray] = {}

    def columns(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self._whole.astype(kind)
        return self._as[kind]


def resolve(block: Block, query: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, exact score) of the rows in alive that may be among the first k of a window (low, high), both inclusive."""
    q = [int(x) for x in query]
    most = sum(abs(x) * max(abs(lo), abs(hi)) for x, lo, hi in zip(q, block.lows, block.highs, strict=True))
    kind = _kind(most)
    columns = block.columns(kind)
    order = np.array(sorted(range(len(q)), key=lambda j: (-abs(q[j]), j)), np.int64)
    # what the columns from a place on can still add
    ends = [sorted((q[j] * block.lows[j], q[j] * block.highs[j])) for j in order]
    least, greatest = [0] * (len(q) + 1), [0] * (len(q) + 1)
    for place in reversed(range(len(q))):
        least[place], greatest[place] = least[place + 1] + ends[place][0], greatest[place + 1] + ends[place][1]
    # the ends of long stand for scores beyond them too
    low = [-most if lo == _LONG.min else lo for lo, _ in windows]
    high = [most if hi == _LONG.max else hi for _, hi in windows]
    weight = np.array(q, kind)
    rows, partial = alive, np.zeros(len(alive), kind)
    for at in range(0, len(q), STEP):
        if greatest[0] < min(low) or least[0] > max(high) or not len(rows):
            return rows[:0], partial[:0]
        read = order[at : at + STEP]
        partial = partial + weight[read] @ columns[read[:, None], rows]
        down, up = least[min(at + STEP, len(q))], greatest[min(at + STEP, len(q))]
        for w in range(len(windows)):
            sure = partial[partial <= high[w] - up] if high[w] < most else partial
            if len(sure) >= k:
                kth = sorted(sure)[-k] if kind is object else np.partition(sure, -k)[-k]
                reached = int(kth) + down
                # beyond a long all scores tie
                if reached > _LONG.min:
                    low[w] = max(low[w], min(reached, _LONG.max))
        stay = (partial >= min(low) - up) & (partial <= max(high) - down)
        if not stay.all():
            rows, partial = rows[stay], partial[stay]
    return rows, partial


class _Best:
    """The first k of each window of one anchor, over all blocks of a task."""

    def __init__(self, windows: list[tuple[int, int]], k: int):
        self.windows, self.k = windows, k
        self.scores = [np.empty(0, np.int64) for _ in windows]
        self.ids = [np.empty(0, np.int64) for _ in windows]

    def open_windows(self) -> list[tuple[int, int]]:
        return [(max(lo, int(s[-1])) if len(s) == self.k else lo, hi) for (lo, hi), s in zip(self.windows, self.scores, strict=True)]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (lo, hi) in enumerate(self.windows):
            inside = (scores >= lo) & (scores <= hi)
            s, i = np.concatenate([self.scores[w], scores[inside]]), np.concatenate([self.ids[w], ids[inside]])
            # -s would overflow at the least long
            first = np.lexsort((i, ~s))[: self.k]
            self.scores[w], self.ids[w] = s[first], i[first]


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(x), _LONG.min), _LONG.max) for x in scores], np.int64)
    return scores.astype(np.int64)


def _scan(pack: list[tuple[int, int, np.ndarray, list[tuple[int, int]]]], same_label: bool, k: int):
    """For (vec_id, label, vector, windows) of each anchor: the first k rows a window that a task's blocks hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(windows, k) for *_, windows in pack]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for found, (vec_id, label, vector, windows) in zip(best, pack, strict=True):
                    if len(vector) != len(block.lows) or not windows:
                        continue
                    bitmap = block.labels == label
                    bitmap = bitmap & (block.ids != vec_id) if same_label else ~bitmap
                    rows, scores = resolve(block, vector, np.flatnonzero(bitmap), found.open_windows(), k)
                    found.add(_as_long(scores), block.ids[rows])
        out = [(a, w, found.scores[w], found.ids[w]) for a, found in enumerate(best) for w in range(len(found.windows))]
        sizes = [len(s) for *_, s, _ in out]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([a for a, *_ in out], sizes).astype(np.int32)),
                    pa.array(np.repeat([w for _, w, *_ in out], sizes).astype(np.int32)),
                    pa.array(np.concatenate([s for *_, s, _ in out])),
                    pa.array(np.concatenate([i for *_, i in out])),
                ],
                names=["anchor", "slot", "score", "vec_id"],
            )

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST_SHARE, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for two tables of (vec_id, label, vector)."""
    spark = vectors.sparkSession
    stored = blocks(vectors)
    asked = hold(anchors.select("vec_id", "label", "vector").distinct(), "anchors")
    cells = asked.agg(F.sum(F.size("vector") + 2).alias("n")).first()["n"] or 0
    packs = max(1, -(-cells * 8 // pack_bytes))
    dealt = hold(asked.repartition(packs).withColumn("pack", F.spark_partition_id()), "anchor-packs")
    path = fresh_path(spark, "hard-negatives")
    everything = [(_LONG.min, _LONG.max)]
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], empty).write.parquet(path)
    for number in range(packs):
        own = [(r.vec_id, r.label, np.array(r.vector, np.int64)) for r in dealt.where(F.col("pack") == number).collect()]
        if not own:
            continue
        best = _first(stored.mapInArrow(_scan([(*a, everything) for a in own], True, positives), _BEST_SCHEMA), positives)
        near: dict[int, list] = defaultdict(list)
        for r in best.orderBy("anchor", "rank").collect():
            near[r.anchor].append((r.score, r.vec_id))
        # least_share * positive <= 100 * negative <= 100 * positive; none for a positive below 0
        windows = [[(-(-least_share * p // 100), p) if p >= 0 else (1, 0) for p, _ in near[a]] for a in range(len(own))]
        found = _first(stored.mapInArrow(_scan([(*a, w) for a, w in zip(own, windows, strict=True)], False, negatives), _BEST_SCHEMA), negatives)
        named = [(a, slot, own[a][0], vec_id, score) for a, list_ in near.items() for slot, (score, vec_id) in enumerate(list_)]
        pairs = spark.createDataFrame(named, "anchor int, slot int, anchor_id bigint, positive_id bigint, positive_score bigint")
        # as many pairs as the pack has anchors, times the positives
        rows = found.join(F.broadcast(pairs), ["anchor", "slot"])
        rows.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    return spark.read.schema(empty).parquet(path)
