"""Best-fit packing with several permitted sequence lengths.

Pieces are documents, or parts of them: one longer than the largest permitted length gives full
sequences of it and a rest. Within a group of pieces the longest go first. A piece goes into the
open bin with the least room that still holds it; if there is none, a bin is opened of the size that
costs least for it: the size itself, plus ``waste`` for each token of room that the group's shorter
pieces, by their exact lengths, cannot be expected to fill. At the end every bin is cut down to the
smallest permitted length that holds its contents, so no bin is larger than it need be.

Only (key, length) is grouped, never text. Groups are dealt by the hash of the document, sized so
that one task holds ``GROUP`` pieces in a few bytes each; a bin never crosses groups, which costs
at most one poorly filled bin of each size a group. Full sequences need no packing and are made on
the spot, so a very long document is not a large group.

Defined results: an empty document has one piece of length 0, which goes into a bin like any other
(if all of a group are empty, one bin of the smallest size); ties go by doc_id and part; rows with
equal doc_id are packed each for itself; a null length counts as 0; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoder import default_vocabulary, encoder
from .sizes import dealt

SIZES = (512, 1024, 2048, 4096, 8192)
#: pieces in one group, on average
GROUP = 20_000
LEAST_GROUPS = 48
WASTE = 1.0


def pack(lengths: np.ndarray, sizes: Sequence[int], waste: float = WASTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it, capacity of each bin) for pieces in descending order of length."""
    sizes = sorted(sizes)
    # tokens in pieces of at most a length, of those not yet placed: what may still fill a room
    value, start = np.unique(lengths, return_counts=True)
    left = dict(zip(value.tolist(), start.tolist(), strict=True))
    order = sorted(left)
    fill = [0] * (len(order) + 1)
    for i, v in enumerate(order):
        fill[i + 1] = fill[i] + v * left[v]
    place = {v: i for i, v in enumerate(order)}
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    used: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gone = 0  # tokens placed of the length at hand; longer ones are all placed
    last = None
    for i, length in enumerate(lengths.tolist()):
        gone = gone + length if length == last else length
        last = length
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, own = rooms.pop(at)
        else:
            shorter = fill[place[length] + 1] - gone  # all of it fits, piece by piece, below this length
            fitting = [s for s in sizes if s >= length]

            def cost(size: int) -> float:
                room = size - length
                below = min(shorter, fill[bisect_left(order, room + 1)])
                return (size + waste * max(0, room - below)) / max(1, length + min(room, below))

            size = min(fitting, key=lambda s: (cost(s), s))
            own, room = len(used), size
            used.append(0)
        bins[i], offsets[i] = own, used[own]
        used[own] += length
        insort(rooms, (room - length, own))
    capacity = np.array([sizes[bisect_left(sizes, u)] for u in used], np.int64)
    return bins, offsets, capacity


def _pieces(vocabulary: str, largest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            lo = 0
            for counts, _ in known.counts_and_ids(batch.column("text"), want_ids=False):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo : lo + len(counts)], batch.column("tie")[lo : lo + len(counts)], pa.array(counts.astype(np.int64))], names=["doc_id", "tie", "length"])
                lo += len(counts)

    return run


def lengths(docs: DataFrame, vocabulary: str | None = None, sizes: Sequence[int] = SIZES) -> DataFrame:
    """(doc_id, tie, length): tokens of every text; tie tells apart rows with equal doc_id."""
    text = F.col("text").cast("string")
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), text.alias("text"))
    return kept.mapInArrow(_pieces(vocabulary or default_vocabulary(), max(sizes)), "doc_id bigint, tie bigint, length bigint")


_PLACED = "doc_id bigint, part bigint, length bigint, bin_id string, bin_offset bigint, capacity bigint"


def _pack_group(sizes: Sequence[int], waste: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("part", "ascending"), ("tie", "ascending")])
        length = table.column("length").to_numpy()
        bins, offset, capacity = pack(length, sizes, waste)
        group = table.column("group")[0].as_py()
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "part": table.column("part"),
                "length": table.column("length"),
                "bin_id": pa.array([f"{group}-{b}" for b in bins.tolist()], pa.string()),
                "bin_offset": pa.array(offset),
                "capacity": pa.array(capacity[bins]),
            }
        )

    return run


def packed(pieces: DataFrame, sizes: Sequence[int] = SIZES, waste: float = WASTE, group: int = GROUP) -> DataFrame:
    """(doc_id, part, length, bin_id, bin_offset, capacity) for (doc_id, tie, length); pieces is read twice."""
    largest = max(sizes)
    length = F.coalesce(F.col("length"), F.lit(0).cast("bigint"))
    known = pieces.select("doc_id", "tie", length.alias("length")).withColumn("full", F.floor(F.col("length") / largest))
    rest = F.col("length") - F.col("full") * largest
    # repeated rows are counted before they move, and each gets bins of its own
    whole = known.where("full > 0").groupBy("doc_id", "tie", "full").agg(F.count("*").alias("copies"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    whole = whole.select("doc_id", "tie", "full", upto("copies").alias("copy")).select("doc_id", "tie", "copy", upto("full").alias("part"))
    whole = whole.select(
        "doc_id",
        "part",
        F.lit(largest).cast("bigint").alias("length"),
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.hex("tie"), "part", "copy").alias("bin_id"),
        F.lit(0).cast("bigint").alias("bin_offset"),
        F.lit(largest).cast("bigint").alias("capacity"),
    )
    loose = known.select("doc_id", "tie", F.col("full").alias("part"), rest.alias("length")).where("length > 0 or part = 0")
    groups = max(LEAST_GROUPS, -(-loose.count() // group))
    loose = loose.withColumn("group", dealt(groups, "doc_id", "tie"))
    return loose.groupBy("group").applyInArrow(_pack_group(sizes, waste), _PLACED).unionByName(whole)
