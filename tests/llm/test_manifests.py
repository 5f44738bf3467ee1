"""Shards and Merkle manifests against plain versions, and on awkward tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topicframe.llm import byte_shards, merkle_climb, numbering

from . import brute
from .cases import awkward, docs, empty, odd  # noqa: F401


def in_order(rows):
    """The order of documents with distinct ids, nulls first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


# ---------------------------------------------------------------- numbering


def test_totals_before_ranges_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(numbering, "FAN", 3)
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") * 7 % 1000 + 1).alias("v"))
    laid = numbering.laid_out(rows, ["k", "v"], 11, "numbering-test")
    assert laid.select("range_no").distinct().count() > 8
    placed = laid.join(numbering.before_ranges(laid, rows="1", total="v"), "range_no")
    bad = placed.where("before_rows + place <> k or all_rows <> 1000 or all_total <> 500500")
    assert bad.count() == 0 and placed.count() == 1000
    first = placed.where("place = 0").select("k", "before_total").collect()
    assert all(r.before_total == r.k * (r.k + 1) // 2 for r in first)


# ---------------------------------------------------------------- 12


@pytest.mark.parametrize(("shards", "ranges"), [(7, 5), (40, 1), (1, 3), (500, 60)])
def test_shards_equal_brute_force(docs, shards, ranges):
    got = byte_shards.assigned(docs, shards, ranges=ranges).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.shards(in_order(awkward()), shards))


def test_shards_are_balanced_and_contiguous(spark):
    copies = [(i, "the same text again and again" * 3) for i in range(700)]
    table = spark.createDataFrame([*copies, *((1000 + i, "x" * (i % 97)) for i in range(1500))], "doc_id bigint, text string")
    rows = byte_shards.assigned(table, 40)
    sums = rows.groupBy("shard").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"), F.max("slot").alias("last"))
    found = sums.orderBy("shard").collect()
    largest = rows.agg(F.max("size")).first()[0]
    target = sum(r.bytes for r in found) / 40
    assert len(found) == 40 and all(abs(r.bytes - target) <= largest and r.n == r.last + 1 for r in found)
    assert all(a.hi < b.lo for a, b in zip(found, found[1:], strict=False))


def test_shards_on_odd_tables(spark, odd, empty):
    rows = byte_shards.assigned(odd, 9).collect()
    assert len(rows) == odd.count()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in sorted({r.shard for r in rows}) for k in range(sum(r.shard == s for r in rows))]
    assert {(r.shard, r.slot) for r in rows if r.doc_id is None} == {(0, 0), (0, 1)}
    assert [r.text_crc32 for r in rows if r.doc_id == 300] == [0]
    assert byte_shards.assigned(empty, 9).count() == 0
    same = spark.createDataFrame([(1, "abc")] * 300 + [(None, None)] * 300, "doc_id bigint, text string")
    assert byte_shards.assigned(same, 4, ranges=6).groupBy("shard").count().count() == 4


def test_a_very_long_text(spark):
    table = spark.createDataFrame([(1, "a"), (2, "word " * 400_000), (3, "b")], "doc_id bigint, text string")
    assert [(r.doc_id, r.shard, r.slot) for r in byte_shards.assigned(table, 4).orderBy("doc_id").collect()] == [(1, 0, 0), (2, 2, 0), (3, 3, 0)]
    proven = {r.doc_id: r.verified for r in merkle_climb.proofs(table.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})).collect()}
    assert set(proven) == {1, 2, 3} and all(proven.values())


# ---------------------------------------------------------------- 13


def filed(spark, rows, sources):
    """Documents dealt to sources, the first taking a third."""
    out = []
    for k, (i, text) in enumerate(rows):
        source = sources[0] if k % 3 == 0 else sources[k % len(sources)]
        text = text and text.replace("o", "O")
        out.append((i, text, None if k % 11 == 0 else "en", source, None if text is None else len(text)))
    return out, spark.createDataFrame(out, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def plain(frame):
    return sorted((tuple(r)[:6] for r in frame.collect()), key=str)


@pytest.mark.parametrize(
    ("sources", "run", "lane", "ranges"),
    [(["b", "a", None, "", "é", "Z"], 16, merkle_climb.LANE, None), (["b", "a", None, "", "é", "Z"], 3, 9, 7), ([f"s{i}" for i in range(60)], 3, 9, 7)],
)
def test_proofs_equal_brute_force(spark, sources, run, lane, ranges):
    rows, table = filed(spark, awkward(), sources)
    got = merkle_climb.proofs(table, run=run, lane=lane, ranges=ranges)
    assert plain(got) == sorted(brute.merkle(rows, run), key=str)
    bad = got.where("verified <> (folded_root = root)").count()
    assert bad == 0 and {r.verified for r in got.collect()} == {True, False}


def test_tampering_shows_only_where_a_capital_goes(spark):
    rows, table = filed(spark, [(i, "Bac" if i % 2 else "bac") for i in range(300)], ["x", "y", "z"])
    import zlib

    changed = {i for i, *_ in rows if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0}
    got = merkle_climb.proofs(table)
    assert {r.doc_id for r in got.where("not verified").collect()} == changed and changed


@pytest.mark.parametrize("number", [1, 17, 257])
def test_sizes_around_full_runs(spark, number):
    rows, table = filed(spark, [(i, f"text {i}") for i in range(number)], ["only"])
    assert plain(merkle_climb.proofs(table, lane=32)) == sorted(brute.merkle(rows), key=str)


def test_proofs_on_odd_tables(spark, odd, empty):
    table = odd.withColumns({"source": F.when(F.col("doc_id") > 20, F.lit("s")), "n_chars": F.length("text"), "idx": F.lit("idx"), "id": F.lit(1), "range_no": F.lit(2)})
    rows = table.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert plain(merkle_climb.proofs(table, ranges=5)) == sorted(brute.merkle([tuple(r) for r in rows]), key=str)
    none = empty.withColumns({"source": F.lit("s"), "n_chars": F.lit(1)})
    assert merkle_climb.proofs(none).count() == 0


def test_a_node_is_stored_once_a_lane(spark):
    rows, table = filed(spark, [(i, f"text {i % 50}") for i in range(600)], ["hot"])
    levels = []
    build = merkle_climb.Levels.nodes

    class Seen(merkle_climb.Levels):
        def nodes(self):
            levels.append(build(self))
            return levels[-1]

    merkle_climb.Levels, kept = Seen, merkle_climb.Levels
    try:
        merkle_climb.proofs(table, run=4, lane=16).count()
    finally:
        merkle_climb.Levels = kept
    # 4 rows of 4 leaves climb by one copy, whatever the level
    copies = levels[0].groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("lane").alias("lanes")).collect()
    assert max(r.n for r in copies) > 10 and all(r.n == r.lanes for r in copies)
