"""Acknowledgements as intervals, against single ones."""

import random

import pytest
from pyspark.sql import functions as F

from topicframe.operators import delivery, intervals
from topicframe.operators.ordering import running_max
from topicframe.workspace import hold


def random_log(spark, seed, n=250):
    """Offsets dense and as sparse as hashes, most of them in one log; some acknowledged in stretches."""
    rng = random.Random(seed)
    rows, acked = set(), True
    for _ in range(n):
        topic = "hot" if rng.random() < 0.6 else f"t{rng.randrange(3)}"
        rows.add((topic, 0, rng.choice([rng.randrange(300), rng.randrange(2**16), rng.randrange(2**50)])))
    out = []
    for row in sorted(rows):
        acked = acked if rng.random() < 0.8 else not acked
        out.append((*row, acked))
    return out, spark.createDataFrame(out, "topic string, part int, off bigint, acked boolean")


def gaps(rows):
    """The runs of acknowledged messages of each log."""
    out, last = [], None
    for topic, part, off, acked in rows:
        if acked and last == (topic, part):
            out[-1][3] = off
        elif acked:
            out.append([topic, part, off, off])
        last = (topic, part) if acked else None
    return sorted(map(tuple, out))


@pytest.mark.parametrize(("seed", "span"), [(1, 32768), (2, 7)])
def test_intervals_equal_single_acknowledgements(spark, seed, span):
    rows, log = random_log(spark, seed)
    acks = delivery.individual_acks(log.where("acked"), "c")
    units = intervals.of_acks(acks)
    log = hold(log, "log")
    # two turns, the second with acknowledgements that came before
    ledger = hold(intervals.merge(log, units.where("first_off % 3 <> 1"), span), "ledger")
    ledger = hold(intervals.merge(log, ledger.unionByName(units.where("first_off % 3 <> 0")), span), "ledger")
    found = sorted((r.topic, r.part, r.first_off, r.last_off) for r in ledger.collect())
    assert found == gaps(rows)
    left = lambda df: sorted((r.topic, r.part, r.off) for r in df.collect())
    assert left(intervals.uncovered(log, ledger, span)) == left(delivery.backlog(log, acks))


def test_intervals_inside_beside_and_across_each_other(spark):
    log = spark.createDataFrame([("t", 0, i) for i in (0, 1, 2, 5, 9, 10, 40)], "topic string, part int, off bigint")
    table = lambda *rows: spark.createDataFrame([("c", "t", 0, a, b) for a, b in rows], "consumer_id string, topic string, part int, first_off bigint, last_off bigint")
    spans = lambda *rows: sorted((r.first_off, r.last_off) for r in intervals.merge(log, table(*rows)).collect())
    assert spans((0, 2), (3, 4), (6, 9), (1, 1), (0, 0)) == [(0, 4), (6, 9)]
    assert spans((11, 30), (39, 41)) == [(11, 41)]
    assert spans((5, 2), (None, 7), (9, None)) == []
    assert [r.off for r in intervals.uncovered(log, table((1, 2), (0, 5), (40, 100))).orderBy("off").collect()] == [9, 10]
    assert intervals.uncovered(log, table()).count() == 7


def test_a_ledger_is_as_long_as_the_gaps(spark):
    log = spark.range(20_000).select(F.lit("t").alias("topic"), F.lit(0).alias("part"), (F.col("id") * 1000).alias("off"))
    acks = delivery.individual_acks(log.where("off not in (5000, 12000000)"), "c")
    ledger = intervals.merge(log, intervals.of_acks(acks))
    assert sorted((r.first_off, r.last_off) for r in ledger.collect()) == [(0, 4000), (6000, 11_999_000), (12_001_000, 19_999_000)]


def test_running_max_equals_a_fold(spark):
    rows, log = random_log(spark, 5)
    got = {(r.topic, r.off): r.m for r in running_max(log.withColumn("v", F.xxhash64("off") % 50), ["topic", "part"], "off", F.when(F.col("v") > 0, F.col("v")), "m", span=16).collect()}
    values = {(r.topic, r.off): r.v for r in log.withColumn("v", F.xxhash64("off") % 50).collect()}
    best = {}
    for topic, _, off, _ in rows:
        assert got[topic, off] == best.get(topic)
        if values[topic, off] > 0:
            best[topic] = max(best.get(topic, 0), values[topic, off])
