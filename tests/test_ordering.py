import random

import pytest
from pyspark.sql import functions as F

from topicframe.operators.lookup import left_lookup
from topicframe.operators.ordering import ordinal, running_total
from topicframe.operators.receive import assign_receive_batches


def _sparse_log(spark, seed, rows=600):
    rng = random.Random(seed)
    data, used = [], set()
    while len(data) < rows:
        # one log holds most rows; offsets have gaps up to far segments
        topic = "hot" if rng.random() < 0.7 else f"t{rng.randrange(4)}"
        off = rng.choice([rng.randrange(2000), rng.randrange(2**20), rng.randrange(2**45)])
        if (topic, off) not in used:
            used.add((topic, off))
            data.append((topic, 0, off, rng.randrange(10)))
    return spark.createDataFrame(data, "topic string, part int, off bigint, v bigint"), data


@pytest.mark.parametrize("seed, span", [(1, 1), (2, 7), (3, 100), (4, 8192)])
def test_running_total_equals_a_fold(spark, seed, span):
    df, data = _sparse_log(spark, seed)
    got = {(r.topic, r.off): r.t for r in running_total(df, ["topic", "part"], "off", F.col("v"), "t", span=span).collect()}
    sums, expected = {}, {}
    for topic, _, off, v in sorted(data, key=lambda r: r[2]):
        expected[topic, off] = sums.get(topic, 0)
        sums[topic] = sums.get(topic, 0) + v
    assert got == expected


def test_ordinal_with_ties(spark):
    rows = [(0, "b", 1), (0, "a", 1), (5, "a", 1), (9, "c", 1)]
    df = spark.createDataFrame(rows, "off bigint, topic string, part int")
    got = {(r.off, r.topic): r.ordinal for r in ordinal(df, ["part"], ties=["topic"], span=2).collect()}
    assert got == {(0, "a"): 0, (0, "b"): 1, (5, "a"): 2, (9, "c"): 3}


def test_full_batches(spark):
    df, data = _sparse_log(spark, 9)
    got = assign_receive_batches(df, 10, span=50).groupBy("topic", "batch_no").count().collect()
    for topic in {r[0] for r in data}:
        sizes = [r["count"] for r in sorted((r for r in got if r.topic == topic), key=lambda r: r.batch_no)]
        assert all(n == 10 for n in sizes[:-1]) and 0 < sizes[-1] <= 10


def test_segment_batches_are_consecutive_and_limited(spark):
    df, data = _sparse_log(spark, 11)
    rows = assign_receive_batches(df, 10, segment=1000).collect()
    assert len(rows) == len(data)
    by_log = {}
    for r in sorted(rows, key=lambda r: r.off):
        assert r.segment_no == r.off // 1000
        by_log.setdefault(r.topic, []).append(r.batch_no)
    for batches in by_log.values():
        assert batches == sorted(batches)
        assert max(batches.count(b) for b in set(batches)) <= 10


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        assign_receive_batches(spark.createDataFrame([], "topic string, part int, off bigint"), 0)


@pytest.mark.parametrize("bound", [0, 100])
def test_lookup_is_the_same_broadcast_or_salted(spark, bound):
    df, data = _sparse_log(spark, 5)
    table = spark.createDataFrame([("hot", 0, 50), ("t1", 0, 7)], "topic string, part int, position bigint")
    got = left_lookup(df, table, ["topic", "part"], broadcast_rows=bound, salts=5)
    known = {"hot": 50, "t1": 7}
    assert sorted((r.topic, r.off, r.position or -1) for r in got.collect()) == sorted(
        (t, o, known.get(t, -1)) for t, _, o, _ in data
    )


@pytest.mark.parametrize("column", ["topic", "part", "off"])
def test_a_row_without_a_place_raises(spark, column):
    rows = spark.createDataFrame([("a", 0, 0), ("a", 0, 1), ("b", 1, 0)], "topic string, part int, off bigint")
    one_less = rows.withColumn(column, F.expr(f"if(topic = 'b', null, {column})"))
    with pytest.raises(Exception, match=f"a row without {column} cannot be put in order"):
        assign_receive_batches(one_less, 2).collect()
    with pytest.raises(Exception, match=f"a row without {column} cannot be put in order"):
        assign_receive_batches(rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType)), 2).collect()
