"""Contents that are files, against the same contents in rows."""

import random

import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.functions import payload as P
from topicframe.plans.publish import Target, publish_bytes, publish_records
from topicframe.plans.publish_files import publish_file_records, publish_files
from topicframe.sources import files


@pytest.fixture
def small_splits(spark):
    """Files are cut into ranges of some hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def stored(spark, folder, contents):
    """Contents as files below folder, and as bundles that name them, those without a name among them."""
    for i, content in enumerate(contents):
        (folder / f"a file-{i:03d}.txt").write_bytes(content)
    found = files.listed(spark, str(folder))
    number = F.regexp_extract("path", r"-(\d+)\.txt$", 1).cast("bigint")
    return found.select(number.alias("bundle_id"), F.create_map(F.lit("t"), F.concat(F.lit("topic"), (number % 2).cast("string"))).alias("attributes"), "path")


def in_rows(spark, bundles, contents):
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(contents)], "bundle_id bigint, content binary")
    return bundles.drop("path").join(rows, "bundle_id")


def sent(published):
    columns = ["topic", "part", "off", "key", "data"]
    messages = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in published.messages.select(columns).collect()), key=str)
    routes = sorted(tuple(r) for r in published.bundles.select("bundle_id", "relationship", "sent_count", F.to_json("attributes")).collect())
    return messages, routes


def random_contents(mark, seed):
    rng = random.Random(seed)
    word = lambda: bytes(rng.choice(b"ab*\r\xff\xc3 ") for _ in range(rng.choice([0, 1, 3, 40, 700])))
    contents = [mark.join(word() for _ in range(rng.randrange(1, 60))) + rng.choice([b"", mark]) for _ in range(5)]
    return [*contents, b"", mark, b"x", mark * 50]


@pytest.mark.parametrize("mark", ["\n", "***", "ab", "é|"])
def test_a_file_in_many_ranges_equals_the_split_of_a_row(spark, tmp_path, small_splits, mark):
    contents = random_contents(mark.encode(), len(mark))
    stored(spark, tmp_path, contents)
    got = files.tokens(spark, str(tmp_path), mark)
    in_order = got.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "data"))).alias("t")).collect()
    found = {int(r.path[-7:-4]): [bytes(x.data) for x in r.t] for r in in_order}
    assert all([x.pos for x in r.t] == list(range(len(r.t))) for r in in_order)
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(contents)], "i int, c binary")
    want = {r.i: [bytes(x) for x in r.t] for r in rows.select("i", P.tokens(F.col("c"), mark).alias("t")).collect()}
    assert {i: t for i, t in want.items() if t} == found
    assert got.select("path").join(files.listed(spark, str(tmp_path)), "path", "left_anti").count() == 0


def test_files_are_cut_into_many_ranges(spark, tmp_path, small_splits):
    stored(spark, tmp_path, [b"some words\n" * 400])
    read = spark.read.option("lineSep", "\n").text(str(tmp_path)).select(F.col("_metadata.file_block_start").alias("b"))
    assert read.distinct().count() >= 10


def test_published_files_equal_published_rows(spark, tmp_path, small_splits):
    contents = random_contents(b"\n", 9)
    bundles = stored(spark, tmp_path, contents)
    target = Target("${t}", partitions=3)
    got = publish_files(bundles, str(tmp_path), target, "\n", key="k-${t}")
    assert sent(got) == sent(publish_bytes(in_rows(spark, bundles, contents), target, "k-${t}", "\n"))


def test_paths_that_are_no_files_fail(spark, tmp_path):
    bundles = stored(spark, tmp_path, [b"a\nb", b"c"])
    lost = bundles.where("bundle_id = 0").select(F.lit(7).cast("bigint").alias("bundle_id"), "attributes", F.lit("elsewhere").alias("path"))
    none = lost.withColumn("bundle_id", F.lit(8).cast("bigint")).withColumn("path", F.lit(None).cast("string"))
    twice = bundles.where("bundle_id = 0").withColumn("bundle_id", F.lit(9).cast("bigint"))
    published = publish_files(bundles.unionByName(lost).unionByName(none).unionByName(twice), str(tmp_path), Target("${t}"), "\n")
    assert {(r.bundle_id, r.relationship, r.sent_count) for r in published.bundles.collect()} == {(0, C.SUCCESS, 2), (1, C.SUCCESS, 1), (7, C.FAILURE, None), (8, C.FAILURE, None), (9, C.SUCCESS, 2)}
    assert sorted((r.topic, r.off, bytes(r.data)) for r in published.messages.collect()) == [("topic0", 0, b"a"), ("topic0", 1, b"b"), ("topic0", 2, b"a"), ("topic0", 3, b"b"), ("topic1", 0, b"c")]
    with pytest.raises(ValueError, match="cannot depend on attributes"):
        publish_files(bundles, str(tmp_path), Target("${t}"), "${t}")
    with pytest.raises(ValueError, match="must not be empty"):
        publish_files(bundles, str(tmp_path), Target("${t}"), "")


@pytest.mark.parametrize("partial", ["none", "prefix"])
@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_records_of_files_equal_records_of_rows(spark, tmp_path, small_splits, partial, fmt):
    rng = random.Random(3)

    def lines(n, bad):
        good = (lambda i: f'"na""me {i}",{i}') if fmt == "csv" else (lambda i: f'{{"name": "n{i}", "age": {i}}}')
        out = [good(i) for i in range(n)]
        for i in bad:
            out[i] = "Malformed, x"
        return "\n".join(x for line in out for x in ([line, "  "] if rng.random() < 0.1 else [line]))

    contents = [lines(n, bad).encode() for n, bad in [(300, []), (300, [200]), (150, [0]), (400, [399, 120, 121]), (1, []), (250, [])]]
    contents += [b"", b"\n \n", lines(90, []).encode() + b"\n", lines(40, []).replace("\n", "\r\n").encode()]
    bundles = stored(spark, tmp_path, contents)
    target, schema = Target("${t}", partitions=2), "name string, age int"
    got = publish_file_records(bundles, str(tmp_path), target, schema, fmt, "json", key_field="name", partial=partial)
    assert sent(got) == sent(publish_records(in_rows(spark, bundles, contents), target, schema, fmt, "json", "name", partial))


def test_a_quoted_line_break_is_malformed_in_a_file(spark, tmp_path):
    bundles = stored(spark, tmp_path, [b'name,age\n"a",1\n"b\nb",2\n"c",3'])
    published = publish_file_records(bundles, str(tmp_path), Target("${t}"), "name string, age int", partial="prefix", options={"header": "true"})
    assert [(r.off, bytes(r.data)) for r in published.messages.collect()] == [(0, b'"a","1"\n')]
    assert [r.relationship for r in published.bundles.collect()] == [C.FAILURE]
