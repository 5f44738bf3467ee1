import pytest
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.functions import attributes as A
from topicframe.functions.mapping import map_of, mapped_columns, parse_mapping
from topicframe.functions.templates import is_blank, render


@pytest.mark.parametrize(
    "spec, expected",
    [
        (" ", {}),
        (None, {}),
        ("prop= ", {"prop": ["prop"]}),
        ("prop=attr", {"prop": ["attr"]}),
        (" =attr", {}),
        ("prop", {"prop": ["prop"]}),
        ("a, b", {"a": ["a"], " b": [" b"]}),
        ("a=b=c", {"a": ["b=c"]}),
        ("a=x,b,a=y", {"a": ["x", "y"], "b": ["b"]}),
        (",,", {}),
    ],
)
def test_parse_mapping(spec, expected):
    assert parse_mapping(spec) == expected


@pytest.mark.parametrize(
    "values, expected",
    [
        ({"x": "1", "y": "2"}, {"a": "2"}),
        ({"x": "1"}, {"a": "1"}),
        ({"y": "2"}, {"a": "2"}),
        ({}, {}),
    ],
)
def test_a_later_source_wins_only_with_a_value(spark, values, expected):
    source = F.create_map(*[F.lit(v) for pair in values.items() for v in pair]).cast("map<string,string>")
    built = map_of(mapped_columns("a=x,a=y", lambda name: source.getItem(name)))
    assert spark.range(1).select(built.alias("m")).first().m == expected


def test_automatic_attributes(log):
    rows = log(
        [
            {
                "message_id": "123:456:789",
                "properties": {"source": "s", "version": "1", "odd-name.with_all kinds": "x"},
            }
        ]
    )
    assert rows.select(A.automatic(None).alias("m")).first().m == {
        C.MESSAGE_ID_ATTRIBUTE: "123:456:789",
        C.PROPERTY_PREFIX + "source": "s",
        C.PROPERTY_PREFIX + "version": "1",
        C.PROPERTY_PREFIX + "odd-name.with_all kinds": "x",
    }


@pytest.mark.parametrize("properties", [None, {}])
def test_nothing_to_add(log, properties):
    assert log([{"properties": properties}]).select(A.automatic(None).alias("m")).first().m == {}


def test_key_and_property_mapping_beside_automatic_ones(log):
    rows = log([{"message_id": "1", "key": "test-key", "properties": {"custom-prop": "v"}}])
    spec = f"message.key={C.KEY_SOURCE},custom.attr=custom-prop"
    assert rows.select(A.automatic(spec).alias("m")).first().m == {
        "message.key": "test-key",
        "custom.attr": "v",
        C.MESSAGE_ID_ATTRIBUTE: "1",
        C.PROPERTY_PREFIX + "custom-prop": "v",
    }


def test_record_attributes_replace_mapped_ones(log):
    rows = log(
        [
            {"topic": "real", "properties": {"p": "x"}, "schema_type": "AVRO", "schema_def": "{}"},
            {"topic": "real", "properties": {"p": "x"}, "schema_type": "JSON", "schema_def": "{}"},
        ]
    )
    got = [r.m for r in rows.select("off", A.automatic(f"{C.TOPIC_ATTRIBUTE}=p", True).alias("m")).orderBy("off").collect()]
    assert got[0][C.TOPIC_ATTRIBUTE] == "real" and got[0][C.SCHEMA_ATTRIBUTE] == "{}"
    assert C.SCHEMA_ATTRIBUTE not in got[1]


def test_merge_of_nothing_and_nulls(spark):
    null_map = F.lit(None).cast("map<string,string>")
    row = spark.range(1).select(A.merge().alias("a"), A.merge(null_map, map_of({"x": F.lit("1")})).alias("b")).first()
    assert row.a == {} and row.b == {"x": "1"}


@pytest.mark.parametrize(
    "template, expected",
    [
        ("${topic}", "topic-b"),
        ("a-${topic}-z", "a-topic-b-z"),
        ("${missing}", ""),
        ("plain", "plain"),
        ("", ""),
        ("${topic}${topic}", "topic-btopic-b"),
        ("$topic {x}", "$topic {x}"),
    ],
)
def test_render(spark, template, expected):
    attributes = map_of({"topic": F.lit("topic-b")})
    assert spark.range(1).select(render(template, attributes).alias("t")).first().t == expected


def test_blank(spark):
    texts = spark.createDataFrame([(None,), ("",), (" \t\n",), ("x",)], "t string")
    assert [r.b for r in texts.select(is_blank(F.col("t")).alias("b")).collect()] == [True, True, True, False]
