import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from topicframe import constants as C
from topicframe.functions import codecs
from topicframe.operators import records
from topicframe.plans.consume import Subscription, consume_records

PERSON = "name string, age int"


def _consumed(messages, schema=PERSON, needs_schema=False, reader="csv", writer="csv", **settings):
    sub = Subscription("c", **settings)
    got = consume_records(messages, sub, schema, reader, writer, needs_schema=needs_schema)
    rows = got.orderBy("topic", "batch_no", "bundle_no", "relationship").collect()
    return [r for r in rows if r.relationship == C.SUCCESS], [r for r in rows if r.relationship == C.PARSE_FAILURE]


def test_many_records_in_one_message(log):
    data = "\n".join(f"Justin Thyme, {i}" for i in range(50))
    (only,), bad = _consumed(log([{"data": data}]))
    assert not bad and only.record_count == 50 and only.attributes[C.RECORD_COUNT_ATTRIBUTE] == "50"
    assert bytes(only.content).decode() == "".join(f'"Justin Thyme","{i}"\n' for i in range(50))


def test_records_before_the_first_bad_one_stay(log):
    data = "\n".join(f"Justin Thyme, {i}" if i % 2 == 0 else "Malformed message" for i in range(10))
    (good,), (bad,) = _consumed(log([{"data": data}]))
    assert bytes(good.content) == b'"Justin Thyme","0"\n' and good.record_count == 1
    assert bytes(bad.content) == data.encode() and bad.attributes == {}


def test_all_bad(log):
    good, (bad,) = _consumed(log([{"data": "message"}] * 2), demarcator="***")
    assert not good and bytes(bad.content) == b"message***message" and bad.message_count == 2


def test_runs(log):
    messages = log(
        [
            {"data": "A,10"},
            {"data": "B,10"},
            {"data": "C,10", "properties": {"prop": "val"}},
            {"data": "D,10", "properties": {"prop": "val"}, "key": "K"},
        ]
    )
    good, bad = _consumed(messages, mapping=f"prop,key={C.KEY_SOURCE}")
    assert not bad
    assert [bytes(b.content) for b in good] == [b'"A","10"\n"B","10"\n', b'"C","10"\n', b'"D","10"\n']
    assert good[2].attributes == {
        "prop": "val",
        "key": "K",
        C.PROPERTY_PREFIX + "prop": "val",
        C.TOPIC_ATTRIBUTE: "t",
        C.RECORD_COUNT_ATTRIBUTE: "1",
    }


TOPICS = [("foo", "A,9"), ("bar", "Z,10"), ("foo", "G,1"), ("bar", "F,7")]


def test_two_topics_in_one_batch(log):
    messages = log([{"topic": t, "data": d, "schema_type": "JSON", "schema_def": "s"} for t, d in TOPICS])
    good, _ = _consumed(messages, by=("part",))
    assert [(b.topic, bytes(b.content)) for b in good] == [
        ("bar", b'"Z","10"\n"F","7"\n'),
        ("foo", b'"A","9"\n"G","1"\n'),
    ]
    assert all(C.SCHEMA_ATTRIBUTE not in b.attributes for b in good)


def test_a_schema_change_begins_a_bundle(log):
    messages = log(
        [
            {"topic": t, "data": d, "schema_type": "AVRO", "schema_def": "two" if i == 2 else "one"}
            for i, (t, d) in enumerate(TOPICS)
        ]
    )
    good, _ = _consumed(messages, by=("part",))
    assert [(b.topic, bytes(b.content), b.attributes[C.SCHEMA_ATTRIBUTE]) for b in good] == [
        ("bar", b'"Z","10"\n"F","7"\n', "one"),
        ("foo", b'"A","9"\n', "one"),
        ("foo", b'"G","1"\n', "two"),
    ]


def test_topic_and_record_count(log):
    messages = log([{"data": d} for d in ("1,Alice", "2,Bob", "3,Charlie")], topic="test-topic")
    (only,), _ = _consumed(messages, "id int, name string")
    assert only.attributes == {C.TOPIC_ATTRIBUTE: "test-topic", C.RECORD_COUNT_ATTRIBUTE: "3"}


@pytest.mark.parametrize("data", ["", None, "\n\n"])
def test_nothing_in_a_payload(log, data):
    assert _consumed(log([{"data": data}])) == ([], [])


def test_a_message_without_schema_fails_whole(log):
    messages = log(
        [{"data": "A,1", "schema_def": "s"}, {"data": "B,2"}, {"data": "C,3", "schema_def": "s"}], schema_type="AVRO"
    )
    good, bad = _consumed(messages, needs_schema=True)
    assert [bytes(b.content) for b in good] == [b'"A","1"\n', b'"C","3"\n']
    assert [bytes(b.content) for b in bad] == [b"B,2"]
    routes = records.route_schema(messages).orderBy("off").collect()
    assert [r.relationship for r in routes] == [C.SUCCESS, C.PARSE_FAILURE, C.SUCCESS]


@pytest.mark.parametrize("line", ["only one", "a,1,extra", "a,not a number"])
def test_malformed_lines(log, line):
    parsed = records.route(records.parse(log([{"data": line}]), PERSON)).first()
    assert parsed.failed and parsed.kept == []


JSON = "name string, age int, address struct<city:string>, tags array<string>, employed boolean"
OBJECT = '{"name":"Mary","age":32,"address":{"city":"X"},"tags":["a","b"],"employed":true}'


@pytest.mark.parametrize(
    "text, kept, failed",
    [
        (OBJECT, 1, False),
        (f"[{OBJECT},{OBJECT}]", 2, False),
        (f"[\n  {OBJECT},\n  {OBJECT}\n]\n", 2, False),
        ("", 0, False),
        ("[]", 0, False),
        ("{bad", 0, True),
        (f"[{OBJECT},", 1, True),
        (f"[{OBJECT},{OBJECT}", 2, True),
        (f'[{OBJECT},{{"name":"cu', 1, True),
        ('{"age":1}\n{"age":2}\n\n{"age":3}\n', 3, False),
        ('{"age":1}{"age":2} {"age":3}', 3, False),
        (f"{OBJECT}\n{OBJECT}\n", 2, False),
        (f"{OBJECT} trailing junk", 1, True),
        ('{"age":1} trailing junk', 1, True),
        ('[{"age":1}] [{"age":2},{"age":3}]', 3, False),
        ('[{"age":1}], {"age":2}', 1, True),
        ('junk {"age":1}', 0, True),
        ('{"name":"a } ] , \\" {","age":1}{"age":2}', 2, False),
        ('[{"age":1},]', 1, False),
        (f'[{OBJECT},{{"age":"zz"}},{OBJECT}]', 1, True),
    ],
)
def test_json(log, text, kept, failed):
    row = records.route(records.parse(log([{"data": text}]), JSON, "json")).first()
    assert (len(row.kept), row.failed) == (kept, failed)


CSV_TEXTS = ['say "hi"', "two\nlines", "a,b", "", None, " spaced ", '"', "tab\there", "crlf\r\nhere", "\\back", "né"]


def test_csv_texts_come_back(spark):
    options = {"nullValue": "\\N"}
    schema = "n bigint, text string"
    rows = spark.createDataFrame(list(enumerate(CSV_TEXTS)), schema)
    lines = rows.withColumn("line", codecs.serialize(F.struct("n", "text"), "csv", options))
    joined = "".join(r.line for r in lines.orderBy("n").collect())
    data = spark.createDataFrame([(bytearray((codecs.csv_header(["n", "text"]) + joined).encode()),)], "data binary")
    got = records.explode(records.parse(data, schema, "csv", {**options, "header": "true"})).collect()
    assert [(r.n, r.text, r[codecs.CORRUPT]) for r in got] == [(i, t, None) for i, t in enumerate(CSV_TEXTS)]


@pytest.mark.parametrize(
    "line, values", [('"say ""hi""",2', ('say "hi"', 2)), ("5\" pipe,3", ('5" pipe', 3)), ('"a, b" ,4', ("a, b", 4))]
)
def test_csv_quoting(log, line, values):
    row = records.explode(records.parse(log([{"data": line + "\nlast,9"}]), "x string, y int")).orderBy("pos").collect()
    assert [(r.x, r.y) for r in row] == [values, ("last", 9)]


def test_writer_options(spark):
    row = spark.createDataFrame([("a", None)], "x string, y string")
    plain = codecs.serialize(F.struct("x", "y"), "csv", {"sep": ";", "quoteAll": "false", "nullValue": "-"})
    assert row.select(plain.alias("v")).first().v == "a;-\n"
    assert row.select(codecs.serialize(F.struct("x", "y"), "json", {"ignoreNullFields": "false"}).alias("v")).first().v == '{"x":"a","y":null}'
    with pytest.raises(Exception, match="(?i)avro"):
        row.select(codecs.serialize(F.struct("x", "y"), "avro").alias("v")).collect()


def test_json_comes_back_as_it_was(log):
    (only,), _ = _consumed(log([{"data": OBJECT}]), JSON, reader="json", writer="json")
    assert bytes(only.content).decode() == OBJECT


def test_a_reader_of_ones_own(log):
    def reader(data):
        words = F.split(data.cast("string"), " ")
        return F.transform(
            words,
            lambda w: F.named_struct(F.lit("w"), w, F.lit(codecs.CORRUPT), F.when(w == "bad", w)),
        )

    row = records.route(records.parse(log([{"data": "a b bad c"}]), "w string", reader)).first()
    assert [r.w for r in row.kept] == ["a", "b"] and row.failed


def test_avro_needs_its_package(log):
    with pytest.raises(AnalysisException, match="spark-avro"):
        records.parse(log([{"data": "x"}]), PERSON, "avro", {"schema": "{}"})


def test_unknown_format(log):
    with pytest.raises(ValueError):
        records.parse(log([{"data": "x"}]), PERSON, "yaml")


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("consume", [(0, C.SUCCESS, 1), (1, C.SUCCESS, 0)]),
        ("discard", [(0, C.SUCCESS, 1)]),
        ("fail", [(0, C.SUCCESS, 1), (1, C.FAILURE, 1)]),
    ],
)
def test_policies(log, policy, expected):
    parsed = records.parse(log([{"data": "a,1"}, {"data": "bad"}]), PERSON)
    usable = F.size(F.filter("records", lambda r: r.isNotNull())).alias("usable")
    got = records.apply_policy(parsed, policy).orderBy("off").select("off", "relationship", usable).collect()
    assert [tuple(r) for r in got] == expected


def test_exploded_positions(log):
    parsed = records.parse(log([{"data": "a,1\nb,2"}, {"data": "c,3"}]), PERSON)
    got = records.explode(parsed).orderBy("off", "pos").select("off", "pos", "name", "age").collect()
    assert [tuple(r) for r in got] == [(0, 0, "a", 1), (0, 1, "b", 2), (1, 0, "c", 3)]


def test_written_across_messages(log):
    parsed = records.route(records.parse(log([{"data": "a,1\nb,2"}, {"data": "bad"}, {"data": "c,3"}]), PERSON))
    (only,) = records.write(records.counts(parsed), "json", ["topic"]).collect()
    assert bytes(only.content) == b'{"name":"a","age":1}{"name":"b","age":2}{"name":"c","age":3}'
    assert only.record_count == 3


_VALUES = [
    ('{"a": {"b": [1, 2]}} {"a": 1}', ['{"a": {"b": [1, 2]}}', '{"a": 1}']),
    ('[{"a": [1]}, {"a": "]"}] [{"a": 3}]', ['{"a": [1]}', ' {"a": "]"}', '{"a": 3}']),
    ('[{"a": [1]},, {"a": 2}]', ['{"a": [1]}', ' {"a": 2}']),
    ('{"a": [1]} junk "}{" {"a": 2}', ['{"a": [1]}', ' junk "}{" ', '{"a": 2}']),
    ('[{"a": [1]}, {"a": [2', ['{"a": [1]}', ' {"a": [2', "["]),
    ('[{"a": [1]}', ['{"a": [1]}', "["]),
    ('{"a": [1]', ['{"a": [1]', "["]),
    ('{"a": "\\\\\\"}"} {"b": [2]}', ['{"a": "\\\\\\"}"}', '{"b": [2]}']),
    ('{"a": [1]}] {"b": 2}', ['{"a": [1]}', '] {"b": 2}']),
    ("[1, [2, 3], {}]", ["1", " [2, 3]", " {}"]),
    ("[[]]", ["[]"]),
    ("[] {}", ["{}"]),
]


@pytest.mark.parametrize(("text", "values"), _VALUES)
def test_json_is_cut_by_its_brackets(spark, text, values):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(codecs._by_brackets(F.col("t"))).first()[0] == values


def test_nested_json_takes_time_in_proportion(spark):
    import time

    def taken(n):
        one = '{"name": "n", "tags": [1, [2, {"x": "]"}]], "at": {"deep": {"er": [{}]}}}'
        df = spark.createDataFrame([("[" + ",\n".join([one] * n) + "]",), ("\n".join([one] * n),)], "t string")
        cut = df.select(F.size(codecs.json_values(F.col("t"))))
        began = time.time()
        assert [r[0] for r in cut.collect()] == [n, n]
        return time.time() - began

    taken(10)
    assert taken(100_000) < 20 * max(taken(20_000), 0.2)


ONE = '{"type":"record","name":"ExampleRecord","fields":[{"name":"field1","type":"int"}]}'
TWO = '{"type":"record","name":"ExampleRecord","fields":[{"name":"field1","type":"int"},{"name":"field2","type":["null","string"]}]}'


def _texts(bundles):
    return {(r.topic, r.first_off, r.relationship): bytes(r.content).decode() for r in bundles.collect()}


def test_a_changing_schema_begins_a_bundle(log):
    rows = [("foo", ONE, "9"), ("bar", ONE, "10"), ("foo", TWO, "1,x"), ("bar", ONE, "7")]
    messages = log([{"topic": t, "schema_type": "AVRO", "schema_def": s, "data": d} for t, s, d in rows])
    assert _texts(consume_records(messages, Subscription("c"))) == {
        ("bar", 1, "success"): '"10"\n"7"\n',
        ("foo", 0, "success"): '"9"\n',
        ("foo", 2, "success"): '"1","x"\n',
    }


def test_each_message_is_read_by_its_own_schema(log):
    rows = [(ONE, '{"field1": 1, "field2": "left out"}'), (TWO, '[{"field1": 2}, {"field1": 3, "field2": "b"}]'), (TWO, '{"field1": 4, "field2": 5}'), ("no schema", "{}"), (None, "{}"), (ONE, '{"field1": 1.5}'), (ONE, ""), (TWO, '{"field1": 2147483648}')]
    messages = log([{"schema_type": "JSON", "schema_def": s, "data": d} for s, d in rows])
    assert _texts(consume_records(messages, Subscription("c", demarcator="|"), None, "json", "json")) == {
        ("t", 0, "success"): '{"field1":1}{"field1":2}{"field1":3,"field2":"b"}',
        ("t", 0, "parse_failure"): '{"field1": 4, "field2": 5}|{}|{}|{"field1": 1.5}|{"field1": 2147483648}',
    }


def test_schemas_too_many_to_send_are_met_by_salted_keys(log, monkeypatch):
    from topicframe.operators import lookup

    monkeypatch.setattr(lookup.left_lookup, "__defaults__", ("off", 1, 8))
    rows = [(ONE if i % 3 else TWO, str(i)) for i in range(40)]
    messages = log([{"schema_type": "AVRO", "schema_def": s, "data": d} for s, d in rows])
    got = consume_records(messages, Subscription("c")).groupBy("relationship").sum("record_count", "message_count").collect()
    assert {tuple(r) for r in got} == {("success", 26, 26), ("parse_failure", 0, 14)}


@pytest.mark.parametrize(
    ("text", "fields"),
    [
        (ONE, [("field1", "int", False)]),
        (TWO, [("field1", "int", False), ("field2", "string", True)]),
        ('{"type":"record","fields":[{"name":"a","type":{"type":"map","values":"int"}},{"name":"b","type":["int","string"]},{"name":"c","type":"null"}]}', [("a", "object", False), ("b", "any", False), ("c", "null", True)]),
        ('{"type":"record","fields":[]}', []),
        ('{"type":"record"}', None),
        ('{"type":"record","fields":[{"name":"a"}]}', None),
        ('{"type":"record","fields":[{"type":"int"}]}', None),
        ('{"type":"record","fields":[{"name":"a","type":"unknown"}]}', None),
        ('{"type":"record","fields":[{"name":"a","type":"int"},{"name":"a","type":"int"}]}', None),
        ('{"type":"enum","symbols":[]}', None),
        ("[]", None),
        ("", None),
        (None, None),
    ],
)
def test_fields_of_schema_texts(spark, text, fields):
    from topicframe.functions import schemas

    got = spark.createDataFrame([(text,)], "t string").select(schemas.fields_of(F.col("t"))).first()[0]
    assert (None if got is None else [tuple(f) for f in got]) == fields
