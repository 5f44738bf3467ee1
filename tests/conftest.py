import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from topicframe.schema import MESSAGE_SCHEMA
from topicframe.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("topicframe-tests", master="local[8]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Build messages from dicts; offsets count up unless given."""

    def build(rows, **defaults):
        base = {
            "topic": "t",
            "part": 0,
            "message_id": None,
            "key": None,
            "properties": None,
            "publish_time": dt.datetime(2024, 1, 1),
            "schema_type": None,
            "schema_def": None,
            "data": b"",
        }
        full = []
        for i, row in enumerate(rows):
            row = {**base, **defaults, "off": i, **row}
            if isinstance(row["data"], str):
                row["data"] = row["data"].encode()
            full.append(tuple(row[f.name] for f in MESSAGE_SCHEMA.fields))
        return spark.createDataFrame(full, MESSAGE_SCHEMA)

    return build


@pytest.fixture
def bundles(spark):
    """Build publisher input from (attributes, content) pairs."""

    def build(*pairs):
        rows = [
            (i, attributes, content.encode() if isinstance(content, str) else content)
            for i, (attributes, content) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, "bundle_id bigint, attributes map<string,string>, content binary")

    return build
