"""Small tables with the awkward cases every operator must stand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

PASSAGE = "once upon a time the grey wolf walked along the river bank and sang to itself until the moon came up again"


def texts(n=60, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "stone river wolf grass cloud ember träne café".split() for b in ("", "s", "ing", "ed")]
    out = []
    for i in range(n):
        body = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 14))) + "." for _ in range(rng.randint(1, 9))]
        if i % 4 == 0:
            body.insert(rng.randrange(len(body) + 1), PASSAGE)
        out.append("\n".join(body))
    return out


def awkward():
    """(doc_id, text): copies, near copies, nulls, blanks, a long text, a phrase said over and over."""
    base = texts()
    rows = list(enumerate(base))
    rows += [(100 + i, base[3]) for i in range(7)]
    rows += [(200 + i, base[5] + f" tail{i}") for i in range(5)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (303, "x"), (304, "éß 中文 \U0001f600 " * 4)]
    rows += [(310, " ".join(base) * 3), (311, "over and " * 900), (312, "a" * 5000), (313, "over and " * 40)]
    rows += [(2**40, base[8]), (-5, base[9] + " " + base[10])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, a null id and columns whose names operators use themselves."""
    rows = [*awkward(), (7, texts()[7]), (7, texts()[7]), (None, texts()[7]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    names = "part bucket fp shard u v n_words n_removed kept_text others score label sign length tie ids at file lang items"
    return df.withColumns({c: F.lit(c) for c in names.split()})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i, _ in enumerate(texts())]
    return spark.createDataFrame([*rows, (None, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")
