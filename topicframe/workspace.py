"""Where intermediate tables and checkpoints live."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A private folder is made only for a local session that names none, as in tests; on a
    cluster an unset folder is an error, since no single machine's disk would do.
    """
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_KEY} to a folder shared by all executors")
    return _private_dir()


@cache
def _private_dir() -> str:
    return tempfile.mkdtemp(prefix="topicframe-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/topicframe/{safe_name(label)}-{uuid.uuid4().hex}"


def hold(df: DataFrame, label: str) -> DataFrame:
    """Write a small derived table once and go on from the files.

    It is then computed once however often it is used, survives lost executors, and has a
    size Spark knows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system its path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has committed all of a folder."""
    return exists(spark, f"{path}/_SUCCESS")


def safe_name(identity: str) -> str:
    """A folder name for an identity of any length and alphabet, distinct per identity."""
    readable = re.sub(r"[^A-Za-z0-9_.-]+", "_", identity)[:60]
    digest = hashlib.sha1(identity.encode("utf-8")).hexdigest()[:10]
    return f"{readable}-{digest}"
