"""Folders that all executors share, for tables that a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: The temporary folder of each local application without a shared one.
_own: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; on one machine, where the session names none, in a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidemark-"))
    return f"{found.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
