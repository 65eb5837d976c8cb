"""Commit manifests: what was written, when, by which run and with which schema, beside each written table.

A manifest is written last, inside the output's folder under a name that Spark's readers skip; overwriting an output removes it first. So an
output with a manifest is complete, and the newest one can be found however many files it has.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NAME = "_manifest.json"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commit(df: DataFrame, path: str, run: str | None = None) -> dict:
    """Record that ``df`` has been written to ``path``; the file appears whole."""
    spark = df.sparkSession
    told = {"run": run or uuid.uuid4().hex, "path": path, "written": datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="microseconds"),
            "schema": json.loads(df.schema.json())}
    part = f"{path}/{NAME}.{told['run']}"
    files, temporary = _files(spark, part)
    stream = files.create(temporary, True)
    stream.write(bytearray(json.dumps(told).encode()))
    stream.close()
    _, final = _files(spark, f"{path}/{NAME}")
    files.delete(final, False)
    files.rename(temporary, final)
    return told


def manifests(spark: SparkSession, folder: str) -> list[dict]:
    """Manifests of the outputs directly in a folder (and of the folder itself), oldest first."""
    found = []
    for pattern in (f"{folder.rstrip('/')}/{NAME}", f"{folder.rstrip('/')}/*/{NAME}"):
        files, at = _files(spark, pattern)
        for status in files.globStatus(at) or []:
            stream = files.open(status.getPath())
            text = bytes(stream.readAllBytes()).decode()  # as long as its schema
            stream.close()
            found.append(json.loads(text) | {"path": status.getPath().getParent().toString()})
    return sorted(found, key=lambda m: (m["written"], m["path"]))


def schema_of(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(manifest["schema"])


def schema_at(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a complete output, None without a manifest."""
    files, at = _files(spark, path)
    own = [m for m in manifests(spark, path) if m["path"] == files.makeQualified(at).toString()]
    return schema_of(own[-1]) if own else None
