"""Delimited files by their own headers, as a Python data source: zip, xz, gzip and plain text.

A file is one partition and is streamed: opened through Arrow's file systems, decompressed and parsed record by record, so
neither its size nor that of a record batch bounds it. One small job reads the headers alone; the rows
are then read against the union of all headers, by name.
"""

from __future__ import annotations

import csv
import gzip
import io
import json
import lzma
import sys
import zipfile
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: records of a batch; headers that a task reads
BATCH_ROWS, HEADERS_PER_TASK = 4096, 64
HEADERS = "path string, names array<string>"


def open_stream(stack: ExitStack, path: str):
    """The text of a file, decompressed by its suffix; of a zip archive the first ``.csv`` member."""
    local = path.startswith("file:") or "://" not in path
    system, name = (fs.LocalFileSystem(), path.removeprefix("file:").replace("//", "/")) if local else fs.FileSystem.from_uri(path)
    raw = stack.enter_context(system.open_input_file(name))
    if path.endswith(".zip"):
        archive = stack.enter_context(zipfile.ZipFile(raw))
        member = next((n for n in archive.namelist() if n.endswith(".csv")), None)
        if member is None:
            raise ValueError(f"the zip archive holds no csv file: {path}")
        raw = stack.enter_context(archive.open(member))
    elif path.endswith(".xz"):
        raw = stack.enter_context(lzma.open(raw, "rb"))
    elif path.endswith(".gz"):
        raw = stack.enter_context(gzip.open(raw, "rb"))
    return io.TextIOWrapper(io.BufferedReader(raw) if not hasattr(raw, "read1") else raw, "utf-8-sig", newline="")


def records(stack: ExitStack, path: str, sep: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(open_stream(stack, path), delimiter=sep, quotechar='"')


def column_names(header: list[str]) -> list[str]:
    """Names of a header; empty ones become ``_c<index>``, repeated ones get their index."""
    lower = [n.lower() for n in header]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(header)]


class DelimitedFiles(DataSource):
    """Options: paths (a JSON list), sep; without a schema it gives (path, names) of every file."""

    @classmethod
    def name(cls) -> str:
        return "delimited_files"

    def schema(self) -> str:
        return HEADERS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(json.loads(self.options["paths"]), self.options["sep"], None if schema.names == ["path", "names"] else schema.names)


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], sep: str, names: list[str] | None):
        self.paths, self.sep, self.names = paths, sep, names

    def partitions(self) -> list[InputPartition]:
        step = 1 if self.names is not None else HEADERS_PER_TASK
        return [InputPartition(self.paths[i:i + step]) for i in range(0, len(self.paths), step)]

    def read(self, partition: InputPartition) -> Iterator:
        for path in partition.value:
            with ExitStack() as stack:
                rows = records(stack, path, self.sep)
                header = column_names(next(rows, []))
                if self.names is None:
                    yield path, header
                else:
                    yield from self._batches(path, header, rows)

    def _batches(self, path: str, header: list[str], rows: Iterator[list[str]]) -> Iterator[pa.RecordBatch]:
        place = [header.index(n) if n in header else len(header) for n in self.names]
        held: list[list[str]] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] if i < len(r) and r[i] != "" else None for r in held], pa.string()) for i in place], names=self.names)

        for number, record in enumerate(rows, 2):
            if len(record) > len(header):
                raise ValueError(f"{path}: record {number} has {len(record)} fields, the header has {len(header)}")
            if record:
                held.append(record)
            if len(held) == BATCH_ROWS:
                yield batch()
                held = []
        if held:
            yield batch()


def _source(spark: SparkSession, paths: list[str], sep: str):
    spark.dataSource.register(DelimitedFiles)
    return spark.read.format(DelimitedFiles.name()).option("paths", json.dumps(paths)).option("sep", sep)


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Names of the files that Spark would read for a path, folder or pattern, in order; nothing is opened."""
    return sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())


def headers(spark: SparkSession, paths: list[str], sep: str) -> list[tuple[list[str], list[str]]]:
    """(names, paths) of each different header, in the order of paths; files without a header are left out."""
    found = _source(spark, paths, sep).load().where(F.size("names") > 0)
    by = found.groupBy("names").agg(F.array_sort(F.collect_list("path")).alias("paths")).collect()  # the names of all files, once
    return sorted(((list(r["names"]), list(r["paths"])) for r in by), key=lambda x: x[1][0])


def read_archives(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """Rows of compressed files, each by its own header; the columns are those of all headers, in the order of paths.

    Short records are padded, an empty field is null, a column that a file lacks is null in its rows.
    A record with more fields than its header is an error that names the file and the record.
    """
    paths = list_files(spark, path)
    names = list(dict.fromkeys(n for own, _ in headers(spark, paths, sep) for n in own))
    return _source(spark, paths, sep).schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).load()


def read_zip(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """First ``.csv`` member of each zip archive; an archive without one is an error."""
    return read_archives(spark, path, sep)


def read_xz(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Delimited text compressed with xz."""
    return read_archives(spark, path, sep)
