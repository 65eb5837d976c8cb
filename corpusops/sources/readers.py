"""Readers of delimited news files, choosing by suffix. All columns are strings."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .delimited import headers, list_files, read_xz, read_zip
from .manifest import manifests, schema_at

# fixed values: suffixes and separators
SUFFIXES = (".gz", ".zip", ".xz", ".csv")
SEMICOLON, COMMA, TAB = ";", ",", "\t"


def latest_file(spark: SparkSession, directory: str, suffixes: tuple[str, ...] = SUFFIXES) -> str | None:
    """Most recent file with one of the suffixes directly in a folder, or complete output of our own with such a name; or None.

    Only names and times are read: the content column is pruned from the scan. An output counts from when its manifest was
    written, so one that is being written, or that failed, is never the newest.
    """
    glob = "*{" + ",".join(suffixes) + "}"
    found = []
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
        newest = files.agg(F.max(F.struct(F.unix_micros(F.col("modificationTime")).alias("at"), "path"))).first()[0]
        found = [tuple(newest)] if newest else []
    except Exception as error:  # no such folder, or nothing in it that matches
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    for told in manifests(spark, directory):
        if told["path"].endswith(suffixes):
            at = datetime.datetime.fromisoformat(told["written"])
            found.append((int(at.timestamp() * 1_000_000), told["path"]))
    return max(found)[1] if found else None


def read_output(spark: SparkSession, path: str, sep: str = SEMICOLON) -> DataFrame:
    """A table that ``sinks.write_delimited`` wrote, with the types it had; strings such as ``007`` stay strings."""
    rows, schema = read_delimited(spark, path, sep), schema_at(spark, path)
    if schema is None:
        return rows
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = SEMICOLON, multi_line: bool = True) -> DataFrame:
    """CSV with quoted fields, every file by its own header; gzip is decoded by suffix.

    Files are grouped by header and each group is read by Spark's reader; columns are united by name, in the order of paths, and are null where a
    file lacks them. Texts hold line breaks, so records may span lines and a file is one task. Files written without
    line breaks inside fields can be split: pass ``multi_line=False``. Short records are padded with null;
    a record with more fields than its header is an error that names the file.
    """
    groups = headers(spark, list_files(spark, path), sep)
    out = None
    for names, paths in groups:
        part = _one_header(spark, path if len(groups) == 1 else paths, names, sep, multi_line)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType()) if out is None else out


def _one_header(spark: SparkSession, path: str | list[str], names: list[str], sep: str, multi_line: bool) -> DataFrame:
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multi_line, "encoding": "utf-8"}
    more = "_more" + "_" * max([0, *map(len, names)])  # takes the first field too many
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, more]])
    rows = spark.read.schema(schema).csv(path, **options)
    lost = F.raise_error(F.concat(F.lit("a record has more fields than the header: "), F.input_file_name()))
    return rows.where(F.when(F.col(f"`{more}`").isNull(), True).otherwise(lost.cast("boolean"))).drop(more)


def sniff_separator(spark: SparkSession, path: str, candidates: tuple[str, ...] = (SEMICOLON, COMMA)) -> str:
    """The candidate that splits the header line, the first one if none does."""
    header = spark.read.text(path).first()
    line = header[0] if header else ""
    return next((c for c in candidates if c in line), candidates[0])


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Plain CSV separated by semicolon, or by comma if the header says so."""
    return read_delimited(spark, path, sniff_separator(spark, path), multi_line)


def read_news(spark: SparkSession, path: str, gz_sep: str = SEMICOLON) -> DataFrame:
    """Read a news file by its suffix: .gz, .zip, .xz, else plain CSV.

    ``gz_sep=","`` is for the comma-separated archives of the rule classifier.
    """
    try:
        if path.endswith(".gz"):
            return read_delimited(spark, path, gz_sep)
        if path.endswith(".zip"):
            return read_zip(spark, path)
        if path.endswith(".xz"):
            return read_xz(spark, path)
        return read_csv(spark, path)
    except Exception as error:
        raise ValueError(f"cannot read {path}: {error}") from error


def read_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Several news files by name."""
    return {name: read_news(spark, path) for name, path in paths.items()}


def read_rules(spark: SparkSession, path: str) -> list[str]:
    """Patterns of the ``regexp`` column. They are configuration and become literals of a plan."""
    rules = read_delimited(spark, path, COMMA).select("regexp").na.drop()
    return [row[0] for row in rules.toLocalIterator()]


def texts_to_frame(spark: SparkSession, data, column: str = "content", position: str | None = None) -> DataFrame:
    """A text, a list of texts or a DataFrame as a DataFrame; ``position`` names a column with the place in the list."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, str):
        data = [data]
    if not isinstance(data, list):
        raise ValueError("expected a text, a list of texts or a DataFrame")
    rows = spark.createDataFrame(list(enumerate(data)), f"{position or '__position'} long, {column} string")
    return rows if position else rows.select(column)


def row_count(df: DataFrame) -> int:
    """Records of a table; for CSV these are parsed records, not physical lines."""
    return df.count()
