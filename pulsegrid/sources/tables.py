"""Delimited tables with declared schemas."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, strict: bool = False) -> DataFrame:
    """CSV with a header row: the columns of ``schema`` by name, wherever they stand; other columns are left out.

    The first header line gives the order, and every file's header is held against it when it is read. A missing
    column is an error. Fields may be quoted, a quote inside is doubled. Values that don't fit their type are NULL; with ``strict=True`` they fail the query.
    """
    paths = [path] if isinstance(path, str) else list(path)
    found = {name.strip(): name for name in spark.read.option("header", True).csv(paths).columns}
    missing = [name for name in schema.names if name not in found]
    if missing:
        raise ValueError(f"no columns {missing} in {paths}; there are {list(found)}")
    kinds = {field.name: field.dataType for field in schema}
    whole = T.StructType([T.StructField(raw, kinds.get(name, T.StringType())) for name, raw in found.items()])
    rows = spark.read.schema(whole).options(header=True, escape='"', enforceSchema=False, mode="FAILFAST" if strict else "PERMISSIVE").csv(paths)
    return rows.select(*[F.col(f"`{found[name]}`").alias(name) for name in schema.names])


def clean_name(name: str) -> str:
    """``" ECG Time (h)"`` -> ``ecg_time_h``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    cleaned = re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")
    return cleaned if cleaned[:1].isalpha() else f"x{cleaned}"


def read_typed(
    spark: SparkSession, path: str, schema: T.StructType, skip: Sequence[str] = (), clean_names: bool = True
) -> DataFrame:
    """As ``read_table``; then tidy the column names and leave out ``skip`` (given as tidied)."""
    df = read_table(spark, path, schema)
    if clean_names:
        df = df.toDF(*[clean_name(c) for c in df.columns])
    return df.drop(*skip)


def read_many(
    spark: SparkSession,
    glob: str | Sequence[str],
    schema: T.StructType,
    origin: str = "file",
    by_name: bool = False,
    line_breaks: bool = True,
) -> DataFrame:
    """Files of one kind, with the path each row comes from in ``origin``.

    Files share one header by default. ``by_name=True`` is for files whose columns differ: the header of each file is
    read first (when called, one short read per file), files of one header are read together by name, and a column they lack
    reads as NULL, as does an empty field. Fields may be quoted (a quote inside is doubled) and hold commas; with
    ``line_breaks`` they may hold line breaks too, and a file is then read by one task. Files without any line count as
    empty.
    """
    if not by_name:
        rows = read_table(spark, glob, schema)
        return rows.select("*", F.col("_metadata.file_path").alias(origin))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in _headers(spark, glob):
        if header:
            groups.setdefault(header, []).append(path)
    parts = [_of_one_header(spark, paths, header, schema, origin, line_breaks) for header, paths in sorted(groups.items())]
    if not parts:
        return spark.createDataFrame([], schema.add(origin, "string") if origin not in schema.names else schema)
    return reduce(DataFrame.unionByName, parts)


def _headers(spark: SparkSession, glob: str | Sequence[str]) -> list[tuple[str, tuple[str, ...]]]:
    """Path and column names of each file; none for a file without a line."""
    paths = sorted(spark.read.text(glob).inputFiles())
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda path: _first_line(spark, path), paths))
    return [(path, tuple(name.strip() for name in next(csv.reader([line]), ()))) for path, line in zip(paths, lines, strict=True)]


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, with those a quoted name goes on over."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    conf = spark._jsc.hadoopConfiguration()
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and line.count('"') % 2 and (more := reader.readLine()) is not None:
            line += "\n" + more
        return (line or "").removeprefix("\ufeff")
    finally:
        stream.close()


def _of_one_header(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], schema: T.StructType, origin: str, line_breaks: bool
) -> DataFrame:
    kinds = {field.name: field.dataType for field in schema}
    # By place: names may be empty, or stand twice, of which the first counts.
    places = {name: k for k, name in reversed(list(enumerate(header)))}
    own = T.StructType([T.StructField(f"c{k}", kinds[n] if n in kinds and places[n] == k else T.StringType()) for k, n in enumerate(header)])
    options = {"header": True, "multiLine": line_breaks, "escape": '"', "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    rows = spark.read.schema(own).options(**options).csv(list(paths))

    def value(field: T.StructField) -> Column:
        found = F.col(f"c{places[field.name]}") if field.name in places else F.lit(None).cast(field.dataType)
        return found.alias(field.name)

    return rows.select(*[value(f) for f in schema], F.col("_metadata.file_path").alias(origin))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """``fmt`` is ``parquet`` or ``csv`` (header row, quotes doubled, times to the microsecond)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        writer.options(header=True, escape='"', timestampNTZFormat=exact, timestampFormat=exact).csv(path)
    else:
        writer.format(fmt).save(path)
