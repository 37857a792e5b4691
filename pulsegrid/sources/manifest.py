"""Numbered manifests of a folder: small JSON files that say which parts of it count.

A manifest is written under a name of its own and then renamed to its number, which fails if that number is taken. So it is
seen whole or not at all, and of two writers of one number one loses. This holds where a rename that doesn't overwrite is
atomic (as in HDFS); on other stores let one writer at a time append.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

EMPTY = {"batches": [], "dropped": []}


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_manifests")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the latest manifest; 0 and an empty one without any."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return 0, EMPTY
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = [int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[: -len(".json")].isdigit()]
    if not numbers:
        return 0, EMPTY
    at = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{max(numbers):012d}.json")
    stream = files.open(at)
    try:
        return max(numbers), json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, number: int, content: dict) -> bool:
    """Make ``content`` the manifest of that number; False if there is one already."""
    folder, files = _folder(spark, path)
    jvm = spark._jvm
    files.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json")
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Exception as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        files.delete(draft, False)
        return False
    return True
