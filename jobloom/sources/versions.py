"""Numbered versions of a table: small JSON files that say which folders make it up.

Data folders get new names and are never written twice, so a reader of an older version keeps its files. A version comes
into being by the rename of a finished file; a number that is taken is refused, never replaced.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_versions"


class VersionTaken(RuntimeError):
    """Another writer was first."""


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def new_folder(root: str) -> str:
    """A data folder, relative to `root`, that nothing else uses."""
    return f"data/{uuid.uuid4().hex}"


def numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[1:-5]) for n in children(spark, f"{root}/{FOLDER}") if n.startswith("v") and n.endswith(".json")]


def _file(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/v{number:012d}.json"


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make `content` the version `number`."""
    unfinished, fs = _path(spark, f"{root}/{FOLDER}/{uuid.uuid4().hex}.part")
    out = fs.create(unfinished, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    final, _ = _path(spark, _file(root, number))
    if fs.exists(final) or not fs.rename(unfinished, final):
        fs.delete(unfinished, False)
        raise VersionTaken(f"version {number} of {root} is there already")


def load(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, dict] | None:
    """(number, content) of one version or of the newest; None if there is none."""
    if number is None:
        known = numbers(spark, root)
        if not known:
            return None
        number = max(known)
    target, fs = _path(spark, _file(root, number))
    stream = fs.open(target)
    try:
        return number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
