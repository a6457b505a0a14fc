"""Versions of a table: folders that never change, and a list of versions of which the highest is the table.

A writer puts new folders under the root and then commits a version, one small file that names the folders which make the
table. That file is written beside its place and renamed to the next number, which fails if somebody else has taken it: then the
writer decides anew. So a reader has a version whole, before or after a commit; a crash before it leaves folders that no
version names, one after it nothing undone. The last KEPT versions keep their folders, for readers that have begun.

How far two writers exclude each other is up to the file system's rename, which must not replace."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import SparkSession

VERSIONS = "_versions"
KEPT = 2
ATTEMPTS = 20


class Version(NamedTuple):
    number: int
    parts: list[str]  # folders under the root
    meta: dict


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, at = _fs(spark, f"{root}/{VERSIONS}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _read(spark: SparkSession, root: str, number: int) -> Version:
    fs, at = _fs(spark, f"{root}/{VERSIONS}/{number:012}.json")
    stream = fs.open(at)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, told["parts"], told["meta"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The highest version, or None."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


def new_part(kind: str = "part") -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def _taken(spark: SparkSession, root: str, version: Version) -> bool:
    """Makes it the next version; False if that number is there already."""
    fs, folder = _fs(spark, f"{root}/{VERSIONS}")
    fs.mkdirs(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    own, target = path(folder, f".{uuid.uuid4().hex}"), path(folder, f"{version.number:012}.json")
    out = fs.create(own, False)
    out.write(json.dumps({"parts": version.parts, "meta": version.meta}).encode())
    out.close()
    try:
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        if fs.exists(target):
            return False
        none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        context.rename(own, target, options)
        return True
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        if fs.exists(own):
            fs.delete(own, False)


def commit(spark: SparkSession, root: str, change: Callable[[Version | None], tuple[list[str], dict]]) -> Version:
    """A new version with the parts and meta that change() makes of the one before; called again if another writer was first."""
    for _ in range(ATTEMPTS):
        before = current(spark, root)
        parts, meta = change(before)
        version = Version(before.number + 1 if before else 1, parts, meta)
        if _taken(spark, root, version):
            _forget(spark, root)
            return version
    raise RuntimeError(f"{root}: other writers were first {ATTEMPTS} times")


def _forget(spark: SparkSession, root: str) -> None:
    """Drops versions before the last KEPT, and folders that only they named."""
    numbers = _numbers(spark, root)
    old, kept = numbers[:-KEPT], numbers[-KEPT:]
    if not old:
        return
    needed = {p for n in kept for p in _read(spark, root, n).parts}
    for n in old:
        for part in set(_read(spark, root, n).parts) - needed:
            fs, at = _fs(spark, f"{root}/{part}")
            fs.delete(at, True)
        fs, at = _fs(spark, f"{root}/{VERSIONS}/{n:012}.json")
        fs.delete(at, False)
