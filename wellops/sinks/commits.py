"""Numbered commits: version N of a folder is a small file that exactly one writer can create.

A writer prepares its data first, under names of its own, and then creates the next number. Where another one was
faster the number exists already and it takes the one after it, so writers neither wait for nor overwrite each other, and
readers see a commit whole or not at all. Numbers lie in folders of a thousand, so the newest one is found by two short
listings.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession

from wellops.sinks.layout import file_system

PER_FOLDER = 1000
# File systems that have no atomic rename; they create an object only where there is none.
OBJECT_STORES = ("s3a", "s3", "s3n", "gs", "oss")


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole content, unless it exists; False then."""
    fs, target = file_system(spark, path)
    scheme = fs.getUri().getScheme()
    fs.mkdirs(target.getParent())
    if scheme == "file":
        local = target.toUri().getPath()
        own = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    direct = scheme in OBJECT_STORES
    own = target if direct else file_system(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")[1]
    try:
        out = fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
    except Exception:
        if fs.exists(target):
            return False
        raise
    if direct:
        return True
    try:
        done = fs.rename(own, target)
    except Exception:
        done = False
    if not done:
        fs.delete(own, False)
        if not fs.exists(target):
            raise OSError(f"cannot create {path}")
    return done


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return []
    return [n for status in fs.listStatus(path) if not (n := status.getPath().getName()).startswith((".", "_"))]


def _file(folder: str, version: int) -> str:
    return f"{folder}/{version // PER_FOLDER:09d}/{version:012d}.json"


def _numbers(spark: SparkSession, folder: str, part: str) -> list[int]:
    return sorted(int(n.partition(".")[0]) for n in _names(spark, f"{folder}/{part}"))


def versions(spark: SparkSession, folder: str) -> list[int]:
    """All numbers committed."""
    return [v for part in sorted(_names(spark, folder)) for v in _numbers(spark, folder, part)]


def newest(spark: SparkSession, folder: str) -> int:
    """The highest number; -1 where there is none."""
    for part in sorted(_names(spark, folder), reverse=True):
        if numbers := _numbers(spark, folder, part):
            return numbers[-1]
    return -1


def read(spark: SparkSession, folder: str, version: int) -> dict:
    fs, path = file_system(spark, _file(folder, version))
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit_at(spark: SparkSession, folder: str, version: int, entry: dict, key: str = "version") -> bool:
    """Commit ``entry`` as number ``version``, which it also holds as ``key``; False where that number is taken."""
    return _create(spark, _file(folder, version), json.dumps({**entry, key: version}, ensure_ascii=False))


def commit_next(spark: SparkSession, folder: str, entry: dict, key: str = "version", first: int = 0) -> int:
    """Commit ``entry`` under the next free number, and return it."""
    version = max(first, newest(spark, folder) + 1)
    while not commit_at(spark, folder, version, entry, key):
        version += 1
    return version
