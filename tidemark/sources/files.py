"""Small files and directories through Hadoop's file systems, so that state may lie in any store that Spark reaches."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text; None if there is none."""
    at, files = _at(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside the file and moved over it, so that no reader meets half of it."""
    partial, files = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(partial, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    at, _ = _at(spark, path)
    if files.exists(at) and not files.delete(at, False):
        raise OSError(f"cannot replace {path}")
    if not files.rename(partial, at):
        raise OSError(f"cannot write {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    at, files = _at(spark, source)
    if not files.exists(at):
        raise FileNotFoundError(source)
    if not files.rename(at, _at(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


class Lock:
    """One writer at a time: a file that is created exclusively and says whose it is and since when.

    A lock older than ``stale_s`` was left by a crash and is taken over.
    """

    def __init__(self, spark: SparkSession, path: str, owner: str, stale_s: float = 6 * 3600):
        self.spark, self.path, self.owner, self.stale_s = spark, path, owner, stale_s

    def __enter__(self) -> Lock:
        held = read_text(self.spark, self.path)
        if held is not None:
            try:
                other = json.loads(held)
                age = time.time() - float(other["since"])
            except (ValueError, KeyError, TypeError):  # not yet, or never, written
                at, files = _at(self.spark, self.path)
                other, age = {"owner": "unknown"}, time.time() - files.getFileStatus(at).getModificationTime() / 1000
            if age < self.stale_s:
                raise FileExistsError(f"{self.path} is held by {other['owner']} for {age:.0f} s")
            remove(self.spark, self.path)
        at, files = _at(self.spark, self.path)
        stream = files.create(at, False)  # fails if another was faster
        try:
            stream.write(bytearray(json.dumps({"owner": self.owner, "since": time.time()}), "utf-8"))
        finally:
            stream.close()
        return self

    def __exit__(self, *error) -> None:
        remove(self.spark, self.path)


def replace_directory(spark: SparkSession, staged: str, target: str) -> str | None:
    """Moves a staged directory to its place; what stood there becomes a backup, which is put back if the move fails. Returns the backup."""
    backup = f"{target}.backup-{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:6]}" if exists(spark, target) else None
    if backup:
        move(spark, target, backup)
    try:
        move(spark, staged, target)
    except Exception:
        if backup:
            move(spark, backup, target)
        raise
    return backup
