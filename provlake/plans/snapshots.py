"""Whole-snapshot commits of a dataset: a new version, then its pointer; one writer at a time by a lock file."""

from __future__ import annotations

import json
import os
import socket
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER, LOCK = "_current", "_lock"
STALE_SECONDS = 24 * 3600


class Locked(RuntimeError):
    """Another writer holds the dataset."""


class Files:
    """The few operations that commits need, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = root.rstrip("/")

    def at(self, name: str):
        return self.path(f"{self.root}/{name}")

    def write(self, name: str, text: str, replace: bool) -> bool:
        """False if the file is there already and may not be replaced."""
        try:
            out = self.fs.create(self.at(name), replace)
        except Exception:  # noqa: BLE001 - the file system's own class for a file that exists differs
            if not replace and self.fs.exists(self.at(name)):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.at(name)):
            return None
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def move(self, old: str, new: str) -> None:
        self.fs.delete(self.at(new), False)
        if not self.fs.rename(self.at(old), self.at(new)):
            raise OSError(f"{old} could not become {new}")


def alive(lock: dict) -> bool | None:
    """Whether a lock's owner still runs: known only on its own host."""
    if lock.get("host") != socket.gethostname():
        return None
    try:
        os.kill(int(lock["pid"]), 0)
    except (ProcessLookupError, KeyError, ValueError, TypeError):
        return False
    except PermissionError:
        return True
    return True


class Lock:
    """``with Lock(spark, root)``: a lock of an owner that has ended, or of another host after ``stale`` seconds, is taken over."""

    def __init__(self, spark: SparkSession, root: str, stale: float = STALE_SECONDS, job_active: Callable[[str], bool | None] | None = None) -> None:
        self.files, self.stale, self.job_active, self.mine = Files(spark, root), stale, job_active, uuid.uuid4().hex

    def _reclaimable(self, text: str) -> bool:
        try:
            lock = json.loads(text)
        except ValueError:
            return False  # being written, or not ours: leave it
        known = alive(lock)
        if known is None and self.job_active and lock.get("job"):
            known = self.job_active(lock["job"])
        return known is False or (known is None and time.time() - lock.get("at", time.time()) > self.stale)

    def __enter__(self) -> Lock:
        said = json.dumps({"host": socket.gethostname(), "pid": os.getpid(), "at": time.time(), "id": self.mine, "job": os.environ.get("PROVLAKE_JOB")})
        for _ in range(2):
            if self.files.write(LOCK, said, False):
                return self
            text = self.files.read(LOCK)
            if text is not None and not self._reclaimable(text):
                raise Locked(text)
            self.files.remove(LOCK)
        raise Locked("another writer was faster")

    def __exit__(self, *_) -> None:
        text = self.files.read(LOCK)
        if text and json.loads(text).get("id") == self.mine:
            self.files.remove(LOCK)


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the committed version; None before the first."""
    name = Files(spark, root).read(POINTER)
    return f"{root.rstrip('/')}/{name}" if name else None


def read(spark: SparkSession, root: str) -> DataFrame | None:
    path = current(spark, root)
    return spark.read.parquet(path) if path else None


def commit(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write ``df`` as a new version and point to it; readers see the old or the new one, never half of one.

    The pointer is renamed into place; versions older than the ``keep`` newest go."""
    spark = df.sparkSession
    files = Files(spark, root)
    version = f"v={int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{root.rstrip('/')}/{version}")
    files.write(f"{POINTER}.{version}", version, True)
    files.move(f"{POINTER}.{version}", POINTER)
    old = sorted(s.getPath().getName() for s in files.fs.listStatus(files.path(root)) if s.getPath().getName().startswith("v="))
    for name in old[:-keep]:
        files.remove(name)
    return version
