"""Numbered versions under a folder, and a journal of what a job has done.

``<root>/_CURRENT/<number>`` holds the path of one version; the greatest number
counts.  A number's file is created exclusively, so of two writers that follow
the same version one gets the number and the other a ``Conflict``: it reads what
was committed meanwhile and tries again.  Nothing is overwritten; a reader keeps
the version it opened, for as long as ``retire`` leaves it.

The file system must create a file exclusively (HDFS and local disks do; object
stores do with conditional writes).  A writer that is lost between creating its
file and filling it leaves an empty one, which readers pass over after
``PATIENCE`` seconds.
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PATIENCE = 2.0


class Conflict(RuntimeError):
    """Another writer committed first."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below ``path``; None if there is no such folder.  Any other failure raises."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    return [entry.getPath().getName() for entry in fs.listStatus(where)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with this text; ``Conflict`` if it is there already."""
    fs, where = _fs(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    data = bytearray(text.encode())
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        fs.mkdirs(where.getParent())
        options = gateway.new_array(jvm.java.nio.file.OpenOption, 2)
        options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
        try:
            jvm.java.nio.file.Files.write(jvm.java.nio.file.Path.of(where.toUri().getPath(), gateway.new_array(jvm.java.lang.String, 0)), data, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise Conflict(path) from error
            raise
        return
    try:
        stream = fs.create(where, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception) or "already exists" in str(error.java_exception):
            raise Conflict(path) from error
        raise
    stream.write(data)
    stream.close()


def log(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, path) of all versions in order."""
    found = []
    for name in sorted(names(spark, f"{root}/_CURRENT") or []):
        if name.isdigit():
            found.append((int(name), name))
    return [(number, f"{root}/_CURRENT/{name}") for number, name in found]


def head(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(number, path) of the current version; None if none was ever written."""
    entries = log(spark, root)
    if not entries:
        if names(spark, f"{root}/_CURRENT") is None:
            return None
        raise ValueError(f"{root}/_CURRENT names no version")
    until = time.monotonic() + PATIENCE
    for number, entry in reversed(entries):
        while not (path := read_text(spark, entry)) and time.monotonic() < until:
            time.sleep(0.05)
        if path:
            return number, path
    raise ValueError(f"{root}/_CURRENT names no version")


def pointed_to(spark: SparkSession, root: str) -> str | None:
    found = head(spark, root)
    return found[1] if found else None


def next_number(spark: SparkSession, root: str) -> int:
    """The number that a writer who has read the current state would take."""
    entries = log(spark, root)
    return entries[-1][0] + 1 if entries else 1


def commit(spark: SparkSession, root: str, path: str, number: int) -> None:
    """Make ``path`` version ``number``; ``Conflict`` if another writer has it."""
    create(spark, f"{root}/_CURRENT/{number:020d}", path)


def point_to(spark: SparkSession, root: str, path: str) -> int:
    """Make ``path`` the current version, whatever the one before is."""
    while True:
        number = next_number(spark, root)
        try:
            commit(spark, root, path, number)
            return number
        except Conflict:
            continue


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def retire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete the data of all but the last ``keep`` versions; their entries stay.  Returns the paths deleted."""
    entries = log(spark, root)
    kept = {read_text(spark, entry) for _, entry in entries[-keep:]}
    gone = []
    for _, entry in entries[:-keep]:
        path = read_text(spark, entry)
        if path and path not in kept and path.startswith(f"{root}/") and names(spark, path) is not None:
            remove(spark, path)
            gone.append(path)
    return gone


class Journal:
    """What an unfinished run of a job has done, so that a new one goes on from there.

    Runs of one key are numbered.  A run that isn't finished is taken up again;
    after a finished one the next begins anew.  A step's record is written after
    its data, so a step that was cut off is done again.
    """

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark = spark
        base = f"{root}/{key}"
        runs = sorted(int(n) for n in names(spark, base) or [] if n.isdigit())
        self.resumed = bool(runs) and "finished" not in (names(spark, f"{base}/{runs[-1]}") or [])
        self.run = f"{key}-{runs[-1] if self.resumed else len(runs) + 1}"
        self.path = f"{base}/{runs[-1] if self.resumed else len(runs) + 1}"
        self._known = {n: json.loads(read_text(spark, f"{self.path}/{n}") or "null") for n in names(spark, self.path) or []}
        self.skipped: list[str] = []

    def done(self, step: str):
        """The record of a step that an earlier attempt of this run has done, or None."""
        return self._known.get(step)

    def record(self, step: str, value) -> None:
        path = f"{self.path}/{step}"
        if step in self._known:  # it no longer holds
            remove(self.spark, path)
        create(self.spark, path, json.dumps(value))
        self._known[step] = value

    def once(self, step: str, work, holds=lambda record: True):
        """The step's record: the earlier one, if there is one that ``holds``, else what ``work()`` returns."""
        record = self.done(step)
        if record is not None and holds(record):
            self.skipped.append(step)
            return record
        record = work()
        self.record(step, record)
        return record

    def finish(self) -> None:
        self.record("finished", True)
