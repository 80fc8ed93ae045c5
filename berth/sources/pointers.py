"""Small numbered files that say which folders make up a table, written last.

A state is one JSON file; the highest number that was written whole is the current state. A file
is created only if its number is free, so of two writers one fails and begins anew. All access
goes through Hadoop's file systems, so a pointer may lie wherever tables lie.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_NAME = re.compile(r"state-(\d{12})\.json")
_END = "\n"


class Conflict(RuntimeError):
    """Another writer was faster."""


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; none for a folder that is not there."""
    fs, where = _located(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.delete(where, True)


@dataclass(frozen=True)
class Pointers:
    """The states of one table."""

    spark: SparkSession
    folder: str

    def _path(self, number: int) -> str:
        return f"{self.folder}/state-{number:012d}.json"

    def numbers(self) -> list[int]:
        found = (_NAME.fullmatch(n) for n in names(self.spark, self.folder))
        return [int(m.group(1)) for m in found if m]

    def read(self, number: int) -> dict | None:
        """A state, or None for a file that its writer did not finish."""
        text = "".join(r[0] for r in self.spark.read.text(self._path(number), wholetext=True).collect())
        return json.loads(text) if text.endswith(_END) else None

    def current(self) -> tuple[int, dict] | None:
        for number in reversed(self.numbers()):
            state = self.read(number)
            if state is not None:
                return number, state
        return None

    def write(self, state: dict) -> int:
        """Add a state behind all others; ``Conflict`` if another writer takes the number first."""
        number = max(self.numbers(), default=-1) + 1
        self.claim(number, state)
        return number

    def claim(self, number: int, state: dict) -> None:
        fs, where = _located(self.spark, self._path(number))
        try:
            out = fs.create(where, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(self._path(number)) from error
            raise
        out.write(bytearray((json.dumps(state) + _END).encode()))
        out.close()

    def update(self, change: Callable[[dict | None], dict]) -> int:
        """Apply a change to the newest state, again and again if others write meanwhile. The
        change must hold for whatever state it is given."""
        while True:
            taken = max(self.numbers(), default=-1)
            found = self.current()
            try:
                self.claim(taken + 1, change(found[1] if found else None))
                return taken + 1
            except Conflict:
                continue
