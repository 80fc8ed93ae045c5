"""Change logs of streams, merged in levels while the streams go on.

A log is a folder. ``batches/<stream>/<number>`` holds what a stream wrote in a batch; a stream is
named by the id in its checkpoint, so a new checkpoint adds folders and replaces none, and a batch
that comes again replaces itself. ``merged/<id>`` holds the newest row per key of several batches
or merged folders. The newest file of ``states`` lists the streams in the order in which they
began and says which batches each merged folder holds: what no merged folder holds is read from
its own folder, so a batch that lands while others are merged is never lost or read twice.

The newest row of a key is the largest by the given columns, then by stream and batch. Deletes are
rows with a flag; merging keeps them, as an older version may still be on its way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators.profile import comparable, quoted
from berth.operators.runlog import latest
from berth.sources.pointers import Pointers, names, remove
from berth.streaming.streams import each_batch

STREAM, BATCH = "_stream", "_batch"
#: So many folders of a level become one of the next.
FAN = 4

_EMPTY = {"streams": [], "merged": []}


class ChangeLog:
    """The change log below ``base`` of rows of a layout, by key."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        layout: T.StructType | str,
        keys: Sequence[str],
        newest: Sequence[str],
        deleted: str | None = None,
    ):
        self.spark = spark
        self.base = base.rstrip("/")
        self.layout = T.StructType.fromDDL(layout) if isinstance(layout, str) else layout
        self.keys, self.newest, self.deleted = list(keys), list(newest), deleted
        self.states = Pointers(spark, f"{self.base}/states")

    def _state(self) -> dict:
        found = self.states.current()
        return found[1] if found else _EMPTY

    def follow(self, stream: DataFrame, checkpoint: str) -> None:
        """Run a stream into the log until its input is used up."""
        own: list[str] = []

        def write(batch: DataFrame, number: int) -> None:
            if not own:
                own.append(_stream_id(self.spark, checkpoint))
                self._register(own[0])
            columns = [quoted(f.name).cast(f.dataType).alias(f.name) for f in self.layout.fields]
            batch.select(*columns).write.mode("overwrite").parquet(f"{self.base}/batches/{own[0]}/{number}")

        each_batch(stream, write, checkpoint)

    def _register(self, stream: str) -> None:
        if stream not in self._state()["streams"]:
            self.states.update(
                lambda s: (s or _EMPTY) | {"streams": list(dict.fromkeys([*(s or _EMPTY)["streams"], stream]))}
            )

    def loose(self) -> dict[str, list[int]]:
        """Whole batches of each stream that no merged folder holds."""
        state, found = self._state(), {}
        for stream in state["streams"]:
            held = [tuple(r) for m in state["merged"] for r in m["holds"].get(stream, [])]
            numbers = sorted(int(n) for n in names(self.spark, f"{self.base}/batches/{stream}") if n.isdigit())
            found[stream] = [
                n
                for n in numbers
                if not any(a <= n <= b for a, b in held)
                and "_SUCCESS" in names(self.spark, f"{self.base}/batches/{stream}/{n}")
            ]
        return found

    def _batches(self, loose: dict[str, list[int]], state: dict) -> Iterator[DataFrame]:
        for place, stream in enumerate(state["streams"]):
            paths = [f"{self.base}/batches/{stream}/{n}" for n in loose.get(stream, [])]
            if paths:
                rows = self.spark.read.schema(self.layout).parquet(*paths)
                number = F.regexp_extract("_metadata.file_path", r"/batches/[^/]+/(\d+)/", 1)
                yield rows.select(
                    "*", F.lit(place).alias(STREAM), number.cast("long").alias(BATCH)
                )

    def _merged(self, folders: Sequence[str]) -> Iterator[DataFrame]:
        if folders:
            layout = T.StructType([*self.layout.fields]).add(STREAM, "integer").add(BATCH, "long")
            yield self.spark.read.schema(layout).parquet(*(f"{self.base}/merged/{m}" for m in folders))

    def _newest(self, frames: list[DataFrame]) -> DataFrame:
        rows = frames[0]
        for more in frames[1:]:
            rows = rows.unionByName(more)
        hashed = [quoted(f.name) for f in self.layout.fields if comparable(f.dataType)]
        marked = rows.withColumn("_tie", F.xxhash64(*hashed))
        return latest(marked, self.keys, [*self.newest, STREAM, BATCH, "_tie"]).drop("_tie")

    def current(self) -> DataFrame:
        """The newest row of each key, deleted keys left out."""
        state = self._state()
        frames = [*self._batches(self.loose(), state), *self._merged([m["folder"] for m in state["merged"]])]
        if not frames:
            return self.spark.createDataFrame([], self.layout)
        rows = self._newest(frames).drop(STREAM, BATCH)
        return rows.filter(~_flag(self.deleted)) if self.deleted else rows

    def compact(self, fan: int = FAN) -> int:
        """Merge what has come together on each level, from the batches up; how many merges it
        took. Streams may run meanwhile, but no other compaction."""
        merges = 0
        loose = self.loose()
        if sum(map(len, loose.values())) >= fan:
            state = self._state()
            self._merge(list(self._batches(loose, state)), 1, [], _ranges(loose))
            merges += 1
        level = 1
        while True:
            state = self._state()
            own = [m for m in state["merged"] if m["level"] == level]
            if len(own) >= fan:
                holds = {}
                for m in own:
                    for stream, ranges in m["holds"].items():
                        holds[stream] = _joined([*holds.get(stream, []), *ranges])
                folders = [m["folder"] for m in own]
                self._merge(list(self._merged(folders)), level + 1, folders, holds)
                merges += 1
            elif not any(m["level"] > level for m in state["merged"]):
                return merges
            level += 1

    def _merge(self, frames: list[DataFrame], level: int, instead_of: list[str], holds: dict) -> None:
        folder = uuid.uuid4().hex
        self._newest(frames).write.parquet(f"{self.base}/merged/{folder}")
        entry = {"folder": folder, "level": level, "holds": holds}

        def swapped(state: dict | None) -> dict:
            kept = [m for m in state["merged"] if m["folder"] not in instead_of]
            return state | {"merged": [*kept, entry]}

        self.states.update(swapped)

    def sweep(self) -> list[str]:
        """Delete the batches that merged folders hold, merged folders that later ones replaced,
        and older states. Readers of these must be done. Returns the folders' names."""
        state, gone = self._state(), []
        loose = self.loose()
        for stream in state["streams"]:
            for name in names(self.spark, f"{self.base}/batches/{stream}"):
                whole = "_SUCCESS" in names(self.spark, f"{self.base}/batches/{stream}/{name}")
                if name.isdigit() and whole and int(name) not in loose[stream]:
                    gone.append(f"batches/{stream}/{name}")
        used = {m["folder"] for m in state["merged"]}
        gone += [f"merged/{m}" for m in names(self.spark, f"{self.base}/merged") if m not in used]
        gone += [f"states/{n}" for n in names(self.spark, f"{self.base}/states")[:-1]]
        for name in gone:
            remove(self.spark, f"{self.base}/{name}")
        return gone


def _flag(name: str) -> Column:
    return F.coalesce(quoted(name), F.lit(False))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint for good."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads(lines[0][0])["id"]


def _joined(ranges: list) -> list:
    """Ranges (first, last) with those that touch put together."""
    out: list[list[int]] = []
    for first, last in sorted(map(tuple, ranges)):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _ranges(loose: dict[str, list[int]]) -> dict[str, list]:
    return {s: _joined([(n, n) for n in numbers]) for s, numbers in loose.items() if numbers}
