"""Curated tables in parts by key, of which a merge rewrites only those that it touches.

A table is a folder: ``data/<merge>/_part=<n>`` holds the part n as a merge has written it, and
the newest file of ``states`` says which merge wrote each part last. A merge reads the parts that
its keys fall into, writes them anew beside the old ones and adds a state last. So a merge that
fails, or loses an executor, leaves the table as it was, readers are never disturbed, and earlier
states stay readable until they are swept. The high-water mark of incremental loads is part of the
state; no scan looks for it.

A part is a share of the keys by hash, or what an expression over the rows names, such as the hour
in which something began; rows of one key must always be given the same name. Choose parts that
are small against the table and large against a task; a part beyond one task is written by several.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators import load
from berth.operators.profile import comparable, quoted
from berth.operators.runlog import latest
from berth.sources.pointers import Conflict, Pointers, names, remove

PART = "_part"


@dataclass(frozen=True)
class Merge:
    """What a merge did: the state it made and the parts it rewrote."""

    number: int
    parts: tuple[str, ...]


class PartTable:
    """A table below ``base``; ``create`` makes one."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.states = Pointers(spark, f"{self.base}/states")

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        base: str,
        layout: T.StructType | str,
        keys: Sequence[str],
        parts: int | str,
        load_column: str | None = None,
    ) -> PartTable:
        """An empty table of so many parts by hash, or of parts that an SQL expression names (of
        letters and digits). ``load_column`` is the one whose largest value is kept as the mark."""
        table = cls(spark, base)
        fields = T.StructType.fromDDL(layout) if isinstance(layout, str) else layout
        unknown = [c for c in [*keys, *([load_column] if load_column else [])] if c not in fields.names]
        if unknown or PART in fields.names or (isinstance(parts, int) and parts < 1):
            raise ValueError(f"no table of parts {parts} by {', '.join(keys)}: {unknown or PART}")
        state = {
            "layout": fields.json(),
            "keys": list(keys),
            "parts": parts,
            "load_column": load_column,
            "mark": None,
            "folders": {},
        }
        if table.states.numbers():
            raise ValueError(f"{base} holds a table already")
        table.states.write(state)
        return table

    def state(self, number: int | None = None) -> tuple[int, dict]:
        found = self.states.current() if number is None else (number, self.states.read(number))
        if not found or not found[1]:
            raise ValueError(f"{self.base} has no such state")
        return found

    def _rows(self, state: dict, parts: Sequence[str] | None = None) -> DataFrame:
        layout = T.StructType.fromJson(json.loads(state["layout"]))
        wanted = state["folders"] if parts is None else {p: state["folders"].get(p) for p in parts}
        paths = [f"{self.base}/data/{merge}/{PART}={p}" for p, merge in wanted.items() if merge]
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*paths)

    def read(self, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The table as it is, or as the state of that number has it; of some parts their files
        alone are read."""
        return self._rows(self.state(number)[1], parts)

    def parts(self) -> list[str]:
        """Names of the parts that have rows, in order."""
        return sorted(self.state()[1]["folders"])

    def keyed(self, values: dict[str, object], number: int | None = None) -> DataFrame:
        """The rows with these key values; of parts by hash only theirs is read."""
        _, state = self.state(number)
        layout = T.StructType.fromJson(json.loads(state["layout"]))
        found = self._rows(state)
        if not isinstance(state["parts"], str):
            row = self.spark.range(1).select(
                *(F.lit(values[k]).cast(layout[k].dataType).alias(k) for k in state["keys"])
            )
            found = self._rows(state, [row.select(_part_of(state)).first()[0]])
        for k in state["keys"]:
            found = found.filter(quoted(k) == F.lit(values[k]).cast(layout[k].dataType))
        return found

    def merge(
        self,
        incoming: DataFrame,
        newest: Sequence[str],
        keep: Sequence[str] = (),
        deleted: str | None = None,
    ) -> Merge:
        """Put the newest incoming row of each key in the place of the one that is there.

        ``keep`` names columns of which a row that is there already keeps its value; ``deleted``
        names a flag of the incoming rows: keys whose newest row has it leave the table. Rows with a NULL in their key are left
        out (``load.rows_without_key`` has them); columns that only the table has become NULL, and
        those that only the rows have are an error. A merge without rows changes nothing.
        """
        number, state = self.state()
        layout = T.StructType.fromJson(json.loads(state["layout"]))
        keys = state["keys"]
        given = [c for c in incoming.columns if c in layout.names]
        surplus = sorted({*incoming.columns} - {*given, *newest, deleted})
        if surplus:
            raise ValueError(f"the table has no {', '.join(surplus)}")
        typed = incoming.withColumns({k: quoted(k).cast(layout[k].dataType) for k in keys})
        gone = F.coalesce(quoted(deleted), F.lit(False)) if deleted else F.lit(False)
        hashed = [quoted(f.name) for f in typed.schema.fields if comparable(f.dataType)]
        marked = typed.filter(load._keyed(keys)).withColumns({"_gone": gone, "_tie": F.xxhash64(*hashed)})
        columns = [
            (quoted(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
        batch = latest(marked, keys, [*newest, "_tie"]).select(*columns, "_gone")
        if not state["folders"] and deleted is None:
            return self._fill(number, state, batch.drop("_gone"), layout)
        batch = load.write_snapshot(batch.withColumn(PART, _part_of(state)), label="batch")
        touched = sorted(r[0] for r in batch.select(PART).distinct().collect())
        if not touched:
            return Merge(number, ())

        old = self._rows(state, touched).withColumn(PART, _part_of(state))
        fresh = batch.filter(~F.col("_gone")).drop("_gone")
        if keep:
            known = old.select(*keys, F.lit(True).alias("_known"), *(quoted(c).alias(f"_old_{c}") for c in keep))
            fresh = fresh.join(known, keys, "left").select(
                *(
                    F.when(F.col("_known"), quoted(f"_old_{c}")).otherwise(quoted(c)).alias(c)
                    if c in keep
                    else quoted(c)
                    for c in layout.names
                ),
                PART,
            )
        rest = old.join(batch.select(*keys), keys, "left_anti").select(*fresh.columns)
        written = self._write(rest.unionByName(fresh))
        folders = {p: m for p, m in state["folders"].items() if p not in touched} | written
        mark = state["mark"]
        if state["load_column"]:
            mark = _larger(batch, state["load_column"], layout, mark)
        return Merge(self._swap(number, state | {"folders": folders, "mark": mark}), tuple(touched))

    def _fill(self, number: int, state: dict, rows: DataFrame, layout: T.StructType) -> Merge:
        """The first rows of a table: there are none to hold them against, so they are written once."""
        written = self._write(rows.withColumn(PART, _part_of(state)))
        if not written:
            return Merge(number, ())
        filled, mark = state | {"folders": written}, state["mark"]
        if state["load_column"]:
            mark = _larger(self._rows(filled), state["load_column"], layout, mark)
        return Merge(self._swap(number, filled | {"mark": mark}), tuple(sorted(written)))

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows to a folder of their own; the parts that have any, with the folder's name."""
        merge = uuid.uuid4().hex
        # A part is one file or, where it is large, several of a task's size.
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.base}/data/{merge}")
        found = names(self.spark, f"{self.base}/data/{merge}")
        return {n.partition("=")[2]: merge for n in found if "=" in n}

    def replace(self, rows: DataFrame, parts: Sequence[str], note: object = None) -> Merge:
        """Put ``rows``, which lie in ``parts``, in the place of all that these parts have; the
        note is kept in the state."""
        number, state = self.state()
        layout = T.StructType.fromJson(json.loads(state["layout"]))
        columns = [quoted(f.name).cast(f.dataType).alias(f.name) for f in layout.fields]
        written = self._write(rows.select(*columns).withColumn(PART, _part_of(state)))
        if not {*written} <= {*parts}:
            raise ValueError(f"rows beyond the parts: {', '.join(sorted({*written} - {*parts}))}")
        folders = {p: m for p, m in state["folders"].items() if p not in parts} | written
        return Merge(self._swap(number, state | {"folders": folders, "note": note}), tuple(parts))

    def _swap(self, number: int, state: dict) -> int:
        """Add the state that follows the one of that number."""
        # The file of a writer that failed in it takes a number of its own.
        following = max(self.states.numbers()) + 1
        if self.state()[0] != number:
            raise Conflict(f"{self.base} was changed meanwhile")
        self.states.claim(following, state)
        return following

    def load(
        self, source: DataFrame, inclusive: bool = False, updated_at: Column | None = None
    ) -> Merge:
        """Merge the source rows beyond the mark; with ``inclusive`` those at the mark again."""
        _, state = self.state()
        column = state["load_column"]
        if column is None:
            raise ValueError(f"{self.base} has no load column")
        layout = T.StructType.fromJson(json.loads(state["layout"]))
        fresh = load.newer_than(source, column, _literal(state["mark"], layout[column].dataType), inclusive)
        if updated_at is not None:
            fresh = fresh.withColumn("updated_at", updated_at)
        return self.merge(fresh, [column])

    def widen(self, layout: T.StructType) -> int:
        """Add the columns of a layout that the table does not have; they are NULL in its rows."""
        number, state = self.state()
        own = T.StructType.fromJson(json.loads(state["layout"]))
        fresh = [f for f in layout.fields if f.name not in own.names]
        if not fresh:
            return number
        wide = T.StructType([*own.fields, *(T.StructField(f.name, f.dataType) for f in fresh)])
        return self._swap(number, state | {"layout": wide.json()})

    def rebuild(self, parts: int | str) -> int:
        """Deal the whole table into other parts."""
        number, state = self.state()
        new = state | {"parts": parts}
        written = self._write(self.read(number).withColumn(PART, _part_of(new)))
        return self._swap(number, new | {"folders": written})

    def sweep(self, states: int = 1) -> list[str]:
        """Delete the folders that none of the newest states names, and older states; what a merge
        at work has written would go too, so none may run. Returns the folders' names."""
        numbers = self.states.numbers()
        kept = [s for n in numbers[-states:] if (s := self.states.read(n))]
        named = {m for s in kept for m in s["folders"].values()}
        gone = [m for m in names(self.spark, f"{self.base}/data") if m not in named]
        for number in numbers[:-states]:
            remove(self.spark, self.states._path(number))
        for merge in gone:
            remove(self.spark, f"{self.base}/data/{merge}")
        return gone


def _part_of(state: dict) -> Column:
    if isinstance(state["parts"], str):
        return F.coalesce(F.expr(state["parts"]).cast("string"), F.lit("none")).alias(PART)
    hashed = F.xxhash64(*(quoted(k) for k in state["keys"]))
    return F.pmod(hashed, F.lit(state["parts"])).cast("string").alias(PART)


def _literal(mark: str | int | None, dtype: T.DataType) -> Column | None:
    if mark is None:
        return None
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(mark))
    return F.lit(mark).cast(dtype)


def _larger(batch: DataFrame, column: str, layout: T.StructType, mark: str | int | None):
    """The larger of the mark and what the batch has; an instant as microseconds, all else as text."""
    dtype = layout[column].dataType
    known = _literal(mark, dtype)
    value = F.max(quoted(column))
    value = value if known is None else F.greatest(value, known)
    as_kept = F.unix_micros(value) if isinstance(dtype, T.TimestampType) else value.cast("string")
    found = batch.agg(as_kept).first()[0]
    return mark if found is None else found
