"""Ordered passes over streams whose rows come in any order.

A row waits in its key's state until the watermark has passed its time; then the rows that
are due are taken in order of time and `order`, whichever trigger brought them.  A row that
comes after the watermark has passed its time isn't folded in: it is given out marked
`late`, so that no row is lost unseen.  Event-time timers wake a group of keys when its first
waiting row falls due, and when the state of a key has to end by itself.

What a key keeps are its waiting rows, at most as many as come within the watermark's delay,
and the few numbers of its fold.  Keys share the state of a group, told by their hash, so a
trigger costs calls, timers and batches by groups, not by keys and rows; a group's rows are
packed Arrow batches.  The state store has to be the RocksDB one
(`rocksdb_state`).  A stream's last rows wait for a watermark beyond them: sources
that end send a closing row of any key with a later time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Groups that keys share state in, and rows of a packed batch there.
GROUPS = 64
BLOB_ROWS = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started within keep their state in RocksDB, in no more partitions than there are cores, since a partition is a task with a worker and a store of its own at every trigger; the session's own settings come back after."""
    store, parts = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
    old = {name: spark.conf.get(name) for name in (store, parts)}
    spark.conf.set(store, ROCKSDB)
    spark.conf.set(parts, str(min(int(old[parts]), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


class ContactFold:
    """On after n rows of evidence, off after n without; off when no row has come for `hold_ms`.

    `take` gives the state of a row and the rows since it was turned on (0 while off);
    `until` says when a key ends by itself, `end` whether that turns it off.
    """

    def __init__(self, n: int, hold_ms: int):
        self.n, self.hold_ms = n, hold_ms

    #: on, length of the run of equal evidence, its value, rows since turned on, time of the last row
    start: tuple[bool, int, bool, int, int] = (False, 0, False, 0, -1)
    schema = T.StructType([T.StructField(n, t) for n, t in (("on", T.BooleanType()), ("run", T.IntegerType()), ("last", T.BooleanType()), ("dwell", T.IntegerType()), ("at", T.LongType()))])

    def take(self, memory: tuple, at: int, evidence: bool) -> tuple[tuple, tuple[bool, int]]:
        on, run, last, dwell, _ = memory
        run = run + 1 if run and last == evidence else 1
        on = evidence if run >= self.n else on
        dwell = dwell + 1 if on else 0
        return (on, run, evidence, dwell, at), (on, dwell)

    def until(self, memory: tuple) -> int | None:
        return memory[4] + self.hold_ms if memory[4] >= 0 else None

    def end(self, memory: tuple) -> bool:
        return bool(memory[0])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(blob))).read_all()


class _Ordered(StatefulProcessor):
    """Keeps a group's rows until they are due and folds them in order, key by key."""

    def __init__(self, fold: ContactFold, key: str, time: str, order: str, place: T.DataType):
        self.fold, self.key, self.time, self.order = fold, key, time, order
        kind = to_arrow_type(place)
        kind = pa.timestamp("us") if pa.types.is_timestamp(kind) else kind  # pandas has them without a zone
        self.row = pa.schema([("key", pa.string()), ("at", pa.int64()), ("place", kind), ("evidence", pa.bool_())])
        self.kept = pa.schema([("key", pa.string()), *((f.name, to_arrow_type(f.dataType)) for f in fold.schema)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.memory = handle.getValueState("memory", "keys binary")
        self.wake = handle.getValueState("wake", "at long")

    def close(self) -> None:
        pass

    def _wake_at(self, at: int | None, old: int | None) -> None:
        """One timer of a group counts, that of its `wake`; an older one that hasn't gone off yet is passed over then."""
        if at is None:
            self.wake.clear()
        elif at != old:
            self.wake.update((at,))
            self.handle.registerTimer(at)

    def _woken(self) -> int | None:
        return int(self.wake.get()[0]) if self.wake.exists() else None

    def _rows(self, key: list, at: list, place: list, state: list, dwell: list, what: list) -> pd.DataFrame:
        """Columns of rows: key as text, time in ms, order or None, state, dwell, what (row, late, ended)."""
        return pd.DataFrame({self.key: pd.Series(key, dtype=object), self.time: pd.to_datetime(pd.Series(at, dtype="int64"), unit="ms"), self.order: pd.Series(place, dtype=object), "state": pd.Series(state, dtype=object), "dwell": pd.Series(dwell, dtype=object), "what": pd.Series(what, dtype=object)})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark, first = timerValues.getCurrentWatermarkInMs(), None
        for pdf in rows:
            # by place: names that begin with an underscore don't arrive as they are
            names, place, evidence, at = (pdf.iloc[:, c] for c in (1, 2, 3, 4))
            come = pa.table([pa.Array.from_pandas(names, type=pa.string()), pa.Array.from_pandas(at, type=pa.int64()), pa.Array.from_pandas(place, type=self.row.field("place").type), pa.array([e is not None and e == e and bool(e) for e in evidence.tolist()], pa.bool_())], schema=self.row)
            fresh = come.filter(pc.field("at") > mark)
            if len(fresh):
                self.waiting.appendList([(_packed(fresh),)])
                least = pc.min(fresh["at"]).as_py()
                first = least if first is None else min(first, least)
            if len(fresh) < len(come):
                late = come.filter(pc.field("at") <= mark)
                yield self._rows(*(late[c].to_pylist() for c in ("key", "at", "place")), *([x] * len(late) for x in (None, None, "late")))
        if first is not None:
            old = self._woken()
            self._wake_at(first if old is None else min(first, old), old)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = self._woken()
        if old != expiredTimerInfo.getExpiryTimeInMs():
            return
        mark = timerValues.getCurrentWatermarkInMs()
        blobs = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        rows = pa.concat_tables([_unpacked(b) for b in blobs]) if blobs else self.row.empty_table()
        left, rows = rows.filter(pc.field("at") > mark), rows.filter(pc.field("at") <= mark)
        rows = rows.sort_by([(c, "ascending") for c in ("key", "at", "place", "evidence")])
        memory = {}
        if self.memory.exists():
            name, *parts = (c.to_pylist() for c in _unpacked(self.memory.get()[0]).columns)
            memory = dict(zip(name, zip(*parts, strict=True), strict=True))
        names, ats, places, evidences = (rows[c].to_pylist() for c in self.row.names)
        states, dwells, ended, take, until = [], [], [], self.fold.take, self.fold.until
        last, own = None, self.fold.start
        for name, at, evidence in zip(names, ats, evidences, strict=True):
            if name != last:
                if last is not None:
                    memory[last] = own
                last, own = name, memory.get(name, self.fold.start)
            end = until(own)
            if end is not None and end < at:
                own = self._end(own, name, end, ended)
            own, (on, dwell) = take(own, at, evidence)
            states.append(on)
            dwells.append(dwell)
        if last is not None:
            memory[last] = own
        wake = [pc.min(left["at"]).as_py()] if len(left) else []
        active = {}
        for name, own in memory.items():
            end = until(own)
            if end is not None and end <= mark:
                own, end = self._end(own, name, end, ended), None
            if own != self.fold.start:
                active[name] = own
            if end is not None:
                wake.append(end)
        if len(left) and len(rows):
            self.waiting.put([(_packed(pa.Table.from_batches([b])),) for b in left.combine_chunks().to_batches(max_chunksize=BLOB_ROWS)])
        elif not len(left):
            self.waiting.clear()
        if active:
            self.memory.update((_packed(pa.table([list(active), *map(list, zip(*active.values(), strict=True))], schema=self.kept)),))
        else:
            self.memory.clear()
        self._wake_at(min(wake, default=None), old)
        if names:
            yield self._rows(names, ats, places, states, dwells, ["row"] * len(names))
        if ended:
            name, at = zip(*ended, strict=True)
            yield self._rows(name, at, *([x] * len(ended) for x in (None, False, 0, "ended")))

    def _end(self, memory: tuple, name: str, at: int, ended: list) -> tuple:
        if self.fold.end(memory):
            ended.append((name, at))
        return self.fold.start


def ordered_contacts(df: DataFrame, key: str, time: str, order: str, evidence: str, delay: str, n: int = 3, hold_ms: int = 2_000, groups: int = GROUPS) -> DataFrame:
    """key, time, order, state, dwell, what of every row once the watermark (the latest time less `delay`) has passed it.

    what: `row`; `late`, without a state; or `ended`, without an order, where a contact ended
    since no row had come for `hold_ms`.  Times are taken to the millisecond; rows of one
    time are in order of `order`, which isn't null; rows without a time are dropped.  A key is
    text on its way; null is a key too.  `groups` bounds what a task holds: more of them for
    more rows within the delay.
    """
    kinds, schema = dict(df.dtypes), df.schema
    # the watermark stands on a copy of the time that the operator doesn't see: Spark would drop late rows before it
    rows = df.filter(F.col(time).isNotNull()).select(key, time, order, evidence).withColumn("_mark", F.col(time)).withWatermark("_mark", delay).drop("_mark")
    # a null in a batch would make pandas take long keys for doubles
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    rows = rows.select(F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group"), name.alias("_name"), order, evidence, F.unix_millis(time).alias("_ms"))
    out = f"{key} string, {time} timestamp, {order} {kinds[order]}, state boolean, dwell int, what string"
    got = rows.groupBy("_group").transformWithStateInPandas(_Ordered(ContactFold(n, hold_ms), key, time, order, schema[order].dataType), out, "Append", "EventTime")
    return got.withColumn(key, F.when(F.col(key) != "", F.substr(key, F.lit(2))).cast(kinds[key]))
