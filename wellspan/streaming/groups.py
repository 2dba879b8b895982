"""Streams of manifests: early emission of sized groups, incremental dedupe, resumable runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

if TYPE_CHECKING:
    import pandas as pd


def sized_groups(stream: DataFrame, key: str, size: str, member: str) -> DataFrame:
    """(key, members): a group is emitted as soon as ``size`` distinct members have come.

    ``size`` is a column of every row, so no stage waits for the others.  Members are joined
    in order by commas; members that come again, before or after the group is out, change
    nothing.  State is one group's members, then only the mark that it is out.
    """
    kinds = dict(stream.dtypes)

    def collect(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, out = (list(state.get[0]), state.get[1]) if state.exists else ([], False)
        members, expected = set(held), None
        for pdf in batches:
            members.update(pdf[member].astype(str))
            expected = int(pdf[size].iloc[0]) if len(pdf) else expected
        if not out and expected is not None and len(members) >= expected:
            state.update(([], True))
            import pandas as pd

            yield pd.DataFrame({key: [keys[0]], "members": [",".join(sorted(members))]})
        elif not out:
            state.update((sorted(members), False))

    return stream.groupBy(key).applyInPandasWithState(collect, f"{key} {kinds[key]}, members string", "held array<string>, out boolean", "append", GroupStateTimeout.NoTimeout)


#: Keys of timed groups share this many states: see ``_Timed``.
STATES = 1024


class _Timed(StatefulProcessor):
    """Groups until their members are enough or their time is over, then a mark for as long again.

    Every call of the state is a message to the JVM, and every key a small frame, which took
    some 20 ms a key; so keys share states by hash, and a state is read and written once a
    batch.  Its one timer is for the group that is due next.
    """

    def __init__(self, key: str, kind: str, size: str, member: str, wait: int):
        self.key, self.kind, self.size, self.member, self.wait = key, kind, size, member, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.groups = handle.getListState("groups", f"name {self.kind}, size int, deadline long, out boolean, members array<string>")

    def _read(self) -> dict:
        return {name: (size, deadline, out, set(members)) for name, size, deadline, out, members in self.groups.get()}

    def _write(self, held: dict) -> None:
        if held:
            self.groups.put([(name, size, deadline, out, sorted(members)) for name, (size, deadline, out, members) in held.items()])
        else:
            self.groups.clear()

    def _due(self, held: dict) -> int | None:
        return min((deadline + self.wait * out for _, deadline, out, _ in held.values()), default=None)

    def _expired(self, held: dict, now: int) -> list[tuple]:
        """What is over by ``now``, in place: groups not complete, to be emitted, and marks to be forgotten."""
        done = []
        for name, (size, deadline, out, members) in list(held.items()):
            if now >= deadline and not out:
                done.append(self._row(name, size, members, False))
                held[name] = (size, deadline, True, set())
            if now >= deadline + self.wait:
                del held[name]
        return done

    def _row(self, name: object, size: int, members: set[str], complete: bool) -> tuple:
        return name, ",".join(sorted(members)), len(members), size, complete

    def _emitted(self, done: list[tuple]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        if done:
            yield pd.DataFrame(done, columns=[self.key, "members", "n_members", "size", "complete"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = self._read()
        before, done = self._due(held), self._expired(held, timerValues.getCurrentWatermarkInMs())  # rows of a batch come before its timers
        came: dict = {}
        for pdf in rows:
            least = pdf.groupby(self.key, sort=False).agg({"at_": "min", self.size: "max"})
            for name, at, size in zip(least.index.tolist(), least["at_"].tolist(), least[self.size].tolist(), strict=True):
                first, most, members = came.get(name, (at, 0, set()))
                came[name] = min(first, at), max(most, int(size)), members
            pairs = pdf[[self.key, self.member]].dropna().drop_duplicates()
            for name, member in zip(pairs[self.key].tolist(), pairs[self.member].tolist(), strict=True):
                came[name][2].add(member)
        for name, (first, most, new) in came.items():
            size, deadline, out, members = held.get(name, (0, first + self.wait, False, set()))
            size = max(size, most)
            if not out:
                members |= new
                if len(members) >= size:
                    done.append(self._row(name, size, members, True))
                    out, members = True, set()
            held[name] = (size, deadline, out, members)
        self._write(held)
        due = self._due(held)
        if due is not None and due != before:
            self.handle.registerTimer(due)
        yield from self._emitted(done)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = self._read()
        before, n = self._due(held), len(held)
        done = self._expired(held, timerValues.getCurrentWatermarkInMs())
        if done or len(held) < n:
            self._write(held)
        due = self._due(held)
        if due is not None and due != before:  # else this was a timer of a group that has gone
            self.handle.registerTimer(due)
        yield from self._emitted(done)

    def close(self) -> None:
        pass


def timed_groups(stream: DataFrame, key: str, size: str, member: str, ts: str, wait: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(key, members, n_members, size, complete): sized groups, and those that never fill up.

    A group goes out as soon as ``size`` distinct members have come, or, marked as not
    complete, when the stream's time (the latest ``ts`` less ``late``) passes ``wait`` after
    the earliest ``ts`` of its first batch.  Members that come later change nothing for as
    long again; after that the key is forgotten, so state is bounded by what two waits
    bring.  Rows older than the stream's time are dropped before they get here; rows with a
    null key or time are no members.  A group in a state holds fewer than ``size`` members,
    and a state's groups are read together.  Needs the RocksDB state store, which ``timed``
    sets.
    """
    millis = round(seconds(wait) * 1000)
    kinds = dict(stream.dtypes)
    sound = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, F.col(size).cast("int").alias(size), F.col(member).cast("string").alias(member), F.col(ts).cast("timestamp").alias(ts))
    return (
        sound.withColumns({"at_": F.unix_millis(ts), "state_": F.pmod(F.xxhash64(key), F.lit(STATES))})
        .withWatermark(ts, late)
        .groupBy("state_")
        .transformWithStateInPandas(_Timed(key, kinds[key], size, member, millis), f"{key} {kinds[key]}, members string, n_members int, size int, complete boolean", "append", "eventTime")
    )


def seconds(text: str) -> float:
    """Seconds of an interval such as ``2 hours``."""
    import pandas as pd

    return pd.Timedelta(text).total_seconds()


@contextmanager
def timed(spark: SparkSession) -> Iterator[None]:
    """The state store that timers and map states need, for streams started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def first_seen(stream: DataFrame, on: list[str], ts: str | None = None, late: str = "1 hour") -> DataFrame:
    """Each key once.  With an event time, keys are forgotten after ``late``: bounded state."""
    if ts is None:
        return stream.dropDuplicates(on)
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(on)


def available_now(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run over what is there and stop; a rerun with the same checkpoint takes up new files only."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to a writer keyed by its number, so that one written twice is there once."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
