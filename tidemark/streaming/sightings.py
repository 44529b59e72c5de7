"""The most complete sighting of every key in an event feed, with one state per key and no window.

A feed repeats each thing (a pod, an hourly snapshot line) many times; the wanted row is the one that has its end. The key is
the thing itself, say (id, start), so sightings on both sides of midnight are one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.latest import latest

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Rows that are looked at together for what a key sends: the usual size of an Arrow batch.
COMBINED_ROWS = 10_000


def _combined(stream: DataFrame, keys: Sequence[str], rank: Sequence[str], complete: str, last: bool) -> DataFrame:
    """`stream` with `sightings`, at most one row per key and COMBINED_ROWS rows: what a hot key sends through the shuffle. Smaller
    Arrow batches, as a session may be set to, are put together."""
    schema = T.StructType([*stream.schema.fields, T.StructField("sightings", T.LongType())])
    direction = "ascending" if last else "descending"

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= COMBINED_ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches):
            made = rows.append_column("_whole", pc.is_valid(rows[complete]))
            order = pc.sort_indices(
                made, [("_whole", "ascending"), *((c, direction) for c in rank)], null_placement="at_start" if last else "at_end"
            )
            rows = rows.take(order)
            place = rows.select(list(keys)).append_column("_at", pa.array(range(rows.num_rows), pa.int64()))
            held = place.group_by(list(keys)).aggregate([("_at", "max"), ("_at", "count")])
            yield from rows.take(held["_at_max"]).append_column("sightings", held["_at_count"].cast(pa.int64())).to_batches()

    return stream.mapInArrow(best, schema)


class _BestSighting(StatefulProcessor):
    """State of one key: its best sighting, how many there were, and the timer that lets go of it."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str], rank: Sequence[str], complete: str, last: bool, keep_ms: int,
                 state: T.StructType):
        self.keys, self.columns, self.rank, self.complete, self.last = list(keys), list(columns), list(rank), complete, last
        self.keep_ms, self.schema = keep_ms, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("sighting", self.schema)

    def close(self) -> None:
        pass

    def better(self, one: dict, two: dict) -> bool:
        """Whether `one` goes before `two`: whole sightings first, then by the rank columns; a null counts as least complete."""
        if (one[self.complete] is None) != (two[self.complete] is None):
            return one[self.complete] is not None
        for c in self.rank:
            a, b = one[c], two[c]
            if a != b:
                return b is None if a is None or b is None else (a > b) == self.last
        return False

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802 (name of the interface)
        held = self.held.get() if self.held.exists() else None
        best = dict(zip(self.columns, held[: len(self.columns)], strict=True)) if held is not None else None
        seen, opened, timer = held[len(self.columns) :] if held is not None else (0, None, None)
        newest = timer - self.keep_ms if timer is not None else None
        for row in rows:
            new = {c: row[c] for c in self.columns}
            at = row["_arrived"]
            opened = at if opened is None else opened
            newest = at if newest is None else max(newest, at)
            seen += row["sightings"]
            if best is None or self.better(new, best):
                best = new
        if timer is not None and timer != newest + self.keep_ms:
            self.handle.deleteTimer(timer)
        if timer != newest + self.keep_ms:
            self.handle.registerTimer(newest + self.keep_ms)
        self.held.update((*best.values(), seen, opened, newest + self.keep_ms))
        yield self.made(key, tuple(best.values()), seen, opened, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        held = self.held.get()
        n = len(self.columns)
        yield self.made(key, tuple(held[:n]), held[n], held[n + 1], True)
        self.held.clear()

    def made(self, key, best: tuple, seen: int, opened: int, final: bool) -> Row:
        return Row(*self.keys, *self.columns, "sightings", "opened", "final")(*key, *best, seen, opened, final)


def best_sightings(
    stream: DataFrame, keys: Sequence[str], event_time: str, complete: str, arrival: str, tie: Sequence[str] = (), last: bool = True,
    keep: str = "1 day", lateness: str = "0 seconds",
) -> DataFrame:
    """Per changed key its best sighting so far: (keys, other columns, sightings, opened, final).

    One that has `complete` goes first; among equals the newest by `event_time` and `tie`, or the oldest with `last=False`.
    `arrival` is the clock of the stream: the time a row came in, which never runs backwards by more than `lateness`, such as the
    modification time of its file. A key that has had no row for `keep` is handed out once more as `final` and its state
    dropped. A row that comes later still opens the key anew under another `opened`; nothing is dropped, and
    :func:`read_sightings` counts such returns.
    """
    rank = [event_time, *tie]
    # timestamps pass through the state as microseconds, which mean the same in every Python worker
    stamps = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType) and f.name not in (*keys, arrival)]
    stream = stream.withColumns({"_arrived": F.unix_millis(arrival), **{c: F.unix_micros(c) for c in stamps}})
    rest = [c for c in stream.columns if c not in (*keys, arrival, "_arrived")]
    fields = {f.name: f.dataType for f in stream.schema.fields}
    own = [T.StructField(c, fields[c]) for c in rest]
    counts = [T.StructField("sightings", T.LongType()), T.StructField("opened", T.LongType())]
    state = T.StructType([*own, *counts, T.StructField("timer", T.LongType())])
    out = T.StructType([*(T.StructField(k, fields[k]) for k in keys), *own, *counts, T.StructField("final", T.BooleanType())])
    processor = _BestSighting(keys, rest, rank, complete, last, milliseconds(stream.sparkSession, keep), state)
    combined = _combined(stream, keys, rank, complete, last).withWatermark(arrival, lateness)
    made = combined.groupBy(*keys).transformWithState(processor, out, outputMode="Update", timeMode="EventTime")
    return made.withColumns({c: F.timestamp_micros(c) for c in stamps})


def milliseconds(spark: SparkSession, interval: str) -> int:
    """Length of an interval of days and smaller units, such as `2 hours`."""
    ends = spark.range(1).select(
        F.unix_millis(F.expr(f"timestamp_millis(0) + INTERVAL {interval}")).alias("ms")
    )
    return ends.first()["ms"]


def run_sightings(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the changed keys of each micro-batch under its number, so that a repeated batch replaces itself.

    The state lies in RocksDB and is uploaded to `checkpoint`, from where another executor takes it up."""
    conf = df.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKS_DB)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    try:
        writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        if before is None:
            conf.unset(STATE_STORE)
        else:
            conf.set(STATE_STORE, before)


def read_sightings(
    spark: SparkSession, path: str, keys: Sequence[str], event_time: str, complete: str, tie: Sequence[str] = (), last: bool = True
) -> DataFrame:
    """(keys, other columns, sightings, returns): one row per key whatever the states that were dropped in between.

    Newest version of each opening of a key, then the best over its openings; `returns` counts sightings that came after the
    state was dropped, that is those of all openings but the first."""
    written = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    newest = latest(written, [*keys, "opened"], "batch", ["sightings"])
    whole = F.col(complete).isNotNull()
    row = F.struct(*[c for c in written.columns if c not in (*keys, "batch", "opened", "final", "sightings")])
    if last:
        best = F.max_by(row, F.struct(whole, event_time, *tie))
    else:
        best = F.min_by(row, F.struct(~whole, event_time, *tie))
    merged = newest.groupBy(*keys).agg(
        best.alias("_r"), F.sum("sightings").alias("sightings"), F.min_by("sightings", "opened").alias("_first"),
    )
    return merged.select(*keys, "_r.*", "sightings", (F.col("sightings") - F.col("_first")).alias("returns"))
