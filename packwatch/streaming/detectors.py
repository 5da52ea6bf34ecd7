"""Session, last-n and pattern detectors on the keyed state of Structured Streaming.

What is open of a vehicle lies in the engine's state store (RocksDB, one state per vehicle), so a
micro-batch touches the state of its own vehicles only. Output goes to the engine's file sink, which writes each
batch once; a restart goes on from the checkpoint. Detectors take typed frames (``vin, msg_us, frame_id,
soc_pct`` and the columns of the flags); rows without a vehicle or a time are left out. If the stream comes from
``readers.frame_messages``, messages that are broken go to the same sink in the same batch, see :func:`dead_letters`.

How much a micro-batch takes in is an option of the source (``maxFilesPerTrigger``, ``maxBytesPerTrigger``,
``maxOffsetsPerTrigger``). ``trigger`` takes the arguments of ``DataStreamWriter.trigger``, e.g.
``{"processingTime": "1 second"}``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from packwatch.operators.sessions import followed_by
from packwatch.schemas import NUMBER, TEXT, WHOLE, struct
from packwatch.session import work_folder

FLAG = T.BooleanType()
SESSION = struct(vin=TEXT, start_us=WHOLE, end_us=WHOLE, start_soc=NUMBER, end_soc=NUMBER)
OPEN = T.StructType(SESSION.fields[1:])
MEMBER = struct(start_us=WHOLE, end_us=WHOLE)
EMISSION = struct(vin=TEXT, start_us=WHOLE, recent=T.ArrayType(MEMBER))
MATCH = struct(vin=TEXT, msg_us=WHOLE, next_at=WHOLE)
PENDING = struct(msg_us=WHOLE, frame_id=WHOLE, first=FLAG, then=FLAG)
#: All rows of a vehicle that wait, as one value: each call of the state store costs a round trip.
WAITING = struct(rows=T.ArrayType(PENDING))
LETTER = struct(value=TEXT)

ONCE = {"availableNow": True}
CHAINED = "spark.sql.streaming.statefulOperator.allowMultiple"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- processors: what happens to one vehicle ---


def least(a, b):
    return b if a is None else a if b is None else min(a, b)


def greatest(a, b):
    return b if a is None else a if b is None else max(a, b)


def advanced(frames: Iterable[tuple], still_open: Row | None) -> tuple[list[tuple], tuple | None]:
    """Sessions that frames (time, on, tie, soc) close, and the one that stays open.

    The open session takes its place among the frames by its start. Of frames of the same instant those
    that are off come first.
    """
    steps = [(t, on, tie, t, soc, soc) for t, on, tie, soc in frames]
    if still_open is not None:
        start, end, low, high = still_open
        steps.append((start, True, -1, end, low, high))
    closed, now = [], None
    for t, on, _, until, low, high in sorted(steps, key=lambda s: s[:3]):
        if on and now is None:
            now = (t, until, low, high)
        elif on:
            now = (now[0], max(now[1], until), least(now[2], low), greatest(now[3], high))
        elif now is not None:
            closed.append(now)
            now = None
    return closed, now


def packed(*columns: str) -> Column:
    """One text of the columns, parted by spaces, as a row's way to Python costs by its columns; see unpacked()."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])


def unpacked(text: str, *kinds) -> tuple:
    return tuple([None if part == "-" else kind(part) for kind, part in zip(kinds, text.split(" "), strict=True)])


def is_true(text: str) -> bool:
    return text == "true"


class SessionProcessor(StatefulProcessor):
    """Closes sessions; with ``silence_us`` also those whose vehicle has sent nothing for so long."""

    def __init__(self, silence_us: int | None = None):
        self.silence_us = silence_us

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.open.get()
        closed, now = advanced((unpacked(r.row, int, is_true, int, float) for r in rows), before)
        self.keep(now, before)
        yield from self.emitted(key[0], closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.open.get()
        if now is not None and self.deadline(now) <= expiredTimerInfo.getExpiryTimeInMs():
            self.open.clear()
            yield from self.emitted(key[0], [tuple(now)])

    def keep(self, now: tuple | None, before: Row | None) -> None:
        if self.silence_us is not None:
            if before is not None:
                self.handle.deleteTimer(self.deadline(before))
            if now is not None:
                self.handle.registerTimer(self.deadline(now))
        if now is not None:
            self.open.update(now)
        elif before is not None:
            self.open.clear()

    def deadline(self, session: tuple) -> int:
        return -(-(session[1] + self.silence_us) // 1000)

    def emitted(self, vin: str, closed: list[tuple]) -> Iterator[Row]:
        for session in closed:
            yield Row(**dict(zip(SESSION.names, (vin, *session), strict=True)))

    def close(self) -> None:
        pass


class LastNProcessor(SessionProcessor):
    """Closes sessions and keeps the latest n - 1 that cross ``level`` percent."""

    def __init__(self, n: int, level: float, silence_us: int | None = None):
        super().__init__(silence_us)
        self.n, self.level = n, level

    def init(self, handle) -> None:
        super().init(handle)
        self.latest = handle.getListState("latest", MEMBER)

    def emitted(self, vin: str, closed: list[tuple]) -> Iterator[Row]:
        level = self.level
        fresh = [(s[0], s[1], True) for s in closed if s[2] is not None and s[2] < level and s[3] >= level]
        if not fresh:
            return
        known = [(start, end, False) for start, end in self.latest.get()]
        both = sorted(known + fresh)
        for at, (start, _, is_fresh) in enumerate(both):
            if is_fresh and at + 1 >= self.n:
                members = both[at + 1 - self.n : at + 1]
                yield Row(vin=vin, start_us=start, recent=[Row(start_us=a, end_us=b) for a, b, _ in members])
        if self.n > 1:
            self.latest.put([s[:2] for s in both[1 - self.n :]])


class PatternProcessor(StatefulProcessor):
    """Matches a row with its very next one, once the watermark has passed that one.

    Rows wait in the state until then; a timer takes up those of a vehicle that falls silent.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = [unpacked(r.row, int, int, is_true, is_true) for r in rows]
        self.handle.registerTimer(-(-max(r[0] for r in fresh) // 1000))
        yield from self.settled(key[0], fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.settled(key[0], [], timerValues)

    def settled(self, vin: str, fresh: list[tuple], timers) -> Iterator[Row]:
        before = self.pending.get()
        known = [tuple(r) for r in before[0]] if before else []
        rows = sorted(known + fresh, key=lambda r: r[:2])
        passed = timers.getCurrentWatermarkInMs() * 1000
        final = sum(r[0] <= passed for r in rows)
        for a, b in zip(rows[:final], rows[1:final], strict=False):
            if a[2] and b[3]:
                yield Row(vin=vin, msg_us=a[0], next_at=b[0])
        # the newest final row may still meet its next one
        left = rows[max(final - 1, 0) :]
        if left != known:
            self.pending.update((left,))

    def close(self) -> None:
        pass


# --- queries ---


def usable(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("vin").isNotNull() & F.col("msg_us").isNotNull())


def with_letters(found: DataFrame, stream: DataFrame) -> DataFrame:
    """The detector's rows under ``found`` and the broken messages of the stream under ``letter``."""
    rows = found.select(F.struct(*found.columns).alias("found"), F.lit(None).cast("string").alias("letter"))
    if "broken" not in stream.columns:
        return rows
    letters = stream.where("broken").select(F.lit(None).cast(rows.schema["found"].dataType).alias("found"), F.col("message").alias("letter"))
    return rows.unionByName(letters)


def detect(
    stream: DataFrame,
    rows: DataFrame,
    processor: StatefulProcessor,
    output: T.StructType,
    folder: str,
    trigger: dict,
    event_time: bool,
    chained: bool = False,
) -> StreamingQuery:
    """Start a detector below ``folder``: its checkpoint, and the table that it fills."""
    conf = stream.sparkSession.conf
    conf.set(STORE, ROCKSDB)
    # alone, a keyed operator drops what is behind the watermark at once; behind another one, a batch later
    conf.set(CHAINED, str(chained).lower())
    found = rows.groupBy("vin").transformWithState(processor, output, "Append", "EventTime" if event_time else "None")
    return (
        with_letters(found, stream)
        .writeStream.format("parquet")
        .option("path", os.path.join(folder, "found"))
        .option("checkpointLocation", checkpoint(folder))
        .trigger(**trigger)
        .start()
    )


def checkpoint(folder: str) -> str:
    return os.path.join(folder, "checkpoint")


def detected(spark: SparkSession, folder: str, output: T.StructType) -> DataFrame:
    """What a detector has found so far; nothing before its first batch."""
    whole = T.StructType().add("found", output).add("letter", TEXT)
    try:
        return spark.read.schema(whole).parquet(os.path.join(folder, "found"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def found_rows(spark: SparkSession, folder: str, output: T.StructType) -> DataFrame:
    return detected(spark, folder, output).where("found IS NOT NULL").select("found.*")


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Broken messages that a detector has met, as they came."""
    return detected(spark, folder, SESSION).where("letter IS NOT NULL").select(F.col("letter").alias("value"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has dropped behind its watermark, over the progress that it still holds."""
    operators = chain.from_iterable(p.stateOperators for p in query.recentProgress)
    return sum(o.numRowsDroppedByWatermark for o in operators)


def session_input(stream: DataFrame, on: Column, silence_us: int | None, delay_us: int) -> DataFrame:
    rows = usable(stream).withColumn("on", F.coalesce(on, F.lit(False)))
    row = packed("msg_us", "on", "frame_id", "soc_pct").alias("row")
    if silence_us is None:
        return rows.select("vin", row)
    timed = rows.withColumn("at", F.timestamp_micros("msg_us")).withWatermark("at", f"{delay_us} microseconds")
    return timed.select("vin", row, "at")


def start_sessions(
    stream: DataFrame, on: Column, folder: str, trigger: dict = ONCE, silence_us: int | None = None, delay_us: int = 1_000_000
) -> StreamingQuery:
    """The session detector; with ``silence_us`` a timer closes sessions whose vehicle stays silent.

    With it, rows more than ``delay_us`` behind the latest time seen are dropped.
    """
    rows = session_input(stream, on, silence_us, delay_us)
    return detect(stream, rows, SessionProcessor(silence_us), SESSION, folder, trigger, silence_us is not None)


def run_sessions(
    stream: DataFrame, on: Column, folder: str | None = None, trigger: dict = ONCE, silence_us: int | None = None
) -> DataFrame:
    """All sessions closed by the stream.

    The stream has ``vin, msg_us, frame_id, soc_pct`` and the columns of the state flag
    ``on``, so it serves charging as well as driving.
    """
    folder = folder or work_folder(stream.sparkSession, "sessions")
    start_sessions(stream, on, folder, trigger, silence_us).awaitTermination()
    return found_rows(stream.sparkSession, folder, SESSION)


def start_last_n(stream: DataFrame, on: Column, folder: str, n: int = 10, trigger: dict = ONCE, level: float = 80.0) -> StreamingQuery:
    rows = session_input(stream, on, None, 0)
    return detect(stream, rows, LastNProcessor(n, level), EMISSION, folder, trigger, False)


def run_last_n(
    stream: DataFrame, on: Column, n: int = 10, folder: str | None = None, trigger: dict = ONCE
) -> DataFrame:
    """For each closed session that crosses 80 %, the latest ``n`` such sessions."""
    folder = folder or work_folder(stream.sparkSession, "last-n")
    start_last_n(stream, on, folder, n, trigger).awaitTermination()
    return found_rows(stream.sparkSession, folder, EMISSION)


def start_pattern(
    stream: DataFrame,
    first: Column,
    then: Column,
    folder: str,
    delay_us: int = 1_000_000,
    trigger: dict = ONCE,
    once_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """The pattern detector.

    Rows may come up to ``delay_us`` out of order; the engine drops those behind its watermark, and with
    ``once_by`` also rows that are delivered again with equal values there.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = usable(stream).withColumn("at", F.timestamp_micros("msg_us")).withWatermark("at", f"{delay_us} microseconds")
    if once_by:
        rows = rows.dropDuplicatesWithinWatermark(list(once_by))
    rows = rows.select("vin", "msg_us", F.coalesce("frame_id", F.lit(-1)).alias("frame_id"), yes(first).alias("first"), yes(then).alias("then"), "at")
    rows = rows.select("vin", packed("msg_us", "frame_id", "first", "then").alias("row"), "at")
    return detect(stream, rows, PatternProcessor(), MATCH, folder, trigger, True, bool(once_by))


def waiting(spark: SparkSession, folder: str, operator: int = 0) -> DataFrame:
    """Rows of the pattern detector that wait for the watermark, read from its state store."""
    state = (
        spark.read.format("statestore")
        .option("path", checkpoint(folder))
        .option("operatorId", operator)
        .option("stateVarName", "pending")
        .load()
    )
    return state.select("key.vin", F.inline("value.rows"))


def run_pattern(
    stream: DataFrame,
    first: Column,
    then: Column,
    delay_us: int = 1_000_000,
    folder: str | None = None,
    trigger: dict = ONCE,
) -> DataFrame:
    """Rows that satisfy ``first`` directly followed by one that satisfies ``then``.

    When the stream has ended, nothing can come in between any more, so the pairs still
    waiting for the watermark count too.
    """
    spark = stream.sparkSession
    folder = folder or work_folder(spark, "pattern")
    start_pattern(stream, first, then, folder, delay_us, trigger).awaitTermination()
    found = found_rows(spark, folder, MATCH)
    if not ran(spark, folder):
        return found
    rest = followed_by(waiting(spark, folder), F.col("first"), F.col("then")).select(*MATCH.names)
    return found.unionByName(rest)


def ran(spark: SparkSession, folder: str) -> bool:
    """Whether a detector has worked off any batch."""
    try:
        spark.read.text(os.path.join(checkpoint(folder), "commits", "[0-9]*")).limit(1).count()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
