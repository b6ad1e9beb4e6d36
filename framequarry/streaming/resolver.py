"""The resolver by keyed state and timers (R4, M6, R6): what each waiting id needs is in the state store, not in tables that are rewritten.

``due_signals`` is a per-id state machine over three kinds of rows: ``ask`` (the id is wanted, with its place in the order),
``sent`` (it was dispatched) and ``done``. An id is due when it is first asked for and again ``wait_s`` after each dispatch,
by a timer, until it is done or was sent ``most`` times; then its state goes but for a mark, which a timer removes after ``remember_s``.
Work in a batch follows the ids that have rows or timers in it.

``resolve`` admits due ids in their order below the queue's high-water mark and appends two narrow tables of a commit log, one
commit a batch: ``waiting`` (what became due) and ``sent``. What was sent comes back to the stream as ``sent`` rows.

Time is the stream's own (column ``ts``, in seconds) with ``event_time``, so that a replay gives the same rows however it is cut into
batches; else it is the cluster's clock. Rows of one id in a batch are taken by time; a timer that a later row has passed
fires before that row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framequarry.sinks.commits import Change, CommitLog, Snapshot

WAIT_S, MOST, REMEMBER_S = 6 * 3600.0, 3, 30 * 86400.0
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
#: At one time an id is done before it is sent, and sent before it is asked for.
KINDS = ["done", "sent", "ask"]
SIGNAL = "id string, ord long, try_no int, at double, signal string"


class Resolver(StatefulProcessor):
    """State of an id: ord, tries (dispatches), due (when its timer fires; null while it waits for a dispatch) and closed."""

    def __init__(self, wait_s: float, most: int, remember_s: float | None, event_time: bool):
        self.wait_s, self.most, self.remember_s, self.event_time = wait_s, most, remember_s, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("id_state", "ord long, tries int, due double, closed boolean")

    def _fire(self, state: tuple) -> tuple[tuple | None, list]:
        """What a timer does: an id becomes due again, or its mark goes."""
        order, tries, due, closed = state
        if closed:
            return None, []
        return (order, tries, None, False), [(order, tries, due, "due")]

    def _close(self, order: int | None, tries: int, at: float) -> tuple:
        return (order, tries, None if self.remember_s is None else at + self.remember_s, True)

    def _row(self, state: tuple | None, kind: str, order, at: float) -> tuple[tuple | None, list]:
        if kind == "done":
            if state is None:
                return self._close(None, 0, at), []
            waits = state[2] is None and not state[3]
            return (state if state[3] else self._close(state[0], state[1], at)), [(state[0], state[1], at, "withdrawn")] if waits else []
        if kind == "ask":
            return ((order, 0, None, False), [(order, 0, at, "due")]) if state is None else (state, [])
        if state is None or state[3] or state[2] is not None:  # sent, though nobody waits for it
            return state, []
        tries = state[1] + 1
        if tries >= self.most:
            return self._close(state[0], tries, at), [(state[0], tries, at, "given_up")]
        return (state[0], tries, at + self.wait_s, False), []

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = None if self.event_time else timerValues.getCurrentProcessingTimeInMs() / 1000
        found = sorted((now if now is not None else r.at, KINDS.index(r.kind), -1 if r.ord is None else r.ord) for r in rows)
        state = before = self.state.get()
        out: list = []
        for at, kind, order in found:
            if state and state[2] is not None and state[2] <= at:
                state, more = self._fire(state)
                out += more
            state, more = self._row(state, KINDS[kind], order, at)
            out += more
        self._keep(before, state)
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = before = self.state.get()
        out: list = []
        if state and state[2] is not None and int(state[2] * 1000) <= expiredTimerInfo.getExpiryTimeInMs():
            state, out = self._fire(state)
            self._keep(before, state, fired=True)
        yield from self._rows(key, out)

    def _keep(self, before: tuple | None, state: tuple | None, fired: bool = False) -> None:
        """Each call on state or timers is an exchange with the JVM, so only what has changed is written. An id has at most one timer, that of its
        state's ``due``, which goes by itself once it has fired."""
        if state is None and before is not None:
            self.state.clear()
        elif state != before:
            self.state.update(state)
        due, was = state[2] if state else None, before[2] if before and not fired else None
        if due != was:
            if was is not None:
                self.handle.deleteTimer(int(was * 1000))
            if due is not None:
                self.handle.registerTimer(int(due * 1000))

    @staticmethod
    def _rows(key, out: list) -> Iterator[Row]:
        return (Row(id=key[0], ord=order, try_no=tries, at=float(at), signal=signal) for order, tries, at, signal in out)

    def close(self) -> None:
        pass


def due_signals(stream: DataFrame, wait_s: float = WAIT_S, most: int = MOST, remember_s: float | None = REMEMBER_S, event_time: bool = False, late: str = "0 seconds") -> DataFrame:
    """id, ord, try_no, at and signal from a stream of (id, kind, ord, ts in seconds): ``due`` when an id is to be dispatched, ``withdrawn`` when one
    that waits for it is done, ``given_up`` when it was sent ``most`` times.

    Keyed state with timers needs the RocksDB state store, so the session is set to it. Null ids and rows of other kinds are left out; a null ord is -1. ``remember_s`` None keeps closed ids
    for good. In event time, rows that come in a later batch than others of their time or of ``late`` after it are left out, and
    timers wait for ``late`` too."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = stream.where(F.col("id").isNotNull() & F.col("kind").isin(KINDS)).select(F.col("id").cast("string").alias("id"), "kind", F.col("ord").cast("long").alias("ord"), F.col("ts").cast("double").alias("at"))
    if event_time:
        rows = rows.where("at is not null").withColumn("event", F.timestamp_micros((F.col("at") * 1_000_000).cast("long"))).withWatermark("event", late)
    return rows.groupBy("id").transformWithState(Resolver(wait_s, most, remember_s, event_time), SIGNAL, "append", "EventTime" if event_time else "ProcessingTime")


def admitted(snapshot: Snapshot, new: DataFrame, gone: DataFrame, room: int) -> DataFrame:
    """The first ``room`` by ord of what waits, that is of ``new`` and of the log's waiting rows less those sent or ``gone``: a top-k, no sort."""
    waiting = new.unionByName(snapshot.table("waiting")) if "waiting" in snapshot else new
    if "sent" in snapshot:
        gone = gone.unionByName(snapshot.table("sent").select("id", "try_no"))
    return waiting.join(gone, ["id", "try_no"], "left_anti").orderBy("ord", "id").limit(max(0, room))


def resolve(stream: DataFrame, log: CommitLog, marks: str, checkpoint: str, depth: Callable[[], int], clock: Callable[[], float], high_water: int = 50, batch: int = 20, compact_every: int = 100, app: str = "resolver", **rules) -> None:
    """One run over all that is there. Each batch commits its due ids and what it admits; admitted ids are written to ``marks``/b<batch>
    as ``sent`` rows, from where ``stream`` should read them back. ``depth`` and ``clock`` are asked once a batch. Every ``compact_every``
    batches the log's tables are cut down to what still waits, so neither grows with all ids ever seen."""

    def step(due: DataFrame, number: int) -> None:
        signals = due.persist()
        now, room = float(clock()), min(batch, high_water - depth())

        def build(s: Snapshot) -> dict[str, Change]:
            new, gone = (signals.where(F.col("signal") == kind).select("id", "ord", "try_no") for kind in ("due", "withdrawn"))
            sent = admitted(s, new, gone.drop("ord"), room).withColumn("at", F.lit(now))
            out = sent.unionByName(gone.withColumn("at", F.lit(None).cast("double"))).withColumn("batch", F.lit(number))
            return {"waiting": Change(new), "sent": Change(out), "given_up": Change(signals.where("signal = 'given_up'").select("id", "at"))}

        log.commit(build, batch=(app, number), reads=("sent", "waiting"))
        signals.unpersist()
        mine = log.snapshot().table("sent").where((F.col("batch") == number) & F.col("at").isNotNull())
        mine.select("id", F.lit("sent").alias("kind"), "ord", F.col("at").alias("ts")).write.mode("overwrite").parquet(f"{marks}/b{number}")
        if compact_every and number % compact_every == compact_every - 1:
            log.commit(lambda s: cut_down(s, number))

    conf = log.spark.conf
    empty = conf.get(NO_DATA)
    # A clock always gives a reason for one more empty batch, so a run over what is there would never end; timers then fire with the next rows.
    conf.set(NO_DATA, "true" if rules.get("event_time") else "false")
    try:
        query = due_signals(stream, **rules).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(NO_DATA, empty)
    query.awaitTermination()


def cut_down(s: Snapshot, number: int) -> dict[str, Change]:
    """Waiting rows that weren't sent, and of the sent ones only the last batch's, which a restart may ask for."""
    left = s.table("waiting").join(s.table("sent").select("id", "try_no"), ["id", "try_no"], "left_anti")
    return {"waiting": Change(left.select("id", "ord", "try_no"), "replace"), "sent": Change(s.table("sent").where(F.col("batch") >= number), "replace")}
