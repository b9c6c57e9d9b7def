"""Ordered folds over streams whose rows come out of order, one state a log.

Rows wait in the state of their log until the log's own watermark, its latest time less the delay allowed, has passed them; then they are folded in
order of time by the same `step` as in a batch. A row that arrives after that is late: it is not folded but leaves with `late` set, so that nothing
is dropped silently. What still waits when a log ends is folded at its closing row, or when the log has been silent for `idle_ms`.
The state holds a fold's state, the times it has reached and the rows of one delay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: step(state, row) -> (new state, output or None), as in `operators.fold`.
Step = Callable[[tuple | None, tuple], tuple[tuple | None, tuple | None]]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _native(values: tuple) -> tuple:
    """Values as Python's own, NaN as null."""
    out = []
    for v in values:
        v = v.item() if hasattr(v, "item") else v
        out.append(None if v is None or v != v else v)
    return tuple(out)


class OrderedFold(StatefulProcessor):
    def __init__(self, step: Step, inputs: str, state: str, columns: list[str], delay_ns: int, idle_ms: int):
        self.step, self.inputs, self.state_ddl, self.columns = step, inputs, state, columns
        self.delay_ns, self.idle_ms = delay_ns, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", self.state_ddl)
        # The log's latest time and the time up to which it has been folded.
        self.reached = handle.getValueState("reached", "latest long, done long")
        self.waiting = handle.getListState("waiting", f"ts_ns long, place long, {self.inputs}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest, done = self.reached.get() or (None, None)
        fresh, late, closing = [], [], False
        for pdf in rows:
            for values in pdf.itertuples(index=False, name=None):
                ts, place, end, *rest = values
                ts = int(ts)
                latest = ts if latest is None else max(latest, ts)
                if end:
                    closing = True
                elif done is not None and ts <= done:
                    late.append(ts)
                else:
                    fresh.append((ts, int(place), *_native(tuple(rest))))
        yield from self._fold(key, fresh, latest, done, None if closing else latest - self.delay_ns)
        if late:
            yield self._out(key, [(ts, True, None) for ts in late])
        if self.idle_ms and not closing:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        latest, done = self.reached.get() or (None, None)
        yield from self._fold(key, [], latest, done, None)

    def _fold(self, key, fresh: list, latest: int | None, done: int | None, upto: int | None) -> Iterator[pd.DataFrame]:
        """Folds what waits up to the time given, or all; the rest waits on."""
        due = upto is None or done is None or upto > done
        held = [tuple(r) for r in self.waiting.get()] + fresh if due else fresh
        if not due:
            if fresh:
                self.waiting.appendList(fresh)
            self.reached.update((latest, done))
            return
        held.sort(key=lambda r: r[:2])
        ready = [r for r in held if upto is None or r[0] <= upto]
        rest = held[len(ready):]
        state = self.fold.get()
        state = None if state is None else tuple(state)
        found = []
        for ts, _place, *values in ready:
            state, out = self.step(state, (ts, *values))
            if out is not None:
                found.append((ts, False, out))
        if state is not None and ready:
            self.fold.update(tuple(state))
        self.waiting.put(rest) if rest else self.waiting.clear()
        if upto is None:
            upto = max([r[0] for r in ready], default=done if done is not None else latest)
        self.reached.update((latest, upto if done is None else max(done, upto)))
        if found:
            yield self._out(key, found)

    def _out(self, key, rows: list[tuple[int, bool, tuple | None]]) -> pd.DataFrame:
        none = (None,) * (len(self.columns) - 3)
        return pd.DataFrame([(key[0], ts, late, *((out or none) if none else ())) for ts, late, out in rows], columns=self.columns).astype({"ts_ns": "int64"})

    def close(self) -> None:
        pass


def ordered_steps(stream: DataFrame, step: Step, inputs: str, state: str, outputs: str, delay_ns: int, order: str | None = None, idle_ms: int = 0) -> DataFrame:
    """(bag_id, ts_ns, late, outputs): `step` folded over each log of `stream` in order of (ts_ns, `order`).

    `stream` has bag_id, ts_ns, `closing` (true in the row that ends a log) and the columns named in `inputs`; `step` sees the time and these. All
    three are lists such as "px double, py double".
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    fields = T.StructType.fromDDL(inputs)
    out = T.StructType([stream.schema["bag_id"], T.StructField("ts_ns", T.LongType()), T.StructField("late", T.BooleanType())])
    out = T.StructType(out.fields + (T.StructType.fromDDL(outputs).fields if outputs else []))
    place = F.col(order).cast("long") if order else F.lit(0).cast("long")
    rows = stream.select("bag_id", "ts_ns", place.alias("place"), "closing", *fields.names)

    class Kept(OrderedFold):
        """Rows without the key, which the engine hands over beside them."""

        def handleInputRows(self, key, rows, timerValues):
            return super().handleInputRows(key, (pdf.drop(columns="bag_id") for pdf in rows), timerValues)

    return rows.groupBy("bag_id").transformWithStateInPandas(
        Kept(step, inputs, state, out.names, delay_ns, idle_ms), out, "append", "ProcessingTime" if idle_ms else "None")


def run_split(stream: DataFrame, path: str, late_path: str, checkpoint: str) -> None:
    """Append what was in time to `path` and what was late to `late_path`, a folder a batch, so that a batch run again replaces itself."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        batch.filter("not late").drop("late").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.filter("late").drop("late").write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
        batch.unpersist()

    stream.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
