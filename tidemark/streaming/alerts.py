"""Alert states over a stream of ticks, silent keys included."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.times import micros, watermarked

#: ticks that one entry of the state holds
BLOCK = 512
HELD_BLOCKS = 64
MISSING, OFF, ON = 0, 1, 2


class AlertFollower(StatefulProcessor):
    """Follows the ticks of a key on their grid: rows are put by, a timer at the next tick judges them in time order.

    Ticks wait as one byte each in blocks of BLOCK, fetched one at a time, so neither the rows of a batch nor the
    backlog of a key are ever together in memory, and rows may come in any order. Besides the waiting ticks the state is
    one row: the next tick to judge, the run so far, the last tick judged that was there, the latest that waits, the rule.
    """

    def __init__(self, keys: Sequence[str], step: int, forget: int | None):
        self.keys, self.step, self.forget = list(keys), step, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "block long", "flags binary")
        self.run = handle.getValueState(
            "run", "next long, started boolean, on boolean, since long, heard long, latest long, hold long, quiet int")

    def _flags(self, block: int) -> np.ndarray:
        if self.waiting.containsKey((block,)):
            return np.frombuffer(bytes(self.waiting.getValue((block,))[0]), np.uint8).copy()
        return np.zeros(BLOCK, np.uint8)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.run.get() if self.run.exists() else None
        first = last = rule = None
        held: dict[int, np.ndarray] = {}
        for frame in rows:
            slot = frame["at"].to_numpy() // self.step
            flag = np.where(frame["on"].to_numpy(), ON, OFF).astype(np.uint8)
            if state is not None and state[1]:
                known = slot * self.step >= state[0]
                slot, flag = slot[known], flag[known]
            if not len(slot):
                continue
            rule = rule or (int(frame["hold"].iloc[0]), int(frame["quiet"].iloc[0]))
            first = int(slot.min()) if first is None else min(first, int(slot.min()))
            last = int(slot.max()) if last is None else max(last, int(slot.max()))
            for block in np.unique(slot // BLOCK).tolist():
                if block not in held:
                    held[block] = self._flags(block)
                of = slot // BLOCK == block
                held[block][slot[of] % BLOCK] = flag[of]
            if len(held) > HELD_BLOCKS:
                self._put(held)
        self._put(held)
        if first is None:
            return iter([])
        if state is None:
            self._wait((first * self.step, False, False, 0, first * self.step, last * self.step, *rule))
        else:
            following, started, on, since, heard, latest, hold, quiet = state
            latest = max(latest, last * self.step)
            if not started and first * self.step < following:
                self._wait((first * self.step, False, False, 0, first * self.step, latest, hold, quiet), following)
            else:
                self.run.update((following, started, on, since, heard, latest, hold, quiet))
        return iter([])

    def _put(self, held: dict[int, np.ndarray]) -> None:
        for block, flags in held.items():
            self.waiting.updateValue((block,), (bytearray(flags.tobytes()),))
        held.clear()

    def _wait(self, state: tuple, instead: int | None = None) -> None:
        self.run.update(state)
        if instead is not None:
            self.handle.deleteTimer(-(-instead // 1000))
        self.handle.registerTimer(-(-state[0] // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        slot, _, on, since, heard, latest, hold, quiet = self.run.get()
        slot //= self.step
        end = passed // self.step
        if quiet < 0 or self.forget is not None:
            # behind the latest tick nothing is to say, or only for a while
            end = min(end, (latest + (self.forget if quiet >= 0 else 0)) // self.step)
        while slot <= end:
            block = slot // BLOCK
            to = min((block + 1) * BLOCK - 1, end)
            flags = self._flags(block)[slot % BLOCK : to % BLOCK + 1]
            at = np.arange(slot, to + 1) * self.step
            there = flags != MISSING
            last = np.maximum.accumulate(np.where(there, at, heard))
            shown = there | ((quiet >= 0) & (True if self.forget is None else at - last <= self.forget))
            holds = (flags == ON) | (~there & shown & (quiet == 1))
            starts = holds & ~np.concatenate(([on], holds[:-1]))
            began = np.where(starts, at, np.iinfo(np.int64).min)
            began[0] = max(began[0], since) if on and holds[0] else began[0]
            began = np.maximum.accumulate(began)
            on, since, heard = bool(holds[-1]), int(began[-1]) if holds[-1] else 0, int(last[-1])
            state = np.where(~holds, "inactive", np.where(at - began >= hold, "firing", "pending"))
            made = {name: [value] * int(shown.sum()) for name, value in zip(self.keys, key)}
            made |= {"at": at[shown], "state": state[shown],
                     "since_at": pd.array(np.where(holds, began, 0)[shown], "Int64")}
            made["since_at"][~holds[shown]] = pd.NA
            if (to + 1) % BLOCK == 0:
                self.waiting.removeKey((block,))
            slot = to + 1
            if shown.any():
                yield pd.DataFrame(made)
        following = slot * self.step
        over = following > latest + (self.forget if quiet >= 0 and self.forget is not None else 0)
        if over and following <= passed and (quiet < 0 or self.forget is not None):
            self.waiting.removeKey((slot // BLOCK,))
            self.run.clear()
        else:
            self._wait((following, True, on, since, heard, latest, hold, quiet))

    def close(self) -> None:
        pass


def alert_stream(
    ticks: DataFrame,
    keys: Sequence[str],
    condition: Column,
    hold: timedelta | Column,
    step: timedelta,
    tick: str = "tick",
    silent: Column | None = None,
    forget: timedelta | None = None,
    watermark: str | None = "0 seconds",
) -> DataFrame:
    """Alert states over a stream of evaluation ticks, the same rows `alert_states` gives for a table.

    Ticks lie on multiples of ``step``. One timer per key waits for the watermark to pass its next tick; rows of a tick
    must have come by then. ``silent`` says what a missing tick means: null (and no ``silent``) ends a run without a row,
    true or false is the condition of a key that says nothing, which then has a row at every step that the watermark
    passes, so an alert on silence fires without any row of its key. ``forget`` drops a key that has said nothing for that
    long, else a silent key is followed as long as the stream runs. ``hold`` and ``silent`` are constant within a key.
    ``watermark`` is None for ticks whose stream has one. Needs a state store with timers (`jobs.run_to_table` sets it).
    """
    keys = list(keys)
    us = lambda t: int(t / timedelta(microseconds=1))
    kind = ticks.schema[tick].dataType
    rows = watermarked(ticks, tick, watermark) if watermark else ticks
    quiet = F.coalesce((silent if silent is not None else F.lit(None)).cast("int"), F.lit(-1))
    held = F.lit(us(hold)) if isinstance(hold, timedelta) else hold
    rows = rows.select(
        *keys, micros(tick).alias("at"), F.coalesce(condition, F.lit(False)).alias("on"),
        held.cast("long").alias("hold"), quiet.alias("quiet"))
    out = T.StructType([ticks.schema[k] for k in keys] + [
        T.StructField("at", T.LongType()), T.StructField("state", T.StringType()), T.StructField("since_at", T.LongType())])
    follower = AlertFollower(keys, us(step), us(forget) if forget is not None else None)
    followed = rows.groupBy(*keys).transformWithStateInPandas(follower, out, "Append", "EventTime")
    as_time = lambda c: F.timestamp_micros(c).cast(kind)
    return followed.select(*keys, as_time("at").alias(tick), as_time("since_at").alias("since"), "state")
