"""State handlers: lists under signed changes, sessions, overlapping windows, periodic reports.

A micro-batch costs what it changes: each handler holds what its key needs in Spark's
state store, and nothing stored before is read again. Input is combined per task first
(``slot_counts``), so a handler sees a row per slot and task instead of one per event.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.combine import slot_counts
from ..operators.windows import micros

#: Parts of a group that have a state of their own; more of them for groups of millions of items.
SALTS = 4
#: Parts that the keys of periodic reports are dealt over; more of them for hundreds of millions of live keys.
BUCKETS = 1024

# The state handlers travel with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Handler(StatefulProcessor):
    def close(self) -> None:
        pass


# Signed changes and lists.

class TableChanges(_Handler):
    """A table with a row per key: its newest group, and an amount that adds up.

    Each change of the row takes its old amount out of the old group and puts the new
    one into the new group.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", "at long, tie long, grp string, amount long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        given = pd.concat(list(rows))
        newest = given.sort_values(["at", "tie"]).iloc[-1]
        old = self.row.get()
        at, tie, grp = int(newest["at"]), int(newest["tie"]), newest["grp"]
        if old and (old[0], old[1]) > (at, tie):
            at, tie, grp = old[0], old[1], old[2]
        amount = int(given["amount"].sum()) + (old[3] if old else 0)
        self.row.update((at, tie, grp, amount))
        changes = ([(old[2], -old[3])] if old else []) + [(grp, amount)]
        yield pd.DataFrame({"grp": [g for g, _ in changes], "item": str(key[0]), "delta": [d for _, d in changes]})


def table_changes(updates: DataFrame, key: str) -> DataFrame:
    """``grp``, ``item`` (the key as text) and ``delta``: what updates of a table change in its groups.

    ``updates`` has the key, ``at`` and ``tie`` (longs that order the updates), ``grp``
    (text) and ``amount`` (added to the row's). An update that comes late adds its amount,
    and leaves the newer group.
    """
    return updates.groupBy(key).transformWithStateInPandas(
        TableChanges(), outputStructType="grp string, item string, delta long", outputMode="Append", timeMode="None")


def _best(amounts: dict[str, int], n: int) -> list[tuple[str, int]]:
    return sorted(amounts.items(), key=lambda x: (-x[1], x[0]))[:n]


class _Windowed(_Handler):
    """State of one group of a window, which goes when the watermark has passed the window.

    The slot is the second part of the key. Without ``width`` the state stays.
    """

    def __init__(self, n: int, width: int):
        self.n, self.width = n, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def keep_until_closed(self, slot: int) -> None:
        if self.width and next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer((slot + self.width) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for state in self.states:
            state.clear()
        return iter(())


class SaltedList(_Windowed):
    """The items of one part of a group with their amounts, and the first ``n`` of them.

    A change takes the old entry out and puts the new one in; an item whose amount is
    zero leaves. The list is kept beside the items, which are looked through again only
    when one of the list has lost its place.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.amounts = handle.getMapState("amounts", "item string", "amount long")
        self.first = handle.getValueState("first", "items array<string>, amounts array<long>")
        self.states = [self.amounts, self.first]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        given = pd.concat(list(rows))
        deltas = given.groupby("item")["delta"].sum()
        held = self.first.get()
        before = dict(zip(held[0], held[1])) if held else {}
        full, now, lost = len(before) >= self.n, dict(before), False
        for item, delta in deltas[deltas != 0].items():
            old = self.amounts.getValue((item,))
            amount = int(delta) + (old[0] if old else 0)
            if amount:
                self.amounts.updateValue((item,), (amount,))
                now[item] = amount
            else:
                self.amounts.removeKey((item,))
                now.pop(item, None)
            lost |= full and item in before and amount < before[item]
        if lost:
            # Others may have moved up that the list does not hold.
            now = {k[0]: v[0] for k, v in self.amounts.iterator()}
        self.keep_until_closed(key[1])
        best = _best(now, self.n)
        if best != _best(before, self.n):
            self.first.update(([i for i, _ in best], [a for _, a in best]))
            yield pd.DataFrame({
                "grp": [key[0]], "slot": [key[1]], "salt": [key[2]], "at": [given["at"].max()],
                "items": [[i for i, _ in best]], "amounts": [[a for _, a in best]]})


class MergedList(_Windowed):
    """The lists of a group's parts, ``n`` entries each at most, merged to the group's list."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "salt int", "items array<string>, amounts array<long>")
        self.states = [self.parts]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        for frame in rows:
            for salt, items, amounts in zip(frame["salt"], frame["items"], frame["amounts"]):
                if len(items):
                    self.parts.updateValue((int(salt),), (list(items), [int(a) for a in amounts]))
                else:
                    self.parts.removeKey((int(salt),))
        every = {i: a for _, (items, amounts) in self.parts.iterator() for i, a in zip(items, amounts)}
        best = _best(every, self.n)
        self.keep_until_closed(key[1])
        yield pd.DataFrame({
            "grp": [key[0]], "slot": [key[1]], "items": [[i for i, _ in best]], "amounts": [[a for _, a in best]]})


def live_lists(changes: DataFrame, n: int, salts: int = SALTS, width: str | None = None) -> DataFrame:
    """``grp``, ``slot``, ``items`` and ``amounts``: the first ``n`` of each group a batch has changed.

    ``changes`` has ``grp`` (text), ``slot`` (a long, part of the group), ``item`` (text) and
    ``delta``. Larger amounts come first, equal ones by item. A group is spread over
    ``salts`` by item, each with a state of its own, so no state row holds a group and a
    busy group has many tasks; ``n`` entries of each part are merged. A group that has
    lost all items comes with an empty list. With ``width`` slots are starts of windows
    in microseconds, changes also have ``at``, a time with a watermark, and windows that
    the watermark has passed are forgotten; without it groups live for good.
    """
    rows = changes.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int"))
    out, span = "grp string, slot long, items array<string>, amounts array<long>", micros(width) if width else 0
    if not width:
        rows = rows.withColumn("at", F.lit(0).cast("timestamp"))
    parts = rows.groupBy("grp", "slot", "salt").transformWithStateInPandas(
        SaltedList(n, span), outputStructType=f"salt int, at timestamp, {out}", outputMode="Append",
        timeMode="EventTime" if width else "None", **({"eventTimeColumnName": "at"} if width else {}))
    return parts.groupBy("grp", "slot").transformWithStateInPandas(
        MergedList(n, span), outputStructType=out, outputMode="Append", timeMode="EventTime" if width else "None")


def live_top(rows: DataFrame, group: str, item: str, n: int, width: str, late: str = "1 day", ts: str = "timestamp") -> DataFrame:
    """Group, ``window``, ``items`` and ``amounts``: the ``n`` most frequent items of open windows, at every change.

    Rows without a group or an item do not count.
    """
    changes = slot_counts(rows, [group, item], width, ts).withWatermark("last", late).select(
        F.col(group).alias("grp"), "slot", F.col(item).alias("item"), F.col("n").alias("delta"), F.col("last").alias("at"))
    window = F.struct(F.timestamp_micros("slot").alias("start"), F.timestamp_micros(F.col("slot") + micros(width)).alias("end"))
    return live_lists(changes, n, width=width).select(
        F.col("grp").alias(group), window.alias("window"), "items", "amounts")


# Sessions.

CHANGES = "key string, start long, finish long, count long, replaced boolean"


class Sessions(_Handler):
    """The sessions of a key that later rows may still reach; every change of one is passed on.

    A session is forgotten when rows that could join it would be late.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start long, finish long, count long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        given = pd.concat(list(rows))
        new = zip(given["start"], given["finish"], given["n"])
        held = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        merged: list[list[int]] = []
        for start, finish, n in sorted([*held, *(tuple(map(int, s)) for s in new)]):
            if merged and start - merged[-1][1] <= self.gap:
                merged[-1][1] = max(merged[-1][1], finish)
                merged[-1][2] += n
            else:
                merged.append([start, finish, n])
        now = [tuple(s) for s in merged]
        self.open.put(now)
        self._arm(now)
        spans = {s[:2] for s in now}
        changed = [(*s, False) for s in now if s not in set(held)] + [(*s, True) for s in held if s[:2] not in spans]
        yield pd.DataFrame(
            [(str(key[0]), *c) for c in changed], columns=["key", "start", "finish", "count", "replaced"])

    def _arm(self, sessions: list[tuple[int, int, int]]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if sessions:
            self.handle.registerTimer((min(s[1] for s in sessions) + self.gap) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        past = timerValues.getCurrentWatermarkInMs() * 1000
        left = [tuple(s) for s in self.open.get() if s[1] + self.gap >= past]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        self._arm(left)
        return iter(())


def live_session_changes(
    rows: DataFrame, key: str = "key", gap: str = "30 minutes", late: str = "1 day", ts: str = "timestamp"
) -> DataFrame:
    """Key, ``window``, ``count`` and ``replaced``: every change of a session, as it comes.

    A session that has become part of another comes back as replaced. Rows up to
    ``late`` behind the newest join the session they belong to.
    """
    slots = slot_counts(rows, [key], gap, ts).withWatermark("last", late)
    spans = slots.select(
        key, "n", "last", F.unix_micros("first").alias("start"), F.unix_micros("last").alias("finish"))
    changes = spans.groupBy(key).transformWithStateInPandas(
        Sessions(micros(gap)), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime")
    window = F.struct(F.timestamp_micros("start").alias("start"), F.timestamp_micros("finish").alias("end"))
    return changes.select(
        F.col("key").cast(rows.schema[key].dataType).alias(key), window.alias("window"), "count", "replaced")


def current_sessions(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sessions that stand after all ``changes``, stored with their ``batch_id``."""
    newest = F.max_by(F.struct("count", "replaced"), F.col("batch_id")).alias("s")
    return changes.groupBy(*keys, "window").agg(newest).where("not s.replaced").select(*keys, "window", "s.count")


# Overlapping windows.

class HoppingCounts(_Handler):
    """Counts of a key's slots, and the windows over them that a batch has changed.

    Each row counts in one slot. Slots are forgotten when no row that is not late can
    change a window over them.
    """

    def __init__(self, width: int, advance: int):
        self.width, self.advance = width, advance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot long", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        new = pd.concat([frame[["slot", "n"]] for frame in rows]).groupby("slot")["n"].sum()
        held: dict[int, int] = {}

        def count(slot: int) -> int:
            if slot not in held:
                found = self.slots.getValue((slot,))
                held[slot] = found[0] if found else 0
            return held[slot]

        for slot, n in new.items():
            held[int(slot)] = count(int(slot)) + int(n)
            self.slots.updateValue((int(slot),), (held[int(slot)],))
        hops = range(0, self.width, self.advance)
        starts = sorted({int(slot) - hop for slot in new.index for hop in hops})
        if next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer((min(map(int, new.index)) + self.width) // 1000 + 1)
        yield pd.DataFrame({
            "key": str(key[0]), "start": starts, "count": [sum(count(s + hop) for hop in hops) for s in starts]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        past = timerValues.getCurrentWatermarkInMs() * 1000
        known = [k[0] for k in self.slots.keys()]
        for slot in known:
            if slot + self.width <= past:
                self.slots.removeKey((slot,))
        left = [slot for slot in known if slot + self.width > past]
        if left:
            self.handle.registerTimer((min(left) + self.width) // 1000 + 1)
        return iter(())


def live_hopping_count(
    rows: DataFrame, key: str, width: str, advance: str, late: str = "1 day", ts: str = "timestamp"
) -> DataFrame:
    """Key, ``window`` and ``count``: every change of an overlapping window, each row counted once.

    ``advance`` must divide ``width``. Rows up to ``late`` behind the newest count.
    """
    if micros(width) % micros(advance):
        raise ValueError("advance must divide width")
    slots = slot_counts(rows, [key], advance, ts).withWatermark("last", late)
    counts = slots.groupBy(key).transformWithStateInPandas(
        HoppingCounts(micros(width), micros(advance)), outputStructType="key string, start long, count long",
        outputMode="Append", timeMode="EventTime")
    window = F.struct(
        F.timestamp_micros("start").alias("start"), F.timestamp_micros(F.col("start") + micros(width)).alias("end"))
    return counts.select(F.col("key").cast(rows.schema[key].dataType).alias(key), window.alias("window"), "count")


# Periodic reports.

class Heartbeat(_Handler):
    """Reports the totals of a bucket's keys at every tick of stream time while they live, changed or not.

    Rows wait until the watermark passes the tick that ends their interval. A timer stands
    at the next tick as long as a key had rows within ``idle``, else at the first tick that
    waits; a key is forgotten after ``idle``. A tick reports every live key, so a bucket's
    keys are read and written together, column by column: per key the store and the frames
    cost far more than the sums. Ticks in a row with the same total come as one row.
    """

    def __init__(self, every: int, idle: int):
        self.every, self.idle = every, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "at long")
        self.waiting = handle.getListState("waiting", "keys array<string>, ticks array<long>, counts array<long>")
        self.lives = handle.getValueState(
            "lives", "next long, keys array<string>, last array<long>, totals array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        for given in rows:
            ticks = given["slot"] + self.every
            self.waiting.appendValue((given["key"].map(str).tolist(), ticks.tolist(), given["n"].tolist()))
            # Before its first report a key may still learn of earlier rows.
            held, at = self.timer.get(), int(ticks.min()) // 1000
            if held is None or at < held[0]:
                if held is not None:
                    self.handle.deleteTimer(held[0])
                self._arm(at)
        return iter(())

    def _arm(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        past = timerValues.getCurrentWatermarkInMs() * 1000
        upto = past - past % self.every
        parts = list(self.waiting.get())
        names = np.array([k for part in parts for k in part[0]], object)
        ticks, counts = (np.array([x for part in parts for x in part[i]], np.int64) for i in (1, 2))
        start, living, last, totals = self.lives.get() or (0, [], [], [])
        due = ticks <= upto

        # Living keys come first, with their last rows' tick, and go on from the next one.
        every_key, known = pd.factorize(np.concatenate([np.array(living, object), names[due]]))
        at = np.concatenate([np.array(last, np.int64), ticks[due]])
        n = np.concatenate([np.array(totals, np.int64), counts[due]])
        begin = np.concatenate([np.full(len(living), start, np.int64), ticks[due]])
        order = np.lexsort((at, every_key))
        every_key, at, n, begin = (x[order] for x in (every_key, at, n, begin))
        other = np.ones(len(at) + 1, bool)
        other[1:-1] = every_key[1:] != every_key[:-1]
        opens = other[:-1].copy()
        opens[1:] |= at[1:] - at[:-1] > self.idle
        sums, lives = np.cumsum(n), np.cumsum(opens) - 1
        total = sums - (sums - n)[opens][lives]
        # A total stands until the next rows of its life, for ``idle`` or up to the watermark.
        end = np.minimum(at + self.idle, upto)
        end[:-1] = np.where(opens[1:], end[:-1], np.minimum(end[:-1], at[1:] - self.every))
        times = (end - begin) // self.every + 1
        alive, shown = other[1:] & (at + self.idle > upto), times > 0

        if alive.any():
            self.lives.update((
                upto + self.every, known[every_key[alive]].tolist(), at[alive].tolist(), total[alive].tolist()))
        else:
            self.lives.clear()
        if due.all():
            self.waiting.clear()
        else:
            self.waiting.put([(names[~due].tolist(), ticks[~due].tolist(), counts[~due].tolist())])
        if alive.any() or not due.all():
            self._arm((upto + self.every if alive.any() else int(ticks[~due].min())) // 1000)
        else:
            self.timer.clear()
        if shown.any():
            yield pd.DataFrame({
                "key": known[every_key[shown]], "tick": begin[shown], "times": times[shown], "total": total[shown]})


def heartbeat(
    rows: DataFrame, key: str, every: str = "1 second", idle: str = "1 hour", late: str = "1 day", ts: str = "timestamp",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``key`` (text), ``tick_ms`` and ``value`` (the total as text): every live key once per tick.

    A key lives from its first row until ``idle`` after its last, in whole ticks; then it
    is forgotten, and a later row starts it anew. ``every`` must divide ``idle``. Keys are
    dealt over ``buckets`` with a state each, which a task takes whole; a checkpoint keeps
    the number.
    """
    if micros(idle) % micros(every):
        raise ValueError("every must divide idle")
    slots = slot_counts(rows, [key], every, ts).withWatermark("last", late).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.col(key).alias("key"), "slot", "n", "last")
    reports = slots.groupBy("bucket").transformWithStateInPandas(
        Heartbeat(micros(every), micros(idle)), outputStructType="key string, tick long, times long, total long",
        outputMode="Append", timeMode="EventTime")
    at = F.explode(F.sequence("tick", F.col("tick") + (F.col("times") - 1) * micros(every), F.lit(micros(every))))
    return reports.select("key", at.alias("at"), "total").select(
        "key", (F.col("at") / 1000).cast("long").alias("tick_ms"), F.col("total").cast("string").alias("value"))
