"""Keyed state of the live operators: sequence tracker, order book, grid detector and market registry.

Rows of a key are acted upon in event order. What arrives before the watermark has passed it waits in the state, so frames that
overtake each other, also across micro-batches, give what one batch over all of them gives. Only rows later than the watermark allows are
left out, which the engine counts in the query's progress.
"""

from __future__ import annotations

import json
import pickle
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming import packs

# Time that rows wait together, and rows of one key taken in before they are written.
BUCKET_MS = 10_000
GRID_BUCKET_MS = 7 * 86_400_000
FRESH_ROWS = 100_000
# Where rows travel in packs: rows of one key taken in before they are written, many as each time makes a part of every bucket, and rows that act together.
FRESH_PACKED_ROWS = 500_000
ACT_ROWS = 50_000


def plain(rows: Iterable[Row], names: list[str]) -> Iterator[tuple]:
    """The named columns of each row; a ``Row`` looks its names up one by one, a tuple of all does not."""
    pick = None
    for row in rows:
        if pick is None:
            pick = itemgetter(*[row.__fields__.index(name) for name in names])
        yield pick(tuple(row))


def row_of(schema: str) -> Row:
    """Makes rows with the names of ``schema``, whose columns are separated by a comma and a blank."""
    return Row(*[column.split()[0] for column in schema.split(", ")])


class InEventOrder(StatefulProcessor):
    """Holds rows until the watermark passes their time, then hands them to ``act`` in the order of ``order``.

    ``names`` are the input columns kept, ``per_ms`` the units of the time (``order[0]``) in a millisecond. Rows wait in parts, lists of rows
    of one bucket of ``bucket_ms`` of time, and buckets are read back one after the other; so a row is written and read once, but for those of the
    bucket at the watermark, and memory holds a bucket and the rows not yet written, however many wait. One timer per key, at its oldest waiting row.
    """

    def __init__(self, names: list[str], order: list[str], per_ms: int, bucket_ms: int = BUCKET_MS):
        self.names, self.per_ms, self.width = names, per_ms, bucket_ms * per_ms
        self.places = [names.index(c) for c in order]
        self.at = self.places[0]

    def order(self, row: tuple) -> tuple:
        return tuple(row[p] for p in self.places)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", "rows binary")
        # For each bucket its number of parts and its oldest row.
        self.buckets = handle.getValueState("buckets", "held binary")
        self.due = handle.getValueState("due", "at long")

    def passed(self, at: int, watermark_ms: int) -> bool:
        # The engine compares microseconds, so a row within the watermark's millisecond may still be overtaken.
        return at * 1000 // self.per_ms <= watermark_ms * 1000

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self.release(key, plain(rows, self.names), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()
        return self.release(key, iter(()), timerValues.getCurrentWatermarkInMs())

    def keep(self, held: dict, bucket: int, rows: list[tuple]) -> None:
        parts, oldest = held.get(bucket, (0, rows[0][self.at]))
        self.waiting.updateValue((bucket, parts), (pickle.dumps(rows),))
        held[bucket] = parts + 1, min(oldest, min(r[self.at] for r in rows))

    def take(self, held: dict, bucket: int) -> list[tuple]:
        rows = []
        for part in range(held.pop(bucket, (0, 0))[0]):
            rows += pickle.loads(self.waiting.getValue((bucket, part))[0])
            self.waiting.removeKey((bucket, part))
        return rows

    def ready(self, held: dict, fresh: dict[int, list[tuple]], watermark_ms: int) -> Iterator[tuple]:
        """Rows that the watermark has passed, in order; the others of their buckets are kept."""
        oldest = {b: min(r[self.at] for r in rows) for b, rows in fresh.items()}
        oldest |= {b: min(first, oldest.get(b, first)) for b, (_, first) in held.items()}
        for bucket in sorted(b for b, first in oldest.items() if self.passed(first, watermark_ms)):
            rows = self.take(held, bucket) + fresh.pop(bucket, [])
            if rest := [r for r in rows if not self.passed(r[self.at], watermark_ms)]:
                self.keep(held, bucket, rest)
                rows = [r for r in rows if self.passed(r[self.at], watermark_ms)]
            rows.sort(key=self.order)
            yield from rows

    def release(self, key, rows: Iterator[tuple], watermark_ms: int) -> Iterator[Row]:
        held = pickle.loads(self.buckets.get()[0]) if self.buckets.exists() else {}
        fresh, count = defaultdict(list), 0
        for row in rows:
            fresh[row[self.at] // self.width].append(row)
            count += 1
            if count == FRESH_ROWS:
                for bucket, some in fresh.items():
                    self.keep(held, bucket, some)
                fresh, count = defaultdict(list), 0
        ready = self.ready(held, fresh, watermark_ms)
        first = next(ready, None)
        if first is not None:
            yield from self.act(key, chain([first], ready))
        for bucket, some in fresh.items():
            self.keep(held, bucket, some)
        if held:
            self.buckets.update((pickle.dumps(held),))
        elif self.buckets.exists():
            self.buckets.clear()
        self.wake(min((-(-at // self.per_ms) for _, at in held.values()), default=None))

    def wake(self, at_ms: int | None) -> None:
        before = self.due.get()[0] if self.due.exists() else None
        if before == at_ms:
            return
        if before is not None:
            self.handle.deleteTimer(before)
            self.due.clear()
        if at_ms is not None:
            self.handle.registerTimer(at_ms)
            self.due.update((at_ms,))

    def act(self, key, rows: Iterable[tuple]) -> Iterable[Row]:
        """Must take all ``rows``."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def opened(frames: Iterable[pd.DataFrame]) -> Iterator[pa.Table]:
    """The tables of the packs that a key is handed."""
    for frame in frames:
        for data in frame["pack"]:
            yield packs.read(data)


def columns_of(rows: list[tuple], schema: str) -> dict[str, pa.Array]:
    """Rows of ``schema``, whose columns are separated by a comma and a blank, as Arrow columns."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    names = [column.split() for column in schema.split(", ")]
    return {name: pa.array(values, kinds[kind]) for (name, kind), values in zip(names, zip(*rows) if rows else [[]] * len(names))}


class PacksInEventOrder(InEventOrder):
    """As ``InEventOrder`` for rows that arrive in packs (see ``packs``); ``act`` is handed tables of about ``ACT_ROWS`` rows, each in order.

    A pack is as late as its last row; rows of it that are older than the watermark up to which their key has acted are left out here.
    """

    def __init__(self, time: str, per_ms: int, bucket_ms: int = BUCKET_MS):
        self.time, self.per_ms, self.width = time, per_ms, bucket_ms * per_ms

    def order(self, table: pa.Table) -> np.ndarray:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", "rows binary")
        # The watermark acted up to, and for each bucket its number of parts and its oldest row.
        self.held = handle.getValueState("held", "held binary")
        self.due = handle.getValueState("due", "at long")

    def passed(self, at, watermark_ms: int):
        return at <= -(-(watermark_ms * 1000 + 1) * self.per_ms // 1000) - 1

    def times(self, table: pa.Table) -> np.ndarray:
        return table.column(self.time).to_numpy()

    def on_time(self, table: pa.Table, done: int | None) -> pa.Table:
        late = np.zeros(table.num_rows, bool) if done is None else self.passed(self.times(table), done)
        return table.filter(pa.array(~late)) if late.any() else table

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return self.release(key, opened(rows), timerValues.getCurrentWatermarkInMs())

    def by_bucket(self, tables: list[pa.Table]) -> Iterator[tuple[int, pa.Table]]:
        table = pa.concat_tables(tables) if tables else None
        if not table:
            return
        bucket = self.times(table) // self.width
        order = np.argsort(bucket, kind="stable")
        table, bucket = table.take(pa.array(order)), bucket[order]
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(bucket)]):
            yield int(bucket[begin]), table.slice(begin, end - begin)

    def keep(self, held: dict, bucket: int, table: pa.Table) -> None:
        first = int(self.times(table).min())
        parts, oldest = held.get(bucket, (0, first))
        self.waiting.updateValue((bucket, parts), (packs.write(table),))
        held[bucket] = parts + 1, min(oldest, first)

    def take(self, held: dict, bucket: int) -> list[pa.Table]:
        tables = []
        for part in range(held.pop(bucket, (0, 0))[0]):
            tables.append(packs.read(self.waiting.getValue((bucket, part))[0]))
            self.waiting.removeKey((bucket, part))
        return tables

    def ready(self, held: dict, fresh: dict[int, pa.Table], watermark_ms: int) -> Iterator[pa.Table]:
        """Rows that the watermark has passed, in order; the others of their buckets are kept."""
        oldest = {b: int(self.times(table).min()) for b, table in fresh.items()}
        oldest |= {b: min(first, oldest.get(b, first)) for b, (_, first) in held.items()}
        tables, count = [], 0
        for bucket in sorted(b for b, first in oldest.items() if self.passed(first, watermark_ms)):
            table = pa.concat_tables(self.take(held, bucket) + ([fresh.pop(bucket)] if bucket in fresh else []))
            passed = self.passed(self.times(table), watermark_ms)
            if not passed.all():
                self.keep(held, bucket, table.filter(pa.array(~passed)))
                table = table.filter(pa.array(passed))
            tables.append(table)
            count += table.num_rows
            if count >= ACT_ROWS:
                yield self.sorted(tables)
                tables, count = [], 0
        if tables:
            yield self.sorted(tables)

    def sorted(self, tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables).combine_chunks()
        return table.take(pa.array(self.order(table)))

    def release(self, key, tables: Iterator[pa.Table], watermark_ms: int) -> Iterator[pd.DataFrame]:
        done, held = pickle.loads(self.held.get()[0]) if self.held.exists() else (None, {})
        fresh, count = [], 0
        for table in tables:
            fresh.append(self.on_time(table, done))
            count += table.num_rows
            if count >= FRESH_PACKED_ROWS:
                for bucket, some in self.by_bucket(fresh):
                    self.keep(held, bucket, some)
                fresh, count = [], 0
        left = dict(self.by_bucket(fresh))
        ready = self.ready(held, left, watermark_ms)
        first = next(ready, None)
        if first is not None:
            yield from self.act(key, chain([first], ready))
            done = watermark_ms
        for bucket, some in left.items():
            self.keep(held, bucket, some)
        self.held.update((pickle.dumps((done, held)),))
        self.wake(min((-(-at // self.per_ms) for _, at in held.values()), default=None))

    def act(self, key, tables: Iterable[pa.Table]) -> Iterable[pd.DataFrame]:
        """Must take all ``tables``."""
        raise NotImplementedError


STREAM_KEY = ["session_id", "sid"]
BOOK_PAYLOAD_NAMES = ["market_ticker", "side", "price_micros", "delta_fp_units", "levels", "pricing_convention"]
VERDICT = (
    "session_id string, sid bigint, life bigint, received_at_ns bigint, seq bigint, is_snapshot boolean, verdict string, high_water bigint, "
    "expected bigint, skipped bigint, is_break boolean, breaks bigint, is_valid boolean, gaps bigint, span_started_ns bigint, invalid_ns bigint"
)

JUDGED = (
    "life bigint, is_snapshot boolean, verdict string, high_water bigint, expected bigint, skipped bigint, is_break boolean, breaks bigint, "
    "is_valid boolean, gaps bigint, span_started_ns bigint, invalid_ns bigint"
)


class SequenceTracker(PacksInEventOrder):
    """Verdict of each frame of one (session_id, sid), and the validity of the stream.

    ``control`` is NULL for data, 'open' when the server has handed out the sid and 'close' when the sid is gone (unsubscribed, terminal
    error, lost connection); at one time, openings come before data and closings after. A life starts invalid, is made valid by a snapshot
    and invalid by a gap; a further gap does not restart the span. The row that ends a span carries its start. A closed life is
    discarded with its counter: frames after it are 'unregistered' until the sid is opened again, from nothing. A stream whose opening was not
    seen opens with its first frame, as life 0. Openings and closings count as breaks, so that no book outlives its subscription.

    Packs of ``names`` come out, verdicts and columns of the input; with ``split``, one for each value of that column, which stands beside
    it with the time of the pack's first row, and none for rows where it is NULL.
    """

    def __init__(self, names: list[str], split: str | None = None):
        self.names, self.split = names, split
        super().__init__("received_at_ns", 1_000_000)

    def order(self, table: pa.Table) -> np.ndarray:
        control = table.column("control")
        rank = pc.if_else(pc.is_null(control), 1, pc.if_else(pc.equal(control, "open"), 0, 2))
        return np.lexsort((pc.fill_null(table.column("seq"), -1).to_numpy(), rank.to_numpy(), self.times(table)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("stream", "life long, live boolean, last long, valid boolean, gaps long, since long, total long, breaks long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Warm start from the newest verdict row of the stream."""
        for table in opened([initialState]):
            for row in table.to_pylist():
                self.start(row)

    def start(self, r: dict) -> None:
        live = r["verdict"] not in ("retired", "unregistered")
        last = None
        if live and r["verdict"] != "registered":
            last = r["seq"] if r["is_snapshot"] else max(n for n in (r["high_water"], r["seq"]) if n is not None)
        self.state.update((r["life"], live, last, r["is_valid"], r["gaps"], r["open_since_ns"] if live else None, r["invalid_ns"], r["breaks"]))

    def act(self, key, tables: Iterable[pa.Table]) -> Iterator[pd.DataFrame]:
        state = self.state.get() if self.state.exists() else (0, None, None, False, 0, None, 0, 0)
        for table in tables:
            judged, state = self.judged(table, state)
            for name, column in judged.items():
                table = table.set_column(table.schema.get_field_index(name), name, column) if name in table.column_names else table.append_column(name, column)
            if self.split is None:
                yield pd.DataFrame({"pack": [packs.write(table.select(self.names))]})
            else:
                parts = list(packs.split(table.filter(pc.is_valid(table.column(self.split))), [self.split]))
                first = [part.slice(0, 1).to_pylist()[0] for part in parts]
                outer = {name: [row[name] for row in first] for name in (*STREAM_KEY, self.split, "received_at_ns")}
                if parts:
                    yield pd.DataFrame({**outer, "pack": [packs.write(part.select(self.names)) for part in parts]})
        self.state.update(state)

    @staticmethod
    def judged(table: pa.Table, state: tuple) -> tuple[dict[str, pa.Array], tuple]:
        """The verdict columns of a stream's next frames, and its state after them."""
        # ``live`` is None until the stream is first heard of.
        life, live, last, valid, gaps, since, total, breaks = state
        out = []
        for at, seq, snapshot, control in zip(*(table.column(c).to_pylist() for c in ("received_at_ns", "seq", "is_snapshot", "control"))):
            started, expected, skipped, broken = None, None, None, False
            if control == "open":
                if live and not valid:  # a sid handed out again ends the life before it
                    started = since
                life, live, last, valid, gaps, since, total, breaks = life + 1, True, None, False, 0, at, 0, breaks + 1
            elif control is None and live is None:
                live, since = True, at
            high = last
            if control == "open":
                verdict = "registered"
            elif not live:
                verdict, live = "unregistered", False
            elif control is not None:
                verdict, live, breaks = "retired", False, breaks + 1
                if not valid:
                    started, total = since, total + at - since
                valid, since, last = False, None, None
            else:
                broken = high is not None and seq > high + 1
                breaks += broken
                if snapshot:
                    verdict = "snapshot_initial" if high is None else "snapshot_continues" if seq > high else "snapshot_restarts"
                    last = seq
                    if not valid:
                        started, total, since, valid = since, total + at - since, None, True
                elif high is None:
                    verdict, last = "first", seq
                elif seq <= high:
                    verdict = "regression"
                elif broken:
                    verdict, expected, skipped, gaps, last = "gap", high + 1, seq - high - 1, gaps + 1, seq
                    if valid:
                        valid, since = False, at
                else:
                    verdict, last = "in_order", seq
            out.append((life, bool(snapshot), verdict, high, expected, skipped, broken, breaks, valid, gaps, started, total))
        return columns_of(out, JUDGED), (life, live, last, valid, gaps, since, total, breaks)


BOOK = (
    "session_id string, sid bigint, market_ticker string, epoch_ns bigint, epoch_seq bigint, received_at_ns bigint, seq bigint, outcome string, is_desync boolean, "
    "shows boolean, bid_micros bigint, bid_size bigint, ask_micros bigint, ask_size bigint, bid_depth bigint, ask_depth bigint"
)
SHOWN = (
    "epoch_ns bigint, epoch_seq bigint, outcome string, is_desync boolean, "
    "shows boolean, bid_micros bigint, bid_size bigint, ask_micros bigint, ask_size bigint, bid_depth bigint, ask_depth bigint"
)


BOOK_FRAME = [
    "session_id", "sid", "received_at_ns", "seq", "is_snapshot", "verdict", "is_break", "breaks", "market_ticker", "side", "price_micros", "delta_fp_units", "levels",
    "pricing_convention",
]


class LiveBook(StatefulProcessor):
    """The book of one (session_id, sid, market_ticker), from frames the tracker has put in order and numbered with the breaks of their stream.

    A book that was seeded before the stream's latest break is invalid, whichever market's frame showed the break; so no market
    has to be told. Its frames come in packs, which do not overlap in time. ``levels`` is a snapshot's JSON list of side, price and size. ``shows`` marks rows with the best levels of a valid book after a frame that touched it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.epoch = handle.getValueState("epoch", "at long, seq long, breaks long, broken boolean")
        self.levels = handle.getMapState("levels", "side string, price long", "size long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = sorted((at, data) for frame in rows for at, data in zip(frame["received_at_ns"], frame["pack"]))
        epoch = tuple(self.epoch.get()) if self.epoch.exists() else None
        sizes = {tuple(k): v[0] for k, v in self.levels.iterator()} if epoch else {}
        ladders = {side: sorted(p for s, p in sizes if s == side) for side in ("bid", "ask")}
        before = dict(sizes)
        for _, data in held:
            table = packs.read(data)
            rows, epoch, sizes, ladders = self.replay(table, epoch, sizes, ladders)
            outer = {c: table.column(c) for c in (*STREAM_KEY, "market_ticker", "received_at_ns", "seq")}
            yield pd.DataFrame({"pack": [packs.write(pa.table({**outer, **columns_of(rows, SHOWN)}))]})
        if epoch:
            self.epoch.update(epoch)
        for place in before.keys() - sizes.keys():
            self.levels.removeKey(place)
        for place, size in sizes.items():
            if before.get(place) != size:
                self.levels.updateValue(place, (size,))

    def replay(self, table: pa.Table, epoch: tuple | None, sizes: dict, ladders: dict) -> tuple[list[tuple], tuple | None, dict, dict]:
        out = []
        for at, seq, snapshot, verdict, is_break, breaks, side, price, delta, levels, convention in zip(*(table.column(c).to_pylist() for c in BOOK_FRAME[2:] if c != "market_ticker")):
            shows = desync = False
            if snapshot:
                epoch, outcome = (at, seq, breaks, False), "seed"
                sizes, ladders = {}, {"bid": [], "ask": []}
                for level in json.loads(levels or "[]"):
                    if level.get("side") and level["size_fp_units"]:
                        shows |= self.put(sizes, ladders, *canonical(level["side"], level["price_micros"], convention), level["size_fp_units"])
            elif epoch is None or epoch[3] or verdict == "unregistered":
                outcome = "discarded_invalid"
            elif breaks > epoch[2]:
                outcome = "gapped" if is_break and breaks == epoch[2] + 1 else "discarded_invalid"
            elif verdict == "regression":
                outcome = "regression"
            else:
                outcome = "applied"
                if price is not None and delta is not None:
                    side, price = canonical(side, price, convention)
                    size = sizes.get((side, price), 0) + delta
                    if size < 0:
                        desync, epoch = True, (*epoch[:3], True)
                    else:
                        shows = self.put(sizes, ladders, side, price, size)
            best = (None,) * 6
            if shows:
                bid, ask = (ladders["bid"] or [None])[-1], (ladders["ask"] or [None])[0]
                best = (bid, sizes.get(("bid", bid)), ask, sizes.get(("ask", ask)), len(ladders["bid"]), len(ladders["ask"]))
            where = epoch[:2] if epoch else (None, None)
            out.append((*where, outcome, desync, shows, *best))
        return out, epoch, sizes, ladders

    @staticmethod
    def put(sizes: dict, ladders: dict, side: str, price: int, size: int) -> bool:
        if size:
            if (side, price) not in sizes:
                insort(ladders[side], price)
            sizes[side, price] = size
        elif sizes.pop((side, price), None) is not None:
            del ladders[side][bisect_left(ladders[side], price)]
        return True

    def close(self) -> None:
        pass


def canonical(side: str, price: int, convention: str) -> tuple[str, int]:
    """A YES bid, or the YES ask that a NO bid stands for."""
    if side == "yes":
        return "bid", price
    if convention not in ("no_leg", "yes_leg"):
        raise ValueError(f"no pricing convention to read a NO price by: {convention!r}")
    return "ask", 1_000_000 - price if convention == "no_leg" else price


GRID_ROW = "market_ticker string, source string, observed_ms bigint, price_ranges_raw string"
GRID_VERDICT = f"{GRID_ROW}, verdict string"


class GridDetector(InEventOrder):
    """Each grid observation of one (market, source) as first, changed or unchanged; the last text is the state."""

    def __init__(self):
        super().__init__(["market_ticker", "source", "observed_ms", "price_ranges_raw"], ["observed_ms"], 1, GRID_BUCKET_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "price_ranges_raw string")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.last.update((initialState["price_ranges_raw"],))

    def act(self, key, rows: Iterable[tuple]) -> Iterator[Row]:
        last, verdict_row = self.last.get()[0] if self.last.exists() else None, row_of(GRID_VERDICT)
        for row in rows:
            verdict = "first_observation" if last is None else "unchanged" if last == row[3] else "changed"
            last = row[3]
            yield verdict_row(*row, verdict)
        if last is not None:
            self.last.update((last,))


SIGHTING = "market_ticker string, learned_via string, seen_ms bigint, rank int"
KNOWN = "market_ticker string, learned_via string, first_seen_ms bigint"


class Registry(PacksInEventOrder):
    """The first sighting of each market of a group; later ones change nothing and give nothing. Only the earliest of a market waits.

    Markets are dealt to groups by a hash, so that state is read and written for many at once. The names of the markets known are kept in parts,
    to which each release adds one; ``PARTS`` of them are joined.
    """

    PARTS = 8

    def __init__(self):
        super().__init__("seen_ms", 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getMapState("known", "part long", "markets binary")
        # The watermark acted up to, the number of parts, and the sightings that wait.
        self.held = handle.getValueState("held", "done long, parts long, waiting binary")
        self.due = handle.getValueState("due", "at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        done, parts, waiting = self.held.get() if self.held.exists() else (None, 0, None)
        for table in opened([initialState]):
            self.known.updateValue((parts,), (packs.write(table.select(["market_ticker"])),))
            parts += 1
        self.held.update((done, parts, waiting))

    def add(self, parts: int, before: list[pa.Table], markets: pa.Table) -> int:
        if parts + 1 < self.PARTS:
            self.known.updateValue((parts,), (packs.write(markets),))
            return parts + 1
        for part in range(1, parts):
            self.known.removeKey((part,))
        self.known.updateValue((0,), (packs.write(pa.concat_tables([*before, markets]).combine_chunks()),))
        return 1

    def release(self, key, tables: Iterator[pa.Table], watermark_ms: int) -> Iterator[pd.DataFrame]:
        done, parts, waiting = self.held.get() if self.held.exists() else (None, 0, None)
        before = [packs.read(self.known.getValue((part,))[0]) for part in range(parts)]
        names = pa.concat_tables(before).column("market_ticker").combine_chunks() if before else None
        held, count = [packs.read(waiting)] if waiting else [], 0
        for table in tables:
            table = self.on_time(table, done)
            if names is not None:
                table = table.filter(pc.invert(pc.is_in(table.column("market_ticker"), value_set=names)))
            held.append(table)
            count += table.num_rows
            if count >= FRESH_PACKED_ROWS:
                held, count = [self.earliest(held)], 0
        held = self.earliest(held) if held else None
        if held:
            passed = self.passed(self.times(held), watermark_ms)
            if passed.any():
                first = held.filter(pa.array(passed))
                parts, done = self.add(parts, before, first.select(["market_ticker"])), watermark_ms
                yield pd.DataFrame({"pack": [packs.write(first.select(["market_ticker", "learned_via", "seen_ms"]).rename_columns(["market_ticker", "learned_via", "first_seen_ms"]))]})
                held = held.filter(pa.array(~passed))
        self.held.update((done, parts, packs.write(held) if held else None))
        self.wake(int(self.times(held).min()) if held else None)

    def earliest(self, tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables).combine_chunks()
        code = packs.codes(table, ["market_ticker"])
        order = np.lexsort((pc.fill_null(table.column("rank"), -1).to_numpy(), self.times(table), code))
        return table.take(pa.array(order[np.flatnonzero(np.concatenate([[True], np.diff(code[order]) != 0]))])) if table else table
