"""Statistics of trailing windows over time-sorted slices, in numpy inside Spark's tasks.

Sorted by time, the window of an anchor is a run of rows, and so is that of one hour
of day when rows are sorted by hour before time. Statistics of runs come from two
structures over the sorted values:

- *records* (``_Records``): sums, means with squared deviations and log sums of aligned runs of
  1, 2, 4, ... rows. A window joins the at most 2 log n records it consists of, by
  M2 = M2_a + M2_b + d^2 n_a n_b / n. Nothing is ever subtracted, so no value outside
  a window touches it, be it NaN, infinite or 1e16;
- *a descent by bits* (``_ranks``): values are replaced by their rank; bit after bit, rows are
  dealt into zeros and ones, in order, and every question goes on in the part that holds its
  rank. The number of steps is the bit length of the rank, fixed before the first step.

A task works through many small slices as one array: slice numbers lead the sort keys.

A slice that is too large for one task is worked on by hours and by parts of the value (``whole_hours``,
``opening_hours``, ``part_ranks``). All anchors of an hour see the same whole hours, and each of them the end of
the one hour where its window opens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows that a task works on at a time; a slice is never cut. A row takes some 2 KB while four blocks are worked out.
CHUNK_ROWS = 50_000
#: Bits of a sort key below the slice number.
_SHIFT = 40
DAY = 86_400


class _Records:
    """Mergeable records of aligned runs of values; ``over`` joins those of a window."""

    def __init__(self, v: np.ndarray, logs: bool) -> None:
        self.levels = []
        level = {"sum": v, "mean": v, "m2": np.zeros(len(v))}
        if logs:
            level["ln"] = np.where((v > 0) | np.isnan(v), np.log(np.where((v > 0) | np.isnan(v), v, 1.0)), 0.0)
        size = 1
        while len(level["sum"]):
            self.levels.append(level)
            half = len(level["sum"]) // 2
            a = {k: x[: 2 * half : 2] for k, x in level.items()}
            b = {k: x[1 : 2 * half : 2] for k, x in level.items()}
            d = b["mean"] - a["mean"]
            level = {"sum": a["sum"] + b["sum"], "mean": a["mean"] + d / 2, "m2": a["m2"] + b["m2"] + d * d * (size / 2)}
            if logs:
                level["ln"] = a["ln"] + b["ln"]
            size *= 2
        self.strange = np.concatenate([[0], np.cumsum(~np.isfinite(v))])
        self.positive = np.concatenate([[0], np.cumsum((v > 0) | np.isnan(v))])
        self.logs = logs

    def over(self, lo: np.ndarray, hi: np.ndarray) -> dict[str, np.ndarray]:
        """n, sum, m2 and ln of the values in each [lo, hi)."""
        n = np.zeros(len(lo))
        out = {"sum": np.zeros(len(lo)), "mean": np.zeros(len(lo)), "m2": np.zeros(len(lo)), "ln": np.zeros(len(lo))}
        left, right = lo.copy(), hi.copy()

        def join(at: np.ndarray, node: np.ndarray, size: int, level: dict) -> None:
            own = n[at]
            d = level["mean"][node] - out["mean"][at]
            both = own + size
            out["m2"][at] += level["m2"][node] + np.where(own > 0, d * d * (own * size / both), 0.0)
            out["mean"][at] += d * (size / both)
            out["sum"][at] += level["sum"][node]
            if self.logs:
                out["ln"][at] += level["ln"][node]
            n[at] = both

        size = 1
        for level in self.levels:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                break
            at = open_[(left[open_] & 1) == 1]
            join(at, left[at], size, level)
            left[at] += 1
            at = open_[((right[open_] & 1) == 1) & (left[open_] < right[open_])]
            right[at] -= 1
            join(at, right[at], size, level)
            left >>= 1
            right >>= 1
            size *= 2
        # Without a finite mean there are no deviations from it.
        out["m2"][self.strange[hi] > self.strange[lo]] = np.nan
        out["positive"] = self.positive[hi] - self.positive[lo]
        return out


def _descend(now: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For every question the code of the k-th smallest (from 0) of now[lo:hi], and the rest of k among
    those of the same code. With weights a row counts that many times."""
    lo, hi, k = lo.copy(), hi.copy(), k.copy()
    found = np.zeros(len(k), np.int64)
    zeros = np.zeros(len(now) + 1, np.int64)
    heavy = zeros if weights is None else zeros.copy()
    for bit in range(int(now.max(initial=1)).bit_length() - 1, -1, -1):
        one = (now >> bit) & 1 == 1
        np.cumsum(~one, out=zeros[1:])
        if weights is not None:
            np.cumsum(np.where(one, 0, weights), out=heavy[1:])
            weights = np.concatenate([weights[~one], weights[one]])
        a, b, below = zeros[lo], zeros[hi], heavy[hi] - heavy[lo]
        up = k >= below
        k -= np.where(up, below, 0)
        found |= up.astype(np.int64) << bit
        lo, hi = np.where(up, zeros[-1] + lo - a, a), np.where(up, zeros[-1] + hi - b, b)
        now = np.concatenate([now[~one], now[one]])
    return found, k


def _ranks(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The k-th smallest (from 0, below hi - lo) of v[lo:hi], for every question; NaN is the largest."""
    order = np.argsort(v, kind="stable")
    now = np.empty(len(v), np.int32)
    now[order] = np.arange(len(v), dtype=np.int32)
    return v[order[_descend(now, lo, hi, k)[0]]] if len(v) else np.zeros(0)


class _Sorted:
    """History in the order of slice (and hour, if asked for) and time: where windows begin and end."""

    def __init__(self, group: np.ndarray, cell: np.ndarray, sec: np.ndarray, known: np.ndarray, hourly: bool) -> None:
        self.group, self.cell, self.sec = group, cell, sec
        if hourly:
            self.group = group * 24 + cell % 24
        order = np.argsort(self.group, kind="stable") if hourly else np.arange(len(group))
        self.order = {True: order[known[order]], False: order[~known[order]]}
        self.keys = {k: (self._key(self.group[o], sec[o]), self._key(self.group[o], cell[o])) for k, o in self.order.items()}

    @staticmethod
    def _key(group: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (group << _SHIFT) | at

    def runs(self, known: bool, anchors: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
        """[lo, hi) of each anchor's window among the known values, or the others."""
        by_sec, by_cell = self.keys[known]
        group = self.group[anchors]
        lo = np.searchsorted(by_sec, self._key(group, np.maximum(self.sec[anchors] - back, 0)))
        hi = np.searchsorted(by_cell, self._key(group, self.cell[anchors]))
        return lo, np.maximum(lo, hi)


def _figures(group, cell, sec, v, known, anchors, blocks, align: str, quantiles) -> dict[str, np.ndarray]:
    back = {b.days: b.days * DAY if align == "hour" else b.days for b in blocks}
    sorted_, out = {}, {}
    for hourly in {b.same_hour for b in blocks} | ({False} if any(b.geomean_over == "window" for b in blocks) else set()):
        sorted_[hourly] = _Sorted(group, cell, sec, known, hourly)
    for hourly in {b.same_hour for b in blocks}:
        s = sorted_[hourly]
        own = [(i, b) for i, b in enumerate(blocks) if b.same_hour == hourly]
        values = v[s.order[True]]
        records = _Records(values, any("geomean" in b.stats for _, b in own))
        asked: list[tuple] = []
        for i, b in own:
            lo, hi = s.runs(True, anchors, back[b.days])
            blank_lo, blank_hi = s.runs(False, anchors, back[b.days])
            size = hi - lo
            got = records.over(lo, hi)
            out[f"_nv{i}"], out[f"_n{i}"] = size, size + blank_hi - blank_lo
            some = size > 0
            out[f"_mean{i}"] = np.ma.array(got["sum"] / np.maximum(size, 1), mask=~some)
            if "stddev" in b.stats:
                out[f"_m2{i}"] = np.ma.array(got["m2"], mask=~some)
            if "geomean" in b.stats:
                out[f"_ln{i}"] = np.ma.array(got["ln"], mask=got["positive"] == 0)
                out[f"_nwin{i}"] = out[f"_n{i}"]
                if b.geomean_over == "window":
                    whole = [sorted_[False].runs(k, anchors, back[b.days]) for k in (True, False)]
                    out[f"_nwin{i}"] = sum(y - x for x, y in whole)
            at = np.flatnonzero(some)
            for j, p in enumerate(quantiles):
                asked.append((f"_q{i}_{j}", at, lo[at], hi[at], np.maximum(np.ceil(p * size[at]).astype(np.int64), 1) - 1))
        answers = _ranks(values, *(np.concatenate([a[x] for a in asked]) for x in (2, 3, 4)))
        done = 0
        for name, at, *_ in asked:
            column = np.ma.masked_all(len(anchors))
            column[at] = answers[done : done + len(at)]
            out[name] = column
            done += len(at)
    return out


def _chunks(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str] = ("_e", "_slice"), history: bool = False
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups (slices), about ``CHUNK_ROWS`` rows at a time, and where groups begin.

    With ``history`` a group's history (``_kind`` 0) leads its questions, and a group with many questions
    comes in several chunks, each with the history.
    """

    def starts(t: pa.Table) -> np.ndarray:
        new = np.ones(t.num_rows, bool)
        if t.num_rows > 1:
            differs = [pc.not_equal(t[c].slice(1), t[c].slice(0, t.num_rows - 1)) for c in keys]
            new[1:] = reduce(pc.or_, differs).to_numpy()
        return new

    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < CHUNK_ROWS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        new = starts(t)
        last = int(np.flatnonzero(new)[-1])
        if history and (asked := t["_kind"].slice(last).to_numpy()).any():
            yield t, new
            held = t.slice(last, int(np.argmax(asked))).combine_chunks().to_batches()
            # Questions fill a chunk of their own beside the history.
            rows = 0
        elif last:
            yield t.slice(0, last), new[:last]
            held = t.slice(last).combine_chunks().to_batches()
            rows = t.num_rows - last
        else:
            held = t.to_batches()
    if rows:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, starts(t)


def _from_base(cell: np.ndarray, sec: np.ndarray, blocks: Sequence, align: str) -> tuple[np.ndarray, np.ndarray]:
    """Times from a day well before the first row; the hour of day stays."""
    longest = max(b.days for b in blocks) + 1
    if align == "hour":
        base = cell.min() // 24 * 24 - longest * 24
        return cell - base, sec - base * 3600
    base = cell.min() - longest
    return cell - base, sec - base


def statistics(blocks: Sequence, align: str, quantiles: Sequence[float], duplicate_anchors: bool, schema: pa.Schema):
    """For ``mapInArrow``: rows (_e, _slice, _ts, _cell, _sec, _v, _own), sorted by slice and time ->
    one row per anchor with history in at least one block."""

    def run(batches):
        for t, new in _chunks(batches):
            group = np.cumsum(new) - 1
            cell, sec = _from_base(t["_cell"].to_numpy().astype(np.int64), t["_sec"].to_numpy().astype(np.int64), blocks, align)
            v, known = t["_v"].fill_null(0.0).to_numpy(), t["_v"].is_valid().to_numpy()
            ts = t["_ts"].cast(pa.int64()).to_numpy()
            first = new | (np.diff(ts, prepend=ts[0] - 1) != 0)
            runs = np.flatnonzero(first)
            anchors = runs[t["_own"].to_numpy()[runs]]
            times = np.diff(runs, append=len(ts))[t["_own"].to_numpy()[runs]] if duplicate_anchors else np.ones(len(anchors), np.int64)
            with np.errstate(all="ignore"):
                out = _figures(group, cell, sec, v, known, anchors, blocks, align, quantiles)
            some = np.flatnonzero(np.any([out[f"_n{i}"] > 0 for i in range(len(blocks))], axis=0))
            columns = {"_e": t["_e"].take(pa.array(anchors[some])), "_ts": t["_ts"].take(pa.array(anchors[some])), "_times": pa.array(times[some])}
            for name, x in out.items():
                x = x[some]
                columns[name] = pa.array(np.ma.getdata(x), mask=np.ma.getmaskarray(x)) if np.ma.isMaskedArray(x) else pa.array(x)
            yield from pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema).combine_chunks().to_batches()

    return run


# -- slices that are too large for one task ------------------------------------------

#: What rows are folded to: counts of rows and of values, moments, logs, and values that are not finite.
FOLDED = ("n", "nv", "sum", "mean", "m2", "ln", "pos", "odd")


def _joined(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out = {k: a[k] + b[k] for k in FOLDED}
    share = b["nv"] / np.maximum(out["nv"], 1)
    d = np.where((a["nv"] > 0) & (b["nv"] > 0), b["mean"] - a["mean"], 0.0)
    out["mean"] = np.where(a["nv"] > 0, a["mean"] + d * share, b["mean"])
    out["m2"] += d * d * (a["nv"] * share)
    return out


class _Folds:
    """Mergeable records of aligned runs of rows that are folds themselves."""

    def __init__(self, rows: dict[str, np.ndarray]) -> None:
        self.levels = [rows]
        while (half := len(self.levels[-1]["n"]) // 2) > 0:
            level = self.levels[-1]
            self.levels.append(_joined({k: x[: 2 * half : 2] for k, x in level.items()}, {k: x[1 : 2 * half : 2] for k, x in level.items()}))

    def over(self, lo: np.ndarray, hi: np.ndarray) -> dict[str, np.ndarray]:
        out = {k: np.zeros(len(lo)) for k in FOLDED}
        left, right = lo.copy(), hi.copy()

        def join(at: np.ndarray, node: np.ndarray, level: dict) -> None:
            both = _joined({k: x[at] for k, x in out.items()}, {k: x[node] for k, x in level.items()})
            for k, x in both.items():
                out[k][at] = x

        for level in self.levels:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                break
            at = open_[(left[open_] & 1) == 1]
            join(at, left[at], level)
            left[at] += 1
            at = open_[((right[open_] & 1) == 1) & (left[open_] < right[open_])]
            right[at] -= 1
            join(at, right[at], level)
            left >>= 1
            right >>= 1
        return out


def whole_hours(blocks: Sequence, spans: Sequence[int], schema: pa.Schema):
    """For ``mapInArrow``: folds by cell (``_part`` -1) and counts by cell and part (0, 1, ...), sorted by slice and
    cell -> per block and cell with anchors the fold and the counts of its window, without the cell where it opens."""

    def run(batches):
        for t, new in _chunks(batches):
            cells, parts = t["_cell"].to_numpy(), t["_part"].to_numpy()
            own, nv = t["_own"].to_numpy(), t["nv"].to_numpy()
            folds = {k: t[k].to_numpy() for k in FOLDED}
            ends = np.append(np.flatnonzero(new), t.num_rows)
            out = {k: [] for k in ("_row", "_block", "_cell", "nwin", "_counts", *FOLDED)}
            for first, end in zip(ends[:-1], ends[1:]):
                stat = first + np.flatnonzero(parts[first:end] < 0)
                asked = cells[stat[own[stat]]]
                cell = cells[stat]
                dealt = first + np.flatnonzero(parts[first:end] >= 0)
                counts = np.zeros((len(cell) + 1, parts[dealt].max(initial=-1) + 1), np.int64)
                np.add.at(counts, (np.searchsorted(cell, cells[dealt]) + 1, parts[dealt]), nv[dealt].astype(np.int64))
                sums, ordered = {}, {}
                for hourly in {False} | {b.same_hour for b in blocks}:
                    order = np.argsort(cell % 24, kind="stable") if hourly else np.arange(len(cell))
                    base = np.concatenate([counts[:1], counts[1:][order]])
                    key = _hour_key(cell[order], hourly)
                    sums[hourly], ordered[hourly] = np.cumsum(base, axis=0), (key, _Folds({k: x[stat][order] for k, x in folds.items()}))
                for i, b in enumerate(blocks):
                    key, found = ordered[b.same_hour]
                    since = asked - spans[i] + 24 if b.same_hour else asked - spans[i] + 1
                    lo, hi = np.searchsorted(key, _hour_key(since, b.same_hour)), np.searchsorted(key, _hour_key(asked, b.same_hour))
                    for k, x in found.over(lo, hi).items():
                        out[k].append(x)
                    key, found = ordered[False]
                    out["nwin"].append(found.over(np.searchsorted(key, _hour_key(asked - spans[i] + 1, False)), np.searchsorted(key, _hour_key(asked, False)))["n"])
                    out["_counts"].append(sums[b.same_hour][hi] - sums[b.same_hour][lo])
                    out["_row"].append(np.full(len(asked), first))
                    out["_block"].append(np.full(len(asked), i))
                    out["_cell"].append(asked)
            lists = out.pop("_counts")
            sizes = np.concatenate([np.full(len(x), x.shape[1]) for x in lists])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns = {k: np.concatenate(x) for k, x in out.items()}
            row = pa.array(columns.pop("_row"))
            columns = {k: pa.array(x) for k, x in columns.items()} | {"_e": t["_e"].take(row), "_slice": t["_slice"].take(row)}
            columns["_counts"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([x.ravel() for x in lists])))
            yield from pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema).combine_chunks().to_batches(10_000)

    return run


def _hour_key(cell: np.ndarray, hourly: bool) -> np.ndarray:
    return ((cell % 24) << _SHIFT) + cell if hourly else cell


def opening_hours(blocks: Sequence, align: str, quantiles: Sequence[float], schema: pa.Schema):
    """For ``mapInArrow``: sorted by slice, block and cell of the anchors, the folds by second and part of the cell where
    their windows open (``_kind`` 0), the window's whole cells (1) and the anchors (2) -> per anchor the fold of
    its window and, per quantile, the part that holds it and its rank there."""
    backs = np.array([b.days * DAY if align == "hour" else b.days for b in blocks])

    def run(batches):
        for t, new in _chunks(batches, ("_e", "_slice", "_block", "_cell")):
            group, kind = np.cumsum(new) - 1, t["_kind"].to_numpy()
            sec = t["_sec"].to_numpy()
            opening, whole, anchors = (np.flatnonzero(kind == x) for x in range(3))
            if not len(anchors):
                continue
            # Seconds count from the earliest one that a window can open at; whole cells come last in a group.
            start = sec[anchors] - backs[t["_block"].to_numpy()[anchors]]
            base = min(start.min(), sec[opening].min(initial=start.min()))
            key = lambda g, at: (g << _SHIFT) | (at - base)
            g = group[anchors]
            keys = key(group[opening], sec[opening])
            folds = {k: t[k].to_numpy() for k in FOLDED}
            late = _Folds({k: x[opening] for k, x in folds.items()}).over(np.searchsorted(keys, key(g, start)), np.searchsorted(keys, (g + 1) << _SHIFT))
            mine = whole[np.searchsorted(group[whole], g)]
            got = _joined({k: x[mine] for k, x in folds.items()}, late)
            nv = got["nv"].astype(np.int64)
            columns = {k: t[k].take(pa.array(anchors)) for k in ("_e", "_slice", "_block", "_cell", "_sec")}
            columns |= {"n": pa.array(got["n"]), "nv": pa.array(nv), "nwin": pa.array(t["nwin"].to_numpy()[mine] + late["n"])}
            columns["mean"] = pa.array(got["sum"] / np.maximum(nv, 1), mask=nv == 0)
            columns["m2"] = pa.array(np.where(got["odd"] > 0, np.nan, got["m2"]), mask=nv == 0)
            columns["ln"] = pa.array(got["ln"], mask=got["pos"] == 0)
            lists = t["_counts"].take(pa.array(whole)).combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            counts = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(whole)), sizes)
            part = np.arange(len(counts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            some = opening[t["_part"].to_numpy()[opening] >= 0]
            full = np.flatnonzero(counts)
            codes = np.concatenate([t["_part"].to_numpy()[some], part[full]]).astype(np.int64)
            weights = np.concatenate([folds["nv"][some].astype(np.int64), counts[full]])
            keys = np.concatenate([key(group[some], sec[some]), ((group[whole][owner[full]] + 1) << _SHIFT) - 1])
            order = np.argsort(keys, kind="stable")
            keys, known = keys[order], np.flatnonzero(nv)
            lo, hi = np.searchsorted(keys, key(g, start)[known]), np.searchsorted(keys, (g[known] + 1) << _SHIFT)
            for j, p in enumerate(quantiles):
                ask = np.maximum(np.ceil(p * nv[known]).astype(np.int64), 1) - 1
                for name, x in zip(("_part", "_rank"), _descend(codes[order], lo, hi, ask, weights[order])):
                    column = np.ma.masked_all(len(anchors), np.int64)
                    column[known] = x
                    columns[f"{name}{j}"] = pa.array(np.ma.getdata(column), mask=np.ma.getmaskarray(column))
            yield from pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema).combine_chunks().to_batches(10_000)

    return run


def part_ranks(blocks: Sequence, align: str, schema: pa.Schema):
    """For ``mapInArrow``: sorted by slice and part, the part's rows (``_kind`` 0, by second) and the questions of anchors
    (1: block, rank among the part's rows in the window) -> the questions' values."""
    backs = [b.days * DAY if align == "hour" else b.days for b in blocks]

    def run(batches):
        for t, new in _chunks(batches, ("_e", "_slice", "_part"), history=True):
            asked = t["_kind"].to_numpy() == 1
            if not asked.any():
                continue
            group, block, rank = np.cumsum(new) - 1, t["_block"].to_numpy(), t["_rank"].to_numpy()
            cell, sec = _from_base(t["_cell"].to_numpy(), t["_sec"].to_numpy(), blocks, align)
            v = t["_v"].to_numpy()
            found = np.zeros(t.num_rows)
            for hourly in {b.same_hour for b in blocks}:
                s = _Sorted(group, cell, sec, ~asked, hourly)
                values = v[s.order[True]]
                asks = []
                for i, b in enumerate(blocks):
                    if b.same_hour == hourly and len(at := np.flatnonzero(asked & (block == i))):
                        asks.append((at, *s.runs(True, at, backs[i]), rank[at]))
                if asks:
                    at, lo, hi, k = (np.concatenate(x) for x in zip(*asks))
                    found[at] = _ranks(values, lo, hi, k)
            at = np.flatnonzero(asked)
            answered = t.take(pa.array(at))
            columns = {f.name: answered[f.name] for f in schema if f.name != "_value"} | {"_value": pa.array(found[at])}
            yield from pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema).combine_chunks().to_batches(10_000)

    return run
