"""Intervals of column values that passes cut ever finer, where it matters.

Doubles are read as whole numbers of the same order, so an interval can always be cut between
two values.  A pass adds up two channels per interval and finds its least and greatest value;
these are sums, minima and maxima, so neither partitioning nor the order of merging shows in
them.  Equal-mass cuts and exact tree splits both start from few intervals and read again only
those that are not settled."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskframe.operators.partials import DIRECT_TASKS
from riskframe.operators.placement import Kept

LEAST, GREATEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FIRST = 1_024  # intervals of the first pass
PIECES = 64  # intervals that an unsettled one becomes
SCHEMA = "slot int, pos int, a double, b double, lo long, hi long"


def encode(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one."""
    bits = (np.asarray(x, dtype=np.float64) + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & GREATEST)


def decode(codes: np.ndarray) -> np.ndarray:
    codes = np.asarray(codes, dtype=np.int64)
    return (codes ^ ((codes >> 63) & GREATEST)).view(np.float64)


def pieces(lo: int, hi: int, n: int) -> np.ndarray:
    """Upper ends of about ``n`` parts of [lo, hi]; its first and last value are parts of their own."""
    span = int(hi) - int(lo)
    step = max(1, -(-span // n))
    ends = np.uint64(int(lo) & (2**64 - 1)) + np.arange(0, span, step, dtype=np.uint64)
    return np.unique(np.append(ends.view(np.int64), [np.int64(hi - 1), np.int64(hi)]))


@dataclass
class Intervals:
    """Disjoint intervals in order: least and greatest value, and the sums of two channels."""

    lo: np.ndarray
    hi: np.ndarray
    a: np.ndarray
    b: np.ndarray

    @property
    def open(self) -> np.ndarray:
        """Intervals of more than one value."""
        return self.lo < self.hi

    def ends(self, which: np.ndarray, n: int) -> np.ndarray:
        """Upper ends that part the chosen intervals, and keep what lies between them apart."""
        parts = []
        for i in np.flatnonzero(which):
            if self.lo[i] > LEAST:
                parts.append([self.lo[i] - 1])
            parts.append(pieces(self.lo[i], self.hi[i], n))
        return np.unique(np.concatenate(parts)).astype(np.int64)

    def refined(self, which: np.ndarray, finer: Intervals) -> Intervals:
        """The chosen intervals replaced by the parts of them that hold rows."""
        owner = np.searchsorted(self.lo, finer.lo, side="right") - 1
        inside = (owner >= 0) & which[np.maximum(owner, 0)] & (finer.hi <= self.hi[np.maximum(owner, 0)])
        joined = [np.concatenate([x[~which], y[inside]]) for x, y in zip((self.lo, self.hi, self.a, self.b), (finer.lo, finer.hi, finer.a, finer.b))]
        order = np.argsort(joined[0], kind="stable")
        return Intervals(*(x[order] for x in joined))


def stats(codes: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums, minimum and maximum of every interval up to an end, and of what lies beyond the last."""
    cell, n = np.searchsorted(ends, codes, side="left"), len(ends) + 1
    lo, hi = np.full(n, GREATEST), np.full(n, LEAST)
    np.minimum.at(lo, cell, codes)
    np.maximum.at(hi, cell, codes)
    return np.bincount(cell, a, n), np.bincount(cell, b, n), lo, hi


def merged(one: tuple | None, other: tuple) -> tuple:
    if one is None:
        return other
    return one[0] + other[0], one[1] + other[1], np.minimum(one[2], other[2]), np.maximum(one[3], other[3])


def found(total: tuple) -> Intervals:
    a, b, lo, hi = total
    held = lo <= hi
    return Intervals(lo[held], hi[held], a[held], b[held])


Kernel = Callable[[pa.RecordBatch], dict[int, tuple]]


def interval_sums(rows: Kept, kernel: Kernel) -> dict[int, Intervals]:
    """The intervals that hold rows, per slot.  Tasks add up their batches; the parts of many
    tasks meet in a shuffle, those of a few on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, tuple] = {}
        for batch in batches:
            if batch.num_rows:
                for slot, part in kernel(batch).items():
                    acc[slot] = merged(acc.get(slot), part)
        for slot, (a, b, lo, hi) in acc.items():
            pos = np.flatnonzero(lo <= hi)
            columns = [np.full(len(pos), slot, dtype=np.int32), pos.astype(np.int32), a[pos], b[pos], lo[pos], hi[pos]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "pos", "a", "b", "lo", "hi"])

    parts = rows.df.mapInArrow(run, SCHEMA)
    if rows.tasks > DIRECT_TASKS:
        parts = parts.groupBy("slot", "pos").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    table = parts.toArrow()
    slot, pos, a, b, lo, hi = (table.column(c).to_numpy() for c in ("slot", "pos", "a", "b", "lo", "hi"))
    out = {}
    for s in np.unique(slot):
        mine = slot == s
        at, which = np.unique(pos[mine], return_inverse=True)
        low, high = np.full(len(at), GREATEST), np.full(len(at), LEAST)
        np.minimum.at(low, which, lo[mine])
        np.maximum.at(high, which, hi[mine])
        out[int(s)] = Intervals(low, high, np.bincount(which, a[mine], len(at)), np.bincount(which, b[mine], len(at)))
    return out


def equal_mass_cuts(total: Callable[[Kernel], dict[int, Intervals]], read: Callable, ranges: Sequence[tuple[int, int]], n: int) -> list[np.ndarray]:
    """Per column the codes of the values that begin a new one of ``n`` parts of equal mass: those
    before which at least t/n of the rows lie, for some t, and before whose predecessor less.

    ``total`` runs a kernel over all rows, ``read`` gives a batch's codes and whole-number
    weights.  The mass of intervals is counted, those that hold one of the n - 1 wanted ranks are
    parted, until each such interval is one value: the cuts are exact, whatever the partitioning.
    """
    known: list[Intervals | None] = [None] * len(ranges)
    asked = {f: pieces(lo, hi, FIRST) if lo < hi else np.array([hi]) for f, (lo, hi) in enumerate(ranges)}
    parted: dict[int, np.ndarray] = {}
    while asked:

        def kernel(batch: pa.RecordBatch, asked=asked) -> dict[int, tuple]:
            codes, weight = read(batch)
            return {f: stats(codes[:, f], ends, weight, weight) for f, ends in asked.items()}

        fresh = total(kernel)
        asked, again = {}, {}
        for f, finer in fresh.items():
            known[f] = finer if known[f] is None else known[f].refined(parted[f], finer)
        for f in fresh:
            cells = known[f]
            which = np.zeros(len(cells.lo), dtype=bool)
            which[_holders(cells, n)] = True
            which &= cells.open
            if which.any():
                again[f], asked[f] = which, cells.ends(which, PIECES)
        parted = again
    cuts = []
    for cells in known:
        after = np.unique(_holders(cells, n)) + 1 if cells is not None else np.empty(0, dtype=int)
        cuts.append(cells.lo[after[after < len(cells.lo)]] if cells is not None else np.empty(0, dtype=np.int64))
    return cuts


def _holders(cells: Intervals, n: int) -> np.ndarray:
    """The interval of the row before which a part has to end, for each of the n - 1 ends."""
    below = np.cumsum(np.rint(cells.a).astype(np.int64))
    mass = int(below[-1])
    ranks = np.array([-(-t * mass // n) - 1 for t in range(1, n)], dtype=np.int64)
    return np.searchsorted(below, ranks[ranks >= 0], side="right")


# ---- exact splits ----------------------------------------------------------------------


@dataclass
class SplitSearch:
    """The best split of a node by a convex gain, over all values of its rows.

    Between two intervals the gain is known.  Inside one the sums of the left side lie in the
    rectangle that its two channels span, and a convex gain is greatest in a corner; two corners
    are the interval's ends, so the other two bound what a split inside can still win.  Where
    they fall short of the best known split, or an interval holds one value or one channel only,
    it is never read again."""

    rule: object
    tie: float
    cells: list[Intervals | None]

    def _gains(self, f: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The left sums at the end of every interval but the last, and their gains."""
        cells = self.cells[f]
        left = np.column_stack([np.cumsum(cells.a), np.cumsum(cells.b)])[:-1]
        return left, self.rule.gains(left, sums - left, sums)

    def sums(self) -> np.ndarray:
        cells = self.cells[0]
        return np.array([cells.a.sum(), cells.b.sum()])

    def best(self) -> tuple[float, int, int, np.ndarray] | None:
        """(gain, feature, code of the cut, left sums); equal gains go to the lower feature, then the lower cut."""
        sums = self.sums()
        sides = [self._gains(f, sums) for f in range(len(self.cells))]
        top = max((g.max() for _, g in sides if g.size), default=-np.inf)
        if not np.isfinite(top):
            return None
        for f, (left, gains) in enumerate(sides):
            at = np.flatnonzero(gains >= top - self.tie * abs(top))
            if at.size:
                i, cells = int(at[0]), self.cells[f]
                return float(gains[i]), f, _between(cells.hi[i], cells.lo[i + 1]), left[i]
        return None

    def unsettled(self) -> dict[int, np.ndarray]:
        """Per feature the intervals that may hold a better split."""
        sums, found = self.sums(), self.best()
        floor = -np.inf if found is None else found[0] - self.tie * abs(found[0])
        out = {}
        for f, cells in enumerate(self.cells):
            before = np.column_stack([np.cumsum(cells.a) - cells.a, np.cumsum(cells.b) - cells.b])
            none = np.zeros(len(cells.a))
            corners = [before + np.column_stack(c) for c in ((cells.a, none), (none, cells.b))]
            bound = np.max([np.maximum(self.rule.gains(np.minimum(c, sums), np.maximum(sums - c, 0), sums), 0.0) for c in corners], axis=0)
            which = cells.open & (cells.a > 0) & (cells.b > 0) & (bound >= floor)
            if which.any():
                out[f] = which
        return out


def _between(left: int, right: int) -> int:
    """The code of the mean of two neighbouring values, which is below the right one."""
    a, b = decode(np.array([left, right]))
    middle = a / 2 + b / 2
    return int(encode(np.array([middle if a <= middle < b else a]))[0])
