"""Decision trees grown by Spark passes.

Features are binned once into one byte string per row.  A pass adds up, per open node,
feature and bin, two channels (gradient and hessian, or the weights of the two classes);
Spark combines the partial histograms and the driver chooses the splits.  Where a feature has
too many values for bins and splits are to be exact, rows hold the values themselves and passes
narrow the intervals in which a split can still be best.  Rows never move."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted, require_columns
from riskframe.operators.intervals import FIRST, decode, encode, equal_mass_cuts, interval_sums, pieces
from riskframe.operators.partials import matrix, vector
from riskframe.operators.placement import keep_for_passes, occupied_partitions, with_task

TIE = 1e-10  # relative gain difference below which two splits count as equal
FOLD = 8  # rows that one of a folded table has to stand for
FOLD_BINNED = 4  # the same where the number of bins says it for certain
ROUNDING = 1e-13  # share of a node's sums that a difference may leave of nothing


# ---- binning ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Cuts:
    """Cut points per feature.  ``value`` cuts send x < cut to the left, ``midpoint`` cuts
    x <= cut; bin b is left of cut c exactly when b <= c."""

    features: list[str]
    points: list[np.ndarray]
    at: str

    @property
    def dtype(self):
        return np.dtype("u1") if max((len(p) for p in self.points), default=0) < 256 else np.dtype("<u2")

    @property
    def n_bins(self) -> int:
        return max((len(p) for p in self.points), default=0) + 1

    def threshold(self, feature: int, cut: int) -> float:
        return float(self.points[feature][cut])

    def bin(self, x: np.ndarray) -> np.ndarray:
        _refuse_nan(x)
        side = "right" if self.at == "value" else "left"
        out = np.empty(x.shape, dtype=self.dtype)
        for f, points in enumerate(self.points):
            out[:, f] = np.searchsorted(points, x[:, f], side=side)
        return out


def _refuse_nan(x: np.ndarray) -> None:
    if np.isnan(x).any():
        raise ValueError("features of a tree model must not be null or NaN; impute first")


@dataclass(frozen=True)
class ExactCuts:
    """No bins: rows hold the codes of their values and a cut is the code of a threshold, x <= cut
    to the left.  ``starts``: per feature the ends of the intervals that a split search begins with."""

    features: list[str]
    starts: list[np.ndarray]

    dtype = np.dtype("<i8")

    def threshold(self, feature: int, cut: int) -> float:
        return float(decode(np.array([cut]))[0])

    def bin(self, x: np.ndarray) -> np.ndarray:
        _refuse_nan(x)
        return encode(np.ascontiguousarray(x))


@dataclass(frozen=True)
class Scan:
    """What one look at the features tells: all values of those with few, the range of the others."""

    features: list[str]
    few: dict[int, np.ndarray]
    ranges: dict[int, tuple[float, float]]
    fold: int | None  # rows after folding, if rows repeat often enough for that
    occupied: int  # tasks that hold rows
    rows: int

    def folded(self, cuts: Cuts | ExactCuts) -> int | None:
        """Rows after folding with two labels, or nothing if that is not worth it: columns of many values
        may leave few different rows once they are in bins."""
        if self.fold is not None or isinstance(cuts, ExactCuts):
            return self.fold
        most = 2 * math.prod(len(p) + 1 for p in cuts.points)
        return most if most * FOLD_BINNED <= self.rows else None


def scan_features(df: DataFrame, x: Sequence[str], max_bins: int) -> Scan:
    require_columns(df, x)
    wide = df.select(*[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(x)])
    names = wide.columns
    seen = with_task(wide).agg(
        F.count("*").alias("n"),
        F.approx_count_distinct(F.xxhash64(*names)).alias("rows"),
        occupied_partitions().alias("occupied"),
        *[F.approx_count_distinct(c).alias(c) for c in names],
        *[F.min(c).alias(f"lo_{c}") for c in names],
        *[F.max(c).alias(f"hi_{c}") for c in names],
    ).first()
    few = [c for c in names if seen[c] <= 1.2 * max_bins]
    # at most about 1.5 * max_bins values per feature by the sketch above
    values = wide.agg(*[F.collect_set(F.when(~F.isnan(c), F.col(c))).alias(c) for c in few]).first().asDict() if few else {}
    listed = {i: np.unique(np.array(values[c], dtype=float) + 0.0) for i, c in enumerate(names) if len(values.get(c, ())) <= max_bins and c in values}
    ranges = {i: (seen[f"lo_{c}"], seen[f"hi_{c}"]) for i, c in enumerate(names) if i not in listed}
    return Scan(list(x), listed, ranges, 2 * seen["rows"] if seen["rows"] * FOLD <= seen["n"] else None, seen["occupied"], seen["n"])


def find_cuts(df: DataFrame, scan: Scan, max_bins: int, at: str) -> Cuts | ExactCuts:
    """Cuts between all values of features with few.  Of others, ``value`` cuts make parts of
    equal mass, by exact counts, so they are the same for any partitioning; for ``midpoint`` cuts
    there are no bins then, and splits are searched among all values."""
    if at == "midpoint" and scan.ranges:
        ends = {f: pieces(*_codes(r), FIRST) for f, r in scan.ranges.items()}
        return ExactCuts(scan.features, [ends[f] if f in ends else encode(scan.few[f]) for f in range(len(scan.features))])
    points = {f: v[1:] if at == "value" else (v[1:] + v[:-1]) / 2 for f, v in scan.few.items()}
    if scan.ranges:
        many = sorted(scan.ranges)
        ranges = [_codes(scan.ranges[f]) for f in many]
        names = [scan.features[f] for f in many]
        packed = df.select(feature_array(names).alias("x"), F.lit(0.0).alias("y"))
        kept = keep_for_passes(_coded(packed, ExactCuts(names, [])).withColumn("n", F.lit(1.0)), scan.occupied)
        read = lambda batch: (byte_matrix(batch, "bins", len(names), ExactCuts.dtype), vector(batch, "n"))
        for f, codes in zip(many, equal_mass_cuts(lambda kernel: interval_sums(kept, kernel), read, ranges, max_bins)):
            points[f] = decode(codes)
        kept.release()
    return Cuts(scan.features, [points[f] for f in range(len(scan.features))], at)


def _codes(values: tuple[float, float]) -> tuple[int, int]:
    lo, hi = encode(np.array([math.nan if v is None else v for v in values], dtype=float))
    return int(lo), int(hi)


def feature_array(x: Sequence[str]):
    return F.array(*[quoted(c).cast("double") for c in x])


def byte_matrix(batch: pa.RecordBatch, name: str, width: int, dtype: np.dtype) -> np.ndarray:
    """A binary column of equal-sized rows as an (n, width) matrix over the Arrow buffer."""
    column = batch.column(batch.schema.get_field_index(name))
    offset = np.dtype("i8") if pa.types.is_large_binary(column.type) else np.dtype("i4")
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, dtype=offset)[column.offset]
    flat = np.frombuffer(data, dtype=dtype, count=len(column) * width, offset=int(start))
    return flat.reshape(len(column), width)


def byte_column(values: np.ndarray) -> pa.Array:
    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize * values.shape[1]
    offsets = np.arange(0, (len(values) + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _coded(packed: DataFrame, cuts: Cuts | ExactCuts) -> DataFrame:
    """``(x, y[, n])`` to ``(bins, y[, n])``."""
    names = ["bins", *packed.columns[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = cuts.bin(matrix(batch, "x"))
                yield pa.RecordBatch.from_arrays([byte_column(bins), *batch.columns[1:]], names=names)

    return packed.mapInArrow(run, ", ".join(["bins binary", *[f"{c} double" for c in names[1:]]]))


def binned(df: DataFrame, y: str, cuts: Cuts | ExactCuts, fold: bool = False, repeated: bool = False) -> DataFrame:
    """``(bins binary, y double, n double)``; equal rows become one row with a count if folding.
    Where the values themselves are ``repeated``, they are counted before they are coded."""
    label = quoted(y).cast("double").alias("y")
    if fold and repeated:
        values = [quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(cuts.features)]
        names = [f"x{i}" for i in range(len(values))]
        counts = df.select(*values, label).groupBy(*names, "y").agg(F.count("*").cast("double").alias("n"))
        out = _coded(counts.select(F.array(*names).alias("x"), "y", "n"), cuts)
        # codes of values are as different as the values
        return out if isinstance(cuts, ExactCuts) else out.groupBy("bins", "y").agg(F.sum("n").alias("n"))
    out = _coded(df.select(feature_array(cuts.features).alias("x"), label), cuts)
    if fold:
        return out.groupBy("bins", "y").agg(F.count("*").cast("double").alias("n"))
    return out.withColumn("n", F.lit(1.0))


# ---- trees -----------------------------------------------------------------------------


@dataclass
class Tree:
    """Node arrays; a leaf has feature -1.  ``cut`` is a bin position or the code of a value, ``cover`` the hessian
    or weight that reached the node in training."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    depth: int
    weight: float = 1.0
    error: float = 0.0

    def route(self, bins: np.ndarray) -> np.ndarray:
        """Leaf position of every row; a leaf is its own child, so all rows take equal steps."""
        n, width = bins.shape
        leaf = self.feature < 0
        own = np.arange(len(leaf))
        feature = np.where(leaf, 0, self.feature).astype(np.int64)
        child = np.column_stack([np.where(leaf, own, self.left), np.where(leaf, own, self.right)]).ravel()
        flat, start = bins.ravel(), np.arange(n, dtype=np.int64) * width
        node = np.zeros(n, dtype=np.int64)
        for _ in range(self.depth):
            right = flat.take(start + feature.take(node)) > self.cut.take(node)
            node = child.take(2 * node + right)
        return node


@dataclass
class Node:
    sums: np.ndarray  # the two channels
    depth: int
    split: tuple | None = None  # (gain, feature, cut)
    known: bool = False
    left: int = -1
    right: int = -1
    hist: np.ndarray | None = None  # kept while the children may be taken from it


@dataclass
class NewtonRule:
    """Second-order gain with L2 leaf penalty and a floor on the child hessian."""

    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    eta: float = 0.3

    def gains(self, left: np.ndarray, right: np.ndarray, node: np.ndarray) -> np.ndarray:
        def score(s):
            return s[..., 0] ** 2 / np.maximum(s[..., 1] + self.reg_lambda, 1e-300)

        gain = score(left) + score(right) - score(node)
        heavy = (left[..., 1] >= self.min_child_weight) & (right[..., 1] >= self.min_child_weight)
        return np.where(heavy & (gain > 1e-6), gain, -np.inf)

    def terminal(self, sums: np.ndarray) -> bool:
        return sums[1] < 2 * self.min_child_weight

    def leaf(self, sums: np.ndarray) -> float:
        return float(-self.eta * sums[0] / (sums[1] + self.reg_lambda))

    def cover(self, sums: np.ndarray) -> float:
        return float(sums[1])


@dataclass
class GiniRule:
    """Weighted Gini decrease; channels are the weights of class 0 and class 1."""

    def gains(self, left: np.ndarray, right: np.ndarray, node: np.ndarray) -> np.ndarray:
        def impurity(s):
            w = s.sum(axis=-1)
            return 2 * s[..., 0] * s[..., 1] / np.where(w > 0, w, 1.0)

        gain = impurity(node) - impurity(left) - impurity(right)
        both = (left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0)
        return np.where(both, np.maximum(gain, 0.0), -np.inf)

    def terminal(self, sums: np.ndarray) -> bool:
        w = sums.sum()
        return w <= 0 or 2 * sums[0] * sums[1] / w**2 <= np.finfo(float).eps

    def leaf(self, sums: np.ndarray) -> float:
        eps = np.finfo(float).eps
        p = np.clip(sums / sums.sum(), eps, None)
        return float((np.log(p[1]) - np.log(p[0])) / 2)

    def cover(self, sums: np.ndarray) -> float:
        return float(sums.sum())


def best_split(hist: np.ndarray, rule) -> tuple[float, int, int, np.ndarray] | None:
    """Best (gain, feature, cut, left sums) of a (feature, bin, channel) histogram; equal gains
    go to the lower feature, then the lower cut."""
    left = hist.cumsum(axis=1)[:, :-1]
    node = hist[0].sum(axis=0)
    gains = rule.gains(left, node - left, node)
    if gains.size == 0 or not np.isfinite(gains.max()):
        return None
    top = gains.max()
    f, c = divmod(int(np.flatnonzero(gains.ravel() >= top - TIE * abs(top))[0]), gains.shape[1])
    return float(gains[f, c]), f, c, left[f, c]


@dataclass
class Grower:
    """Grows one tree from histograms.  Every node with a known histogram is split on trial,
    so the next pass can serve all nodes that may still be chosen; with a leaf cap the tree
    finally takes the trial splits in order of gain until the cap is reached."""

    rule: object
    max_depth: int | None = None
    max_leaves: int | None = None
    nodes: list[Node] = field(default_factory=list)
    chosen: set[int] = field(default_factory=set)

    def __post_init__(self):
        self.nodes = [Node(np.zeros(2), 0)]

    def wanted(self) -> list[int]:
        """Nodes whose histogram the next pass has to bring; empty when the tree is complete."""
        self.chosen, heap, blocked = set(), [], []

        def look(i: int) -> None:
            node = self.nodes[i]
            if not node.known:
                blocked.append(i)
            elif node.split:
                heapq.heappush(heap, (-node.split[0], i))

        look(0)
        room = (self.max_leaves - 1) if self.max_leaves else None
        while heap and not (blocked and room is not None) and (room is None or len(self.chosen) < room):
            _, i = heapq.heappop(heap)
            self.chosen.add(i)
            look(self.nodes[i].left)
            look(self.nodes[i].right)
        if blocked and room is not None:
            # the next choice depends on these; add the children of the best other trial splits
            for _, i in heapq.nsmallest(room - len(self.chosen), heap):
                blocked += [j for j in (self.nodes[i].left, self.nodes[i].right) if not self.nodes[j].known]
        return blocked

    def feed(self, i: int, hist: np.ndarray, keep: bool = False) -> None:
        """Takes the histogram of a node; with ``keep`` it stays for the children."""
        found = self.feed_split(i, hist[0].sum(axis=0), lambda: best_split(hist, self.rule))
        if found and keep:
            self.nodes[i].hist = hist

    def halves(self, asked: list[int]) -> tuple[list[int], list[tuple[int, int, int]]]:
        """Of two children asked for, the lighter one is counted and the other is what remains of
        the parent: (nodes to count, (node, parent, counted sibling))."""
        wanted, derived = set(asked), []
        for p, node in enumerate(self.nodes):
            if node.hist is not None and node.left in wanted and node.right in wanted:
                pair = (node.left, node.right)
                light = min(pair, key=lambda k: self.rule.cover(self.nodes[k].sums))
                heavy = pair[0] + pair[1] - light
                wanted.discard(heavy)
                derived.append((heavy, p, light))
        return [i for i in asked if i in wanted], derived

    def remainder(self, parent: int, hist: np.ndarray) -> np.ndarray:
        """The histogram of the other child; what only rounding leaves is nothing."""
        whole = self.nodes[parent].hist
        rest = whole - hist
        floor = ROUNDING * np.abs(whole).sum(axis=(0, 1)) / len(whole)
        rest[np.abs(rest) < floor] = 0.0
        return np.maximum(rest, 0.0) if isinstance(self.rule, GiniRule) else rest

    def release(self, parents: Iterable[int]) -> None:
        for p in parents:
            self.nodes[p].hist = None

    def feed_split(self, i: int, sums: np.ndarray, search: Callable[[], tuple | None]) -> bool:
        """Takes the sums of a node and, if it is open, its best split."""
        node = self.nodes[i]
        if i == 0:
            node.sums = sums
        node.known = True
        if self._closed(node):
            return False
        found = search()
        if found is None:
            return False
        gain, f, c, left = found
        node.split = (gain, f, c)
        for sums in (left, node.sums - left):
            child = Node(np.maximum(sums, 0) if isinstance(self.rule, GiniRule) else sums, node.depth + 1)
            child.known = self._closed(child)
            self.nodes.append(child)
        node.left, node.right = len(self.nodes) - 2, len(self.nodes) - 1
        return True

    def _closed(self, node: Node) -> bool:
        return (self.max_depth is not None and node.depth >= self.max_depth) or self.rule.terminal(node.sums)

    def routing(self) -> tuple[Tree, np.ndarray]:
        """Trial tree for routing rows, and the node id at each of its positions."""
        return self._build({i for i, n in enumerate(self.nodes) if n.split})

    def tree(self) -> Tree:
        return self._build(self.chosen)[0]

    def leaf_nodes(self) -> list[Node]:
        inner = self.chosen
        kids = {0} | {k for i in inner for k in (self.nodes[i].left, self.nodes[i].right)}
        return [self.nodes[i] for i in sorted(kids - inner)]

    def _build(self, inner: set[int]) -> tuple[Tree, np.ndarray]:
        order = [0]
        for i in order:  # grows while it is read: breadth first
            if i in inner:
                order += [self.nodes[i].left, self.nodes[i].right]
        at = {i: k for k, i in enumerate(order)}
        ns = [self.nodes[i] for i in order]
        is_inner = [i in inner for i in order]
        return Tree(
            feature=np.array([n.split[1] if t else -1 for n, t in zip(ns, is_inner)], dtype=np.int32),
            cut=np.array([n.split[2] if t else 0 for n, t in zip(ns, is_inner)], dtype=np.int64),
            left=np.array([at[n.left] if t else -1 for n, t in zip(ns, is_inner)], dtype=np.int32),
            right=np.array([at[n.right] if t else -1 for n, t in zip(ns, is_inner)], dtype=np.int32),
            value=np.array([0.0 if t or not n.sums.any() else self.rule.leaf(n.sums) for n, t in zip(ns, is_inner)]),
            cover=np.array([self.rule.cover(n.sums) for n in ns]),
            gain=np.array([n.split[0] if t else 0.0 for n, t in zip(ns, is_inner)]),
            depth=max(n.depth for n in ns),
        ), np.array(order)
