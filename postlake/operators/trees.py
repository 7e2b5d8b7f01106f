"""Forest and boosted trees over sparse rows (M5, M6): work grows with the rows' entries, not with the columns.

MLlib's own learners bin every column of a row into a dense array, so one-hot
blocks cost rows times categories.  Here a row stays its few entries, and a
tree grows level by level as one job over all rows:

* each block of rows sums (rows, target) by (node, column, bin), for columns
  where it has an entry; the sums are grouped by column, and the best split of
  every node among the columns of a group is all that reaches the driver;
* a column of zeros and ones needs the sums of its ones alone, the rest is the
  node's total less these; any other column has ``maxBins`` quantile bins;
* a node's columns are drawn as ``(a * column + b) mod columns < k`` with a
  coprime to the number of columns: exactly k, without a list of them.

Parameters, the split rule (Gini and variance rank splits of 0/1 targets
alike), pruning, row sampling and the logistic loss are MLlib's: without
sampling the trees are its trees.  Blocks carry
their number and sums are added in its order, so the same rows in the same
partitions give the same model.  A model is a few numbers a node.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import _GBTClassifierParams, _ProbabilisticClassifierParams, _RandomForestClassifierParams
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import checkpoint_root, materialise

BLOCK_ROWS = 50_000
TREES_AT_ONCE = 50
QUANTILES = 4_096
CELLS_A_REDUCER = 50_000
HELD_ROWS = 1_000_000


@dataclass
class Block:
    """Rows of one partition: bins of the wide columns, the columns that are one, target and margin."""
    at: tuple[int, int]
    bins: np.ndarray
    ones: np.ndarray
    y: np.ndarray
    margin: np.ndarray | None = None


@dataclass
class Tree:
    """Nodes as arrays: an inner one sends rows with ``bin(column) > bin`` to ``left + 1``; a leaf has column -1."""
    number: int
    column: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int32))
    bin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    n: np.ndarray = field(default_factory=lambda: np.zeros(1))
    s: np.ndarray = field(default_factory=lambda: np.zeros(1))
    first_open: int = 0
    open: np.ndarray = field(default_factory=lambda: np.ones(1, bool))

    @property
    def value(self) -> np.ndarray:
        return np.divide(self.s, self.n, out=np.zeros_like(self.s), where=self.n > 0)


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of every stored number of sparse or dense vectors."""
    values = vectors.field("values")
    counts = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(counts)), counts)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    column[sparse[row]] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    return row, column, flat


def _packed(batches):
    """Rows as blocks of entries, numbered in their partition."""
    part, held, rows, number = TaskContext.get().partitionId(), [], 0, 0

    def out():
        starts = np.cumsum([0] + [len(y) for *_, y in held])
        row, column, value = (np.concatenate([h[k] + (starts[i] if k == 0 else 0) for i, h in enumerate(held)]) for k in range(3))
        block = pickle.dumps((row.astype(np.int32), column.astype(np.int32), value, np.concatenate([h[3] for h in held])))
        return pa.record_batch({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                                "block": pa.array([block], pa.binary())})

    for batch in batches:
        held.append((*_entries(pa.chunked_array([batch.column("v")]).combine_chunks()), batch.column("y").to_numpy(zero_copy_only=False)))
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield out()
            held, rows, number = [], 0, number + 1
    if rows:
        yield out()


def _quantiles(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the ascending values, evenly spaced by their counts, with the counts they stand for."""
    if len(values) <= most:
        return values, counts
    ends = np.cumsum(counts)
    at = np.unique(np.searchsorted(ends, ends[-1] * (np.arange(1, most + 1) / most), side="left").clip(0, len(values) - 1))
    return values[at], np.diff(np.concatenate([[0], ends[at]]))


def _thresholds(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Midpoints between neighbouring values; of many values, those at even shares of the rows."""
    kept = _quantiles(values, counts, max_bins)[0]
    after = np.searchsorted(values, kept[:-1], side="right")
    return (kept[:-1] + values[after]) / 2


@dataclass
class Layout:
    """The columns: how many, which are wide (not only zeros and ones), the wide ones' thresholds."""
    columns: int
    wide: np.ndarray
    thresholds: list[np.ndarray]

    @property
    def place(self) -> np.ndarray:
        """For each column its place among the wide ones, or -1."""
        if not hasattr(self, "_place"):
            self._place = np.full(self.columns, -1, np.int32)
            self._place[self.wide] = np.arange(len(self.wide))
        return self._place

    def dense(self, row, column, value, n) -> np.ndarray:
        """The wide columns' values, absent entries as zeros."""
        out = np.zeros((n, max(1, len(self.wide))))
        place = self.place[column]
        out[row[place >= 0], place[place >= 0]] = value[place >= 0]
        return out

    def split(self, row, column, value, n) -> tuple[np.ndarray, np.ndarray]:
        """Bins of the wide columns, and the other columns with a one, a row each (-1: none)."""
        wide = self.dense(row, column, value, n)
        bins = np.zeros(wide.shape, np.uint8 if max([len(t) for t in self.thresholds], default=0) < 256 else np.uint16)
        for k, t in enumerate(self.thresholds):
            bins[:, k] = np.searchsorted(t, wide[:, k], side="left")
        one = (self.place[column] < 0) & (value > 0.5)
        row, column = row[one], column[one]
        counts = np.bincount(row, minlength=n)
        ones = np.full((n, max(1, counts.max(initial=0))), -1, np.int32)
        ones[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = column
        return bins, ones


def descend(bins: np.ndarray, ones: np.ndarray, tree: Tree, place: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The node where each row ends, from the root or from the nodes where rows were before the tree grew."""
    node, moving = np.zeros(len(bins), np.int32) if start is None else start.copy(), np.arange(len(bins))
    while True:
        at = node[moving]
        column = tree.column[at]
        inner = column >= 0
        if not inner.any():
            return node
        moving, at, column = moving[inner], at[inner], column[inner]
        wide = place[column]
        right = np.where(wide >= 0, bins[moving, np.maximum(wide, 0)] > tree.bin[at], (ones[moving] == column[:, None]).any(1))
        node[moving] = tree.left[at] + right


def _blocks(dataset: DataFrame, features: str, label: str, max_bins: int) -> tuple[RDD, Layout]:
    """The rows in binned blocks (persisted), and their columns."""
    vector = F.unwrap_udt(features)
    width = dataset.select(F.coalesce(vector["size"], F.size(vector["values"])).alias("n")).first()
    rows = materialise(dataset.select(vector.alias("v"), F.col(label).cast("double").alias("y")).mapInArrow(
        _packed, "part int, number int, block binary"), "tree-rows")
    loaded = rows.rdd.map(lambda r: ((r.part, r.number), pickle.loads(bytes(r.block))))
    found = loaded.map(lambda b: (np.unique(b[1][1][(b[1][2] != 0) & (b[1][2] != 1)]), sorted(set(b[1][3])))).collect()
    if not found or not {y for _, ys in found for y in ys} <= {0.0, 1.0}:
        raise ValueError("labels must be 0 or 1, and there must be rows")
    layout = Layout(int(width.n), np.unique(np.concatenate([w for w, _ in found])).astype(np.int64), [])

    def counted(block):
        row, column, value, y = block[1]
        dense = layout.dense(row, column, value, len(y))
        return block[0], [_quantiles(*np.unique(dense[:, k], return_counts=True), QUANTILES) for k in range(len(layout.wide))]

    some = [c for _, c in sorted(loaded.map(counted).collect(), key=lambda c: c[0])]  # QUANTILES numbers a block and wide column
    for k in range(len(layout.wide)):
        values, inverse = np.unique(np.concatenate([c[k][0] for c in some]), return_inverse=True)
        layout.thresholds.append(_thresholds(values, np.bincount(inverse, np.concatenate([c[k][1] for c in some])), max_bins))

    def binned(block):
        row, column, value, y = block[1]
        return Block(block[0], *layout.split(row, column, value, len(y)), y)

    return loaded.map(binned).persist(StorageLevel.MEMORY_AND_DISK), layout


@dataclass
class _Level:
    """What a job over all rows needs to know."""
    trees: list[Tree]
    layout: Layout
    bins: int
    sample: object
    base: np.ndarray
    draws: tuple[np.ndarray, np.ndarray] | None
    k: int
    reducers: int
    least: int
    totals: bool
    n: np.ndarray
    s: np.ndarray

    def drawn(self, slot, column):
        if self.draws is None:
            return np.ones(len(slot), bool)
        a, b = self.draws
        return (a[slot] * column + b[slot]) % self.layout.columns < self.k


def _summed(index, w, wy, size):
    if size <= 4 * len(index) + 65_536:
        n, s = np.bincount(index, w, size), np.bincount(index, wy, size)
        at = np.flatnonzero(n)
        return at, n[at], s[at]
    at, inverse = np.unique(index, return_inverse=True)
    return at, np.bincount(inverse, w), np.bincount(inverse, wy)


def _sums(block: Block, level: _Level):
    """A block's sums by (node, column, bin), dealt to the reducers by column."""
    columns, wide, out = level.layout.columns, level.layout.wide, []
    totals = np.zeros((2, len(level.trees)))
    for i, tree in enumerate(level.trees):
        w, y = level.sample(block, tree.number, level.layout)
        totals[:, i] = w.sum(), (w * y).sum()
        slot = level.sample.nodes(block, tree, level.layout) - tree.first_open
        rows = np.flatnonzero((w > 0) & (slot >= 0) & tree.open[np.maximum(slot, 0)])
        slot, w, wy, base, slots = slot[rows].astype(np.int64), w[rows], (w * y)[rows], level.base[i], len(tree.open)
        for k, column in enumerate(wide):
            mine = np.flatnonzero(level.drawn(slot + base, column))
            index = slot[mine] * level.bins + block.bins[rows[mine], k]
            at, n, s = _summed(index, w[mine], wy[mine], slots * level.bins)
            out.append((((at // level.bins + base) * columns + column) * level.bins + at % level.bins, n, s))
        for k in range(block.ones.shape[1]):
            column = block.ones[rows, k].astype(np.int64)
            mine = np.flatnonzero((column >= 0) & level.drawn(slot + base, column))
            at, n, s = _summed(slot[mine] * columns + column[mine], w[mine], wy[mine], slots * columns)
            out.append(((at + base * columns) * level.bins + 1, n, s))
    key, n, s = (np.concatenate([o[k] for o in out]) for k in range(3))
    reducer = key // level.bins % columns % level.reducers
    order = np.argsort(reducer, kind="stable")
    cuts = np.searchsorted(reducer[order], np.arange(level.reducers + 1))
    for r in range(level.reducers):
        mine = order[cuts[r]:cuts[r + 1]]
        if level.totals or len(mine):
            yield r, (block.at, key[mine], n[mine], s[mine], totals if level.totals else None)


def _first_of(slot, *ranked):
    """For each slot the place of its first row by ``ranked``."""
    order = np.lexsort((*reversed(ranked), slot))
    return order[np.unique(slot[order], return_index=True)[1]]


def _best(parts, level: _Level):
    """The best split of each node among these columns: (slot, gain, column, bin, right rows, right target)."""
    parts = sorted(parts, key=lambda p: p[0])
    all_n, all_s = level.n, level.s
    if level.totals:
        all_n, all_s = np.sum([p[4] for p in parts], axis=0)
    key, inverse = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
    n, s = (np.bincount(inverse, np.concatenate([p[k] for p in parts]), len(key)) for k in (2, 3))
    group, bin_ = np.divmod(key, level.bins)
    slot, column = np.divmod(group, level.layout.columns)
    wide = level.layout.place[column] >= 0
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(np.append(starts, len(group)))
    to = [np.cumsum(x) - np.repeat((np.cumsum(x) - x)[starts], sizes) for x in (n, s)]
    right_n, right_s = np.where(wide, all_n[slot] - to[0], n), np.where(wide, all_s[slot] - to[1], s)
    left_n, left_s = all_n[slot] - right_n, all_s[slot] - right_s
    fine = (right_n >= max(1, level.least)) & (left_n >= max(1, level.least))
    slot, column, bin_, wide, right_n, right_s, left_n, left_s = (
        x[fine] for x in (slot, column, bin_, wide, right_n, right_s, left_n, left_s))
    gain = left_s ** 2 / left_n + right_s ** 2 / right_n - all_s[slot] ** 2 / all_n[slot]
    bin_ = np.where(wide, bin_, 0)
    at = _first_of(slot, -gain, column, bin_)
    return (slot[at], gain[at], column[at], bin_[at], right_n[at], right_s[at]), (all_n, all_s)


def _subset(strategy: str, columns: int, trees: int) -> int:
    """How many columns a node looks at, as MLlib names it."""
    s = strategy.lower()
    if s == "auto":
        s = "all" if trees == 1 else "sqrt"
    if s in ("all", "sqrt", "log2", "onethird"):
        return {"all": columns, "sqrt": math.ceil(math.sqrt(columns)), "log2": max(1, math.ceil(math.log2(columns))),
                "onethird": math.ceil(columns / 3)}[s]
    x = float(s)
    return min(columns, int(x)) if s.isdigit() else max(1, min(columns, math.ceil(x * columns)))


def _grow(blocks: RDD, layout: Layout, trees: list[Tree], sample, params, strategy_trees: int, gini: bool) -> None:
    """Grow the trees together, one level a job."""
    get = params.getOrDefault
    bins = max([2] + [len(t) + 1 for t in layout.thresholds])
    k = _subset(get("featureSubsetStrategy"), layout.columns, strategy_trees)
    coprime = np.flatnonzero(np.gcd(np.arange(layout.columns), layout.columns) == 1)
    ways = blocks.getNumPartitions()
    for depth in range(max(1, get("maxDepth"))):
        slots = np.array([len(t.open) for t in trees])
        base = np.concatenate([[0], np.cumsum(slots)[:-1]])
        rngs = [np.random.default_rng([get("seed") & 0xFFFFFFFF, t.number, depth, 1]) for t in trees]
        draws = None if k >= layout.columns else (
            np.concatenate([r.choice(coprime, c) for r, c in zip(rngs, slots)]),
            np.concatenate([r.integers(layout.columns, size=c) for r, c in zip(rngs, slots)]))
        now_n, now_s = (np.concatenate([getattr(t, x)[t.first_open:] for t in trees]) for x in "ns")
        reducers = int(min(ways, 1 + slots.sum() * min(k, 2_000) // CELLS_A_REDUCER))
        level = _Level(trees, layout, bins, sample, base, draws, k, reducers, get("minInstancesPerNode"), depth == 0, now_n, now_s)
        found = (blocks.flatMap(lambda b, level=level: _sums(b, level)).groupByKey(reducers)
                 .map(lambda p, level=level: _best(p[1], level)).collect())
        if depth == 0:
            now_n, now_s = found[0][1]
            for t, n, s in zip(trees, now_n, now_s):
                t.n[0], t.s[0] = n, s
        if get("maxDepth") == 0 or not found:
            return
        slot, gain, column, bin_, right_n, right_s = (np.concatenate([f[0][x] for f in found]) for x in range(6))
        at = _first_of(slot, -gain, column, bin_)
        fall = gain[at] / now_n[slot[at]] * (2 if gini else 1)
        at = at[(fall > 1e-12) & (fall >= get("minInfoGain"))]  # 1e-12: rounding of the sums
        going = False
        for i, t in enumerate(trees):
            mine = at[(slot[at] >= base[i]) & (slot[at] < base[i] + slots[i])]
            node = t.first_open + slot[mine] - base[i]
            size = len(t.column)
            t.column[node], t.bin[node], t.left[node] = column[mine], bin_[mine], size + 2 * np.arange(len(mine))
            both = lambda left, right: np.stack([left, right], 1).ravel()
            n, s = both(t.n[node] - right_n[mine], right_n[mine]), both(t.s[node] - right_s[mine], right_s[mine])
            for x, more in (("column", np.full(len(n), -1, np.int32)), ("bin", np.zeros(len(n), np.int32)),
                            ("left", np.zeros(len(n), np.int32)), ("n", n), ("s", s)):
                setattr(t, x, np.concatenate([getattr(t, x), more]))
            t.first_open, t.open = size, (n > 1) & ((s > 0) & (s < n) if gini else True)
            going |= bool(t.open.any())
        if not going:
            return
        trees = [t for t in trees if t.open.any()]


def _pruned(tree: Tree) -> Tree:
    """As in MLlib, sibling leaves of one class (a tie: 0) become their parent's leaf, again and again."""
    positive = 2 * tree.s > tree.n
    while True:
        inner = np.flatnonzero(tree.column >= 0)
        left = tree.left[inner]
        same = (tree.column[left] < 0) & (tree.column[left + 1] < 0) & (positive[left] == positive[left + 1])
        if not same.any():
            return tree
        positive[inner[same]] = positive[left[same]]
        tree.column[inner[same]] = -1


def _weights(seed: int, tree: int, at: tuple[int, int], n: int, rate: float, replace: bool) -> np.ndarray:
    """How often the tree takes each row of a block."""
    rng = np.random.default_rng([seed & 0xFFFFFFFF, tree, *at])
    if replace:
        return rng.poisson(rate, n).astype(float)
    return np.ones(n) if rate >= 1 else (rng.random(n) < rate).astype(float)


#: What a Python worker keeps of boosting between jobs, by fit and block: margins, sample and nodes.  A worker without them computes them.
_HELD: OrderedDict[tuple[str, tuple[int, int]], dict] = OrderedDict()


def _held(fit: str, block: Block) -> dict:
    """What this worker has of the block; of one fit at a time, and of ``HELD_ROWS`` rows at most, the latest used."""
    if _HELD and next(iter(_HELD))[0] != fit:
        _HELD.clear()
    mine = _HELD.setdefault((fit, block.at), {"rows": len(block.y)})
    _HELD.move_to_end((fit, block.at))
    while len(_HELD) > 1 and sum(h["rows"] for h in _HELD.values()) > HELD_ROWS:
        _HELD.popitem(last=False)
    return mine


@dataclass
class _Bootstrap:
    """A forest's rows and targets: the labels."""
    seed: int
    rate: float
    replace: bool

    def __call__(self, block, tree, layout):
        return _weights(self.seed, tree, block.at, len(block.y), self.rate, self.replace), block.y

    def nodes(self, block, tree, layout):
        return descend(block.bins, block.ones, tree, layout.place)


@dataclass
class _Residuals:
    """A boosting round's rows and targets: the labels at first, then the falling gradient of the logistic loss.

    ``recent`` are the trees after the first ``since``, whose margins the blocks hold.  What a round or level needs of
    those before it is kept in the worker, so that a level costs a step down the tree, not the walks through all recent ones.
    """
    seed: int
    rate: float
    recent: list[tuple[Tree, float]]
    since: int = 0
    fit: str = ""

    def __call__(self, block, tree, layout):
        held = _held(self.fit, block)
        number, sample = held.get("sample", (None, None))
        if number != tree:
            w, y = _weights(self.seed, tree, block.at, len(block.y), self.rate, False), 2 * block.y - 1
            sample = w, y if tree == 0 else 4 * y / (1 + np.exp(2 * y * self.margin(block, layout)))
            held["sample"] = tree, sample
        return sample

    def margin(self, block: Block, layout: Layout) -> np.ndarray:
        """The block's margins with the recent trees added."""
        held = _held(self.fit, block)
        done, out = held.get("margin", (-1, None))
        if not self.since <= done <= self.since + len(self.recent):
            done, out = self.since, np.zeros(len(block.y)) if block.margin is None else block.margin
        out = out.copy()
        for tree, weight in self.recent[done - self.since:]:
            out += weight * tree.value[self.nodes(block, tree, layout)]
        held["margin"] = self.since + len(self.recent), out
        return out

    def nodes(self, block: Block, tree: Tree, layout: Layout) -> np.ndarray:
        """The node where each row ends."""
        held = _held(self.fit, block)
        number, size, start = held.get("nodes", (None, 0, None))
        node = descend(block.bins, block.ones, tree, layout.place, start if number == tree.number and size <= len(tree.column) else None)
        held["nodes"] = tree.number, len(tree.column), node
        return node


class _Learner(Estimator, _ProbabilisticClassifierParams, DefaultParamsReadable, DefaultParamsWritable):
    def _model(self, layout: Layout, trees: list[Tree], weights: list[float], boosted: bool) -> TreesModel:
        model = TreesModel(layout, trees, weights)
        model._set(boosted=boosted, **{p: self.getOrDefault(p) for p in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol")})
        return model


class ForestClassifier(_Learner, _RandomForestClassifierParams):
    """M5: probabilities averaged over trees of bootstrapped rows; the parameters of MLlib's RandomForestClassifier."""

    @keyword_only
    def __init__(self, *, numTrees=None, maxDepth=None, seed=None, labelCol=None, featuresCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TreesModel:
        get = self.getOrDefault
        count = get("numTrees")
        sample = _Bootstrap(get("seed"), get("subsamplingRate"), get("bootstrap"))
        blocks, layout = _blocks(dataset, get("featuresCol"), get("labelCol"), get("maxBins"))
        trees = [Tree(k) for k in range(count)]
        try:
            for k in range(0, count, TREES_AT_ONCE):
                _grow(blocks, layout, trees[k:k + TREES_AT_ONCE], sample, self, count, True)
        finally:
            blocks.unpersist()
        return self._model(layout, [_pruned(t) for t in trees], [1.0] * count, False)


class BoostedClassifier(_Learner, _GBTClassifierParams):
    """M6: logistic-loss gradient boosting as MLlib's GBTClassifier does it, with its parameters."""

    @keyword_only
    def __init__(self, *, maxIter=None, maxDepth=None, stepSize=None, subsamplingRate=None, featureSubsetStrategy=None, seed=None,
                 lossType=None, labelCol=None, featuresCol=None, checkpointInterval=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TreesModel:
        get = self.getOrDefault
        checkpoint_root(dataset.sparkSession)
        blocks, layout = _blocks(dataset, get("featuresCol"), get("labelCol"), get("maxBins"))
        every = get("checkpointInterval") if get("checkpointInterval") > 0 else 10
        trees, weights, since, fit = [], [], 0, uuid.uuid4().hex
        try:
            for round_ in range(get("maxIter")):
                now = _Residuals(get("seed"), get("subsamplingRate"), list(zip(trees[since:], weights[since:])), since, fit)
                if len(now.recent) >= every:  # the margins are written, so neither work nor lineage grows with the rounds
                    old, blocks = blocks, blocks.map(lambda b, r=now, y=layout: Block(b.at, b.bins, b.ones, b.y, r.margin(b, y))).persist(
                        StorageLevel.MEMORY_AND_DISK)
                    blocks.checkpoint()
                    blocks.count()
                    old.unpersist()
                    since = len(trees)
                    now = _Residuals(now.seed, now.rate, [], since, fit)
                tree = Tree(round_)
                _grow(blocks, layout, [tree], now, self, 1, False)
                trees.append(tree)
                weights.append(1.0 if round_ == 0 else get("stepSize"))
        finally:
            blocks.unpersist()
        return self._model(layout, trees, weights, True)


class TreesModel(Model, _ProbabilisticClassifierParams, MLReadable, MLWritable):
    """Fitted trees: adds raw prediction, probability and prediction."""

    boosted = Param(Params._dummy(), "boosted", "margins of boosted trees rather than a forest's mean", TypeConverters.toBoolean)

    def __init__(self, layout: Layout | None = None, trees: list[Tree] | None = None, weights: list[float] | None = None):
        super().__init__()
        self.layout, self.trees, self.weights = layout, trees or [], weights or []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.sql.functions import arrow_udf

        shared = dataset.sparkSession.sparkContext.broadcast((self.layout, self.trees, self.weights))

        def total(vectors: pa.Array) -> pa.Array:
            layout, trees, weights = shared.value
            bins, ones = layout.split(*_entries(vectors), len(vectors))
            out = np.zeros(len(vectors))
            for tree, weight in zip(trees, weights):
                out += weight * tree.value[descend(bins, ones, tree, layout.place)]
            return pa.array(out)

        total.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
        get = self.getOrDefault
        raw = arrow_udf(total, "double")(F.unwrap_udt(get("featuresCol")))
        if get("boosted"):
            low, p = -F.col("_total"), 1 / (1 + F.exp(-2 * F.col("_total")))
        else:
            low, p = len(self.trees) - F.col("_total"), F.col("_total") / len(self.trees)
        return (dataset.withColumn("_total", raw).withColumn("_p", p)
                .withColumns({get("rawPredictionCol"): array_to_vector(F.array(low, "_total")),
                              get("probabilityCol"): array_to_vector(F.array(1 - F.col("_p"), "_p")),
                              get("predictionCol"): (F.col("_p") > 0.5).cast("double")}).drop("_total", "_p"))

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreesReader()


class _TreesWriter(MLWriter):
    def __init__(self, instance: TreesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m, spark = self.instance, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark)
        nodes = [(t.number, w, t.column.tolist(), t.bin.tolist(), t.left.tolist(), t.n.tolist(), t.s.tolist()) for t, w in zip(m.trees, m.weights)]
        spark.createDataFrame(nodes, "number int, weight double, column array<int>, bin array<int>, left array<int>, n array<double>, s array<double>"
                              ).write.parquet(f"{path}/trees")
        spark.createDataFrame([(m.layout.columns, m.layout.wide.tolist(), [t.tolist() for t in m.layout.thresholds])],
                              "columns int, wide array<long>, thresholds array<array<double>>").write.parquet(f"{path}/layout")


class _TreesReader(MLReader):
    def load(self, path: str) -> TreesModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        at = spark.read.parquet(f"{path}/layout").first()
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r.number)
        trees = [Tree(r.number, *(np.array(r[x], np.int32) for x in ("column", "bin", "left")), np.array(r.n), np.array(r.s)) for r in rows]
        model = TreesModel(Layout(at.columns, np.array(at.wide, np.int64), [np.array(t, float) for t in at.thresholds]), trees, [r.weight for r in rows])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
