"""Random forests and extremely randomised trees of open depth.

Growing. A table of at most HELD_BYTES (of at most `bound` rows, if that is set) goes whole, packed, to tasks
that each grow a share of the trees. Trees of larger tables grow together: while a node holds more than `bound`
rows (by default, as many as have CELLS values) its split is found by Spark: one aggregation a level over (tree, node, feature), of bins for best splits, of least and
greatest values and then of the counts at drawn thresholds for random splits. Rows of smaller nodes are
dealt to (tree, node) groups, and each group, at most `bound` rows, grows its subtree in a task. Nothing
but splits of large nodes reaches the driver while trees grow.

Trees. Every node tries `tries` features that differ among its rows, in drawn order. Best splits cut
between neighbouring values (in large nodes between `bins` quantiles) where the weighted Gini impurity
falls most; random splits draw one threshold uniformly between the least and greatest value of each
feature and keep the best. Draws are hashes of seed, tree, node and feature, bootstrap counts (Poisson
of mean 1) hashes of row and tree, so a forest doesn't depend on the partitions or on `bound`, but for
the bins. For the same reason a forest of fewer trees or less depth is part of a larger one: `limited`
gives it without growing it again. Forests over several sets of rows (folds) grow in one job.

Scoring broadcasts a forest of at most `MODEL_BYTES`. A larger one never reaches the driver: blocks of trees and
pages of rows meet in tasks, so any forest can be applied whose single trees fit.

Edge cases: rows without label are left out by the caller; a table without rows gives trees that score 0;
constant features are never tried; a pure node is a leaf; equal rows stay together.
"""
from __future__ import annotations

import json
import math
import pickle
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cohortloom.session import cut_lineage

#: Bytes of trees that a task holds at once when it scores.
MODEL_BYTES = 64 << 20
#: Values (rows x features) that a task grows a subtree from, if no bound is set.
CELLS = 4_000_000
LEAST_BOUND = 50_000
ROOT = 1


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    depth: int = 0  # 0: open
    min_leaf: int = 1
    bootstrap: bool = True
    random_splits: bool = False
    tries: int = 0  # 0: square root of the number of features
    seed: int = 42
    bound: int = 0  # 0: as many rows as CELLS values, but not less than LEAST_BOUND
    bins: int = 255
    #: trees whose rows are dealt out at once; more if that makes at most `dealt` values (rows x features)
    block: int = 50
    dealt: int = 500_000_000

    def tried(self, features: int) -> int:
        return self.tries or max(1, int(features**0.5))

    def bounded(self, features: int) -> Settings:
        return self if self.bound else replace(self, bound=max(LEAST_BOUND, CELLS // max(1, features)))


# ---- draws --------------------------------------------------------------------------------
def scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def draws(seed: int, tree: int, nodes: np.ndarray, n: int, purpose: int) -> np.ndarray:
    """n uniforms in [0, 1) for the features of each node."""
    with np.errstate(over="ignore"):
        x = np.array([seed * 4 + purpose], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree)
        x = scramble(scramble(x) ^ nodes)[:, None]
        x = scramble(x + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def draw(seed: int, tree: int, node: int, n: int, purpose: int) -> np.ndarray:
    return draws(seed, tree, np.array([node], np.uint64), n, purpose)[0]


def children(nodes: np.ndarray, side: int) -> np.ndarray:
    """Numbers of child nodes; hashes, since depth is open."""
    with np.errstate(over="ignore"):
        return scramble(nodes * np.uint64(2) + np.uint64(side)) >> np.uint64(1)


def child(node: int, side: int) -> int:
    return int(children(np.array([node], np.uint64), side)[0])


_POISSON = np.cumsum([np.exp(-1) / float(np.prod(np.arange(1, k + 1))) for k in range(18)])


def bootstrap_counts(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    x = scramble(scramble(row.view(np.uint64) ^ scramble(np.array([seed], np.uint64))) ^ np.uint64(tree + 1))
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")


# ---- one subtree in a task ----------------------------------------------------------------
def purity(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Greater is purer: for children of one node it rises as the weighted Gini impurity falls."""
    total = pos + neg
    return np.where(total > 0, (pos * pos + neg * neg) / np.where(total > 0, total, 1.0), 0.0)


def order_of(s: Settings, tree: int, node: int, differ: np.ndarray) -> np.ndarray:
    """The features that a node tries."""
    ranked = np.argsort(draw(s.seed, tree, node, len(differ), 0), kind="stable")
    return ranked[differ[ranked]][: s.tried(len(differ))]


def random_cut(lo, hi, u):
    cut = lo + u * (hi - lo)
    return np.where((lo <= cut) & (cut < hi), cut, lo)


def _cells(g: np.ndarray, codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, nodes: int, levels: int):
    """(node, code, rows, positive and negative weight) in order of node and code: sums of the rows alike, or
    the rows themselves (rows is None) where most of the table of sums would stay empty."""
    if nodes * levels <= 4 * len(g):
        at = g * levels + codes
        n = np.bincount(at, minlength=nodes * levels)
        used = np.flatnonzero(n)
        sums = (np.bincount(at, w, nodes * levels)[used] for w in (pos, neg))
        return *np.divmod(used, levels), n[used], *sums
    low, high = (len(g) - 1).bit_length(), (levels - 1).bit_length()
    if low + high + (nodes - 1).bit_length() < 63:
        # one number for node, code and place: sorting numbers is quicker than sorting places by two keys
        key = np.sort((((g << high) | codes) << low) | np.arange(len(g)))
        order = key & ((1 << low) - 1)
        key >>= low
        return key >> high, key & ((1 << high) - 1), None, pos[order], neg[order]
    order = np.lexsort((codes, g))
    return g[order], codes[order], None, pos[order], neg[order]


def _sums_before(weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(weights) + 1)
    np.cumsum(weights, out=out[1:])
    return out


def _best_cuts(g: np.ndarray, codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, sums: np.ndarray, least: int, values: np.ndarray):
    """(node, purity, threshold, code) of the best cut of every node that has one; g is sorted, sums holds the
    rows, positive and negative weight of each node, values the value of a code."""
    g, codes, n, pos, neg = _cells(g, codes, pos, neg, len(sums), len(values))
    at = np.flatnonzero((g[:-1] == g[1:]) & (codes[:-1] < codes[1:]))
    begin = np.append(0, np.cumsum(np.bincount(g, minlength=len(sums))))[:-1]
    if least > 1:
        rows = np.arange(len(g) + 1) if n is None else np.append(0, np.cumsum(n))
        left = rows[at + 1] - rows[begin][g[at]]
        at = at[(left >= least) & (sums[g[at], 0] - left >= least)]
    if not len(at):
        return at, values[:0], values[:0], at
    node, value = g[at], None
    p, q = _sums_before(pos), _sums_before(neg)
    p_left, q_left = p[at + 1] - p[begin][node], q[at + 1] - q[begin][node]
    for p_side, q_side in ((p_left, q_left), (sums[:, 1][node] - p_left, sums[:, 2][node] - q_left)):
        total = p_side + q_side
        part = p_side * p_side
        part += q_side * q_side
        part /= total
        value = part if value is None else value + part
    begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    top = np.repeat(np.maximum.reduceat(value, begin) - 1e-9, np.diff(np.append(begin, len(node))))
    hit = np.flatnonzero(value >= top)
    hit = hit[np.append(True, node[hit][1:] != node[hit][:-1])]
    code = codes[at[hit]]
    lower, upper = values[code], values[codes[at[hit] + 1]]
    middle = (lower + upper) / 2
    return node[hit], value[hit], np.where(middle < upper, middle, lower), code


def split_nodes(s: Settings, tree: int, nodes: np.ndarray, codes: np.ndarray, values: Sequence[np.ndarray], pos: np.ndarray, neg: np.ndarray, sums: np.ndarray):
    """(feature or -1, threshold, purity, greatest code of the left side) of every node; ties go to the feature
    drawn first. Rows are sorted by their node; codes are features x rows, values[feature] their values."""
    size = sums[:, 0].astype(np.int64)
    begin = np.append(0, np.cumsum(size[:-1]))
    lo, hi = (np.stack([fold.reduceat(c, begin) for c in codes], axis=1) for fold in (np.minimum, np.maximum))
    ranked = np.argsort(draws(s.seed, tree, nodes, len(values), 0), axis=1, kind="stable")
    least, most = (np.stack([v[c] for v, c in zip(values, ends.T)], axis=1) for ends in (lo, hi))
    differ = np.take_along_axis(least < most, ranked, axis=1)
    tried = np.zeros(lo.shape, bool)
    np.put_along_axis(tried, ranked, differ & (np.cumsum(differ, axis=1) <= s.tried(len(values))), axis=1)
    value, cut, last = np.full(lo.shape, -1.0), np.zeros(lo.shape), np.zeros(lo.shape, np.int64)
    u = draws(s.seed, tree, nodes, len(values), 1) if s.random_splits else None
    for f in np.flatnonzero(tried.any(axis=0)):
        own = np.flatnonzero(tried[:, f])
        g = np.repeat(np.arange(len(own)), size[own])
        if len(own) == len(nodes):
            c, p, q = codes[f], pos, neg
        else:
            rows = np.flatnonzero(np.repeat(tried[:, f], size))
            c, p, q = codes[f][rows], pos[rows], neg[rows]
        if not s.random_splits:
            at, best, threshold, code = _best_cuts(g, c, p, q, sums[own], s.min_leaf, values[f])
            at = own[at]
            value[at, f], cut[at, f], last[at, f] = best, threshold, code
            continue
        cut[own, f] = random_cut(least[own, f], most[own, f], u[own, f])
        last[own, f] = np.searchsorted(values[f], cut[own, f], side="right") - 1
        left = np.flatnonzero(c <= last[own, f][g])
        g, p, q = g[left], p[left], q[left]
        n, p, q = np.bincount(g, minlength=len(own)), np.bincount(g, p, len(own)), np.bincount(g, q, len(own))
        good = (n >= s.min_leaf) & (size[own] - n >= s.min_leaf)
        value[own[good], f] = (purity(p, q) + purity(sums[own, 1] - p, sums[own, 2] - q))[good]
    feature, best, every = np.full(len(nodes), -1), np.full(len(nodes), -1.0), np.arange(len(nodes))
    for f in ranked.T:
        better = value[every, f] > best + 1e-9
        feature, best = np.where(better, f, feature), np.where(better, value[every, f], best)
    chosen = np.maximum(feature, 0)
    return feature, np.where(feature >= 0, cut[every, chosen], 0.0), best, last[every, chosen]


def _same_order(numbers: list[np.ndarray], levels: list[int]) -> np.ndarray:
    """One order of rows whatever order they come in, so that sums are the same; the last numbers come first."""
    if math.prod(levels) >= 1 << 62:
        return np.lexsort(numbers)
    key = np.zeros(len(numbers[0]), np.int64)
    for number, n in zip(reversed(numbers), reversed(levels)):
        key = key * n + number
    return np.argsort(key)


def small(levels: int) -> type:
    """The type of numbers below `levels`."""
    return np.uint8 if levels <= 1 << 8 else np.uint16 if levels <= 1 << 16 else np.int32


#: Rows whose nodes are split together; with many more, each step would leave the processor's cache.
CACHED_ROWS = 1 << 19


def grow_codes(s: Settings, tree: int, root: int, depth: int, codes: Sequence[np.ndarray], values: Sequence[np.ndarray], pos: np.ndarray, neg: np.ndarray) -> dict[str, np.ndarray]:
    """The subtree of some rows as arrays; feature -1 marks a leaf. codes[feature] numbers the rows' values in
    values[feature]. Level by level, and nodes of few rows apart from each other."""
    sums = np.array([[len(pos), pos.sum(), neg.sum()]])
    gain, made = np.zeros(len(values)), 1
    able = lambda sums, depth: (sums[:, 1] > 0) & (sums[:, 2] > 0) & (sums[:, 0] >= 2 * s.min_leaf) & (not s.depth or depth < s.depth)
    found = [(np.array([0]), sums, None, None, None)]  # places, sums, and of split nodes feature, threshold and left child
    work = [(depth, np.array([0]), np.array([root], np.uint64), sums, codes, pos, neg)] if able(sums, depth)[0] else []
    while work:
        depth, place, nodes, sums, codes, pos, neg = work.pop()
        feature, threshold, best, last = split_nodes(s, tree, nodes, codes, values, pos, neg, sums)
        size, split = sums[:, 0].astype(np.int64), np.flatnonzero(feature >= 0)
        if not len(split):
            continue
        np.add.at(gain, feature[split], (best - purity(sums[:, 1], sums[:, 2]))[split])
        begin = np.append(0, np.cumsum(size))
        if len(split) < len(nodes):  # the rows of the others are done with
            rows = np.flatnonzero(np.repeat(feature >= 0, size))
            codes, pos, neg = [c[rows] for c in codes], pos[rows], neg[rows]
            size, begin = size[split], np.append(0, np.cumsum(size[split]))
            feature, threshold, last, place, nodes = feature[split], threshold[split], last[split], place[split], nodes[split]
        side = np.empty(len(pos), bool)
        if len(nodes) <= 64:
            for f, k, a, b in zip(feature, last, begin, begin[1:]):
                np.greater(codes[f][a:b], k, out=side[a:b])
        else:
            for f in np.unique(feature):
                own = np.flatnonzero(np.repeat(feature == f, size))
                side[own] = codes[f][own] > np.repeat(last, size)[own]
        g = np.repeat(2 * np.arange(len(nodes)), size)
        g += side
        below = np.stack([np.bincount(g, w, 2 * len(nodes)) for w in (None, pos, neg)], axis=1)
        left, child_place = made + 2 * np.arange(len(nodes)), made + np.arange(2 * len(nodes))
        made += 2 * len(nodes)
        found.append((child_place, below, None, None, None))
        found.append((place, None, feature, threshold, left))
        going = able(below, depth + 1)
        if not going.any():
            continue
        number = np.full(2 * len(nodes), -1)
        number[going] = np.arange(going.sum())
        if not going.all():
            rows = np.flatnonzero(going[g])
            g = number[g[rows]]
        else:
            rows = None
        # numbers of 16 bits are ordered by counting
        order = np.argsort(g.astype(small(going.sum())), kind="stable")
        order = order if rows is None else rows[order]
        nodes = np.stack((children(nodes, 0), children(nodes, 1)), axis=1).ravel()[going]
        below, child_place = below[going], child_place[going]
        if len(order) <= CACHED_ROWS:
            work.append((depth + 1, child_place, nodes, below, [c[order] for c in codes], pos[order], neg[order]))
            continue
        ends = np.cumsum(below[:, 0]).astype(np.int64)
        first = 0
        while first < len(nodes):
            start = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, start + CACHED_ROWS, side="right")))
            own, part = order[start : ends[stop - 1]], slice(first, stop)
            work.append((depth + 1, child_place[part], nodes[part], below[part], [c[own] for c in codes], pos[own], neg[own]))
            first = stop
    out = {
        "feature": np.full(made, -1, np.int32), "threshold": np.zeros(made), "left": np.full(made, -1, np.int32),
        "right": np.full(made, -1, np.int32), "value": np.zeros(made),
    }
    for place, sums, feature, threshold, left in found:
        if sums is not None:
            total = sums[:, 1] + sums[:, 2]
            out["value"][place] = np.where(total > 0, sums[:, 1] / np.where(total > 0, total, 1), 0.0)
        else:
            out["feature"][place], out["threshold"][place], out["left"][place], out["right"][place] = feature, threshold, left, left + 1
    return out | {"gain": gain}


def grow(s: Settings, tree: int, root: int, depth: int, x: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> dict[str, list]:
    """The subtree of some rows as lists. It doesn't depend on the order of the rows."""
    # values as their numbers in order, which are counted and sorted more quickly
    values, numbers = [list(v) for v in zip(*(np.unique(c, return_inverse=True) for c in (*x.T, neg, pos)))]
    rows = _same_order(numbers, [len(v) for v in values])
    codes = [c[rows].astype(small(len(v))) for c, v in zip(numbers[:-2], values)]
    found = grow_codes(s, tree, root, depth, codes, values[:-2], pos[rows], neg[rows])
    return {k: v.tolist() for k, v in found.items()}


def walk(arrays: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The leaf or dealt-out node that each row reaches."""
    at = np.zeros(len(x), np.int64)
    going = np.arange(len(x))
    while len(going):
        f = arrays["feature"][at[going]]
        going, f = going[f >= 0], f[f >= 0]
        left = x[going, f] <= arrays["threshold"][at[going]]
        at[going] = np.where(left, arrays["left"][at[going]], arrays["right"][at[going]])
    return at


def contributions(arrays: dict[str, np.ndarray], x: np.ndarray, background: np.ndarray) -> np.ndarray:
    """Rows x features: what each feature adds to a tree's value when a row's values replace the
    background's, averaged over all orders of replacing them.

    Only leaves that a mixture of both reaches matter. Such a leaf asks for the row's value of a features
    and the background's of b others; in a!(b-1)!/(a+b)! of the orders one of the b is the first to spoil
    it, in (a-1)!b!/(a+b)! one of the a the last to make it. Rows fork where both part, so a row costs
    the leaves in its reach times their depth.
    """
    n, k = x.shape
    fact = np.cumprod(np.concatenate(([1.0], np.arange(1, k + 1, dtype=float))))
    words, bit = (k + 63) // 64, np.uint64(1) << (np.arange(k, dtype=np.uint64) % np.uint64(64))
    row, at = np.arange(n), np.zeros(n, np.int64)
    # the features held by the row and by the background, as sets of bits
    own = np.zeros((n, words), np.uint64)
    other = own.copy()
    ends: list[tuple] = []
    while len(row):
        f = arrays["feature"][at]
        end = f < 0
        if end.any():
            ends.append((row[end], arrays["value"][at[end]], own[end], other[end]))
            row, at, own, other, f = row[~end], at[~end], own[~end], other[~end], f[~end]
            if not len(row):
                break
        every, word, mark = np.arange(len(row)), f // 64, bit[f]
        cut = arrays["threshold"][at]
        mine, theirs = x[row, f] <= cut, background[f] <= cut
        held, spoiled = (own[every, word] & mark) > 0, (other[every, word] & mark) > 0
        again = np.flatnonzero((mine != theirs) & ~held & ~spoiled)
        side = np.where(spoiled, theirs, mine)
        to, back = np.where(side, arrays["left"][at], arrays["right"][at]), np.where(theirs[again], arrays["left"][at[again]], arrays["right"][at[again]])
        second, third = own[again], other[again].copy()
        third[np.arange(len(again)), word[again]] |= mark[again]
        own[again, word[again]] |= mark[again]
        row, at = np.append(row, row[again]), np.append(to, back)
        own, other = np.concatenate((own, second)), np.concatenate((other, third))
    row, value, own, other = (np.concatenate(v) for v in zip(*ends))
    a, b = (np.bitwise_count(v).sum(axis=1, dtype=np.int64) for v in (own, other))
    value = value / fact[a + b]
    made = np.where(a > 0, fact[np.maximum(a - 1, 0)] * fact[b], 0.0) * value
    spoilt = np.where(b > 0, fact[a] * fact[np.maximum(b - 1, 0)], 0.0) * value
    out = np.zeros((n, k))
    for f in range(k):
        sign = np.where(own[:, f // 64] & bit[f], made, 0.0) - np.where(other[:, f // 64] & bit[f], spoilt, 0.0)
        out[:, f] = np.bincount(row, sign, n)
    return out


# ---- large nodes in Spark -----------------------------------------------------------------
@dataclass
class Top:
    """The split nodes of one tree that Spark found, and its open ends (feature -1)."""

    feature: list = field(default_factory=lambda: [-1])
    threshold: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    node: list = field(default_factory=lambda: [ROOT])
    depth: list = field(default_factory=lambda: [0])
    rows: list = field(default_factory=lambda: [0])
    #: share of positive weight in a large node; None in an open end
    value: list = field(default_factory=lambda: [None])
    gain: list = field(default_factory=list)

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(getattr(self, k)) for k in ("feature", "threshold", "left", "right")}

    def split(self, at: int, feature: int, threshold: float, rows: tuple[int, int]) -> None:
        self.feature[at], self.threshold[at] = feature, threshold
        for side, name in enumerate(("left", "right")):
            getattr(self, name)[at] = len(self.feature)
            new = (-1, 0.0, -1, -1, child(self.node[at], side), self.depth[at] + 1, rows[side], None)
            for k, v in zip(("feature", "threshold", "left", "right", "node", "depth", "rows", "value"), new):
                getattr(self, k).append(v)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column(3)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def weighted(batch: pa.RecordBatch, s: Settings, tree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that a tree uses, with their positive and negative weight. Trees of model m are numbered from
    m * s.trees and draw as those of model 0 do."""
    row, y, w, model = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
    own = np.flatnonzero(model == tree // s.trees)
    row, y, w = row[own], y[own], w[own]
    if s.bootstrap:
        w = w * bootstrap_counts(row, tree % s.trees, s.seed)
    used = np.flatnonzero(w > 0)
    return own[used], w[used] * y[used], w[used] * (1 - y[used])


def _open_rows(batch: pa.RecordBatch, s: Settings, tops: dict[int, Top], wanted: dict[int, np.ndarray]):
    """(tree, rows by open node, values, weights) of a batch."""
    x = matrix(batch)
    for tree, top in tops.items():
        if len(wanted[tree]):
            used, pos, neg = weighted(batch, s, tree)
            at = walk(top.arrays(), x[used])
            inside = np.isin(at, wanted[tree])
            yield tree, at[inside], x[used[inside]], pos[inside], neg[inside]


RANGES = "tree int, at int, feature int, lo double, hi double, n long, pos double, neg double"
CUTS = "tree int, at int, feature int, bin int, n long, pos double, neg double"


def _table(names: str, columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [c.split() for c in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(v), kinds[k]) for v, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def ranges(batches: Iterator[pa.RecordBatch], s: Settings, tops, wanted) -> Iterator[pa.RecordBatch]:
    """Least and greatest value of every feature and node."""
    for batch in batches:
        for tree, at, x, pos, neg in _open_rows(batch, s, tops, wanted):
            for k in np.unique(at):
                own, f = at == k, x.shape[1]
                sums = [np.full(f, v) for v in (own.sum(), pos[own].sum(), neg[own].sum())]
                yield _table(RANGES, [np.full(f, tree), np.full(f, k), np.arange(f), x[own].min(axis=0), x[own].max(axis=0), *sums])


def counts(batches: Iterator[pa.RecordBatch], s: Settings, tops, wanted, edges) -> Iterator[pa.RecordBatch]:
    """Weights by bin: edges[tree, node][feature] are the thresholds, a value equal to one lies below it."""
    for batch in batches:
        for tree, at, x, pos, neg in _open_rows(batch, s, tops, wanted):
            for k in np.unique(at):
                own = at == k
                for f, cuts in edges[tree, int(k)].items():
                    place = np.searchsorted(cuts, x[own, f], side="left")
                    sums = [np.bincount(place, v, len(cuts) + 1) for v in (np.ones(own.sum()), pos[own], neg[own])]
                    use = np.flatnonzero(sums[0])
                    yield _table(CUTS, [np.full(len(use), tree), np.full(len(use), k), np.full(len(use), f), use, sums[0][use].astype(np.int64), sums[1][use], sums[2][use]])


def _choose(s: Settings, features: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, float, float, int] | None:
    """(feature, threshold, purity, rows left) over (feature, thresholds, sums by bin) in drawn order."""
    best = None
    for f, cuts, sums in features:
        n, p, q = np.cumsum(sums, axis=0)[: len(cuts)].T
        total = sums.sum(axis=0)
        value = purity(p, q) + purity(total[1] - p, total[2] - q)
        value[(n < s.min_leaf) | (total[0] - n < s.min_leaf)] = -1
        k = int(np.argmax(value))
        if value[k] >= 0 and (best is None or value[k] > best[2] + 1e-9):
            best = (f, float(cuts[k]), float(value[k]), int(n[k]))
    return best


def split_large(rows: DataFrame, s: Settings, tops: dict[int, Top], quantiles: list[np.ndarray] | None) -> None:
    """Split every node of more than `bound` rows, level by level."""
    context = rows.sparkSession.sparkContext
    while True:
        large = lambda top, i: top.feature[i] < 0 and top.rows[i] > s.bound and top.value[i] is None
        wanted = {t: np.array([i for i in range(len(top.feature)) if large(top, i)], np.int64) for t, top in tops.items()}
        if not any(map(len, wanted.values())):
            return
        state = context.broadcast((tops, wanted))
        found = rows.mapInArrow(lambda it: ranges(it, s, *state.value), RANGES)
        found = found.groupBy("tree", "at", "feature").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        nodes: dict = {}
        for r in found.collect():  # nodes of more than `bound` rows: few
            nodes.setdefault((r.tree, r["at"]), {})[r.feature] = r
        edges = {}
        for t, top in tops.items():  # an end that no row reaches
            for i in wanted[t]:
                if (t, int(i)) not in nodes:
                    top.value[i] = 0.0
        for (t, i), of in nodes.items():
            top, lo, hi = tops[t], *(np.array([of[f][c] for f in sorted(of)]) for c in ("lo", "hi"))
            top.rows[i], share = of[0].n, of[0].pos / (of[0].pos + of[0].neg)
            if of[0].n <= s.bound:
                continue
            if share in (0, 1) or not (lo < hi).any() or s.depth and top.depth[i] >= s.depth:
                top.value[i] = share
                continue
            own = t % s.trees
            order, u = order_of(s, own, top.node[i], lo < hi), draw(s.seed, own, top.node[i], len(lo), 1)
            if quantiles is None:
                edges[t, i] = {int(f): random_cut(lo[[f]], hi[[f]], u[[f]]) for f in order}
            else:
                edges[t, i] = {int(f): quantiles[f][(quantiles[f] >= lo[f]) & (quantiles[f] < hi[f])] for f in order}
                # values that differ between two quantiles only: cut at the mean
                edges[t, i] = {f: c if len(c) else np.array([(lo[f] + hi[f]) / 2]) for f, c in edges[t, i].items()}
        shared = context.broadcast(edges)
        at_edges = {t: np.array([i for i in wanted[t] if (t, int(i)) in edges], np.int64) for t in tops}
        summed = rows.mapInArrow(lambda it: counts(it, s, state.value[0], at_edges, shared.value), CUTS)
        summed = summed.groupBy("tree", "at", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        sums: dict = {k: {f: np.zeros((len(c) + 1, 3)) for f, c in of.items()} for k, of in edges.items()}
        for r in summed.collect():
            sums[r.tree, r["at"]][r.feature][r.bin] = (r.n, r.pos, r.neg)
        for (t, i), of in sums.items():
            best = _choose(s, [(f, edges[t, i][f], v) for f, v in of.items()])
            node = nodes[t, i][best[0] if best else 0]
            if best is None:
                tops[t].value[i] = node.pos / (node.pos + node.neg)
                continue
            tops[t].value[i] = node.pos / (node.pos + node.neg)
            tops[t].gain.append((best[0], best[2] - float(purity(np.float64(node.pos), np.float64(node.neg)))))
            tops[t].split(i, best[0], best[1], (best[3], node.n - best[3]))
        state.destroy()
        shared.destroy()


DEALT = "tree int, at int, rows binary"
#: Bytes of dealt rows that a task holds before it passes them on.
DEALT_BYTES = 8 << 20
#: n nodes as bytes, see packed()
PIECES = "tree int, at int, n int, nodes binary, gain array<double>"


def _dealt(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*found), kinds)], names=["tree", "at", "rows"])


def deal(batches: Iterator[pa.RecordBatch], s: Settings, tops: dict[int, Top]) -> Iterator[pa.RecordBatch]:
    """Weights and values of a batch's rows in one piece for each open end, so that Spark moves and sorts pieces
    instead of rows."""
    found, held = [], 0
    for batch in batches:
        x = matrix(batch)
        for tree, top in tops.items():
            used, pos, neg = weighted(batch, s, tree)
            at = walk(top.arrays(), x[used])
            ends = np.flatnonzero(np.array([v is None for v in top.value])[at])
            ends = ends[np.argsort(at[ends], kind="stable")]
            at, rows = at[ends], np.column_stack((pos[ends], neg[ends], x[used[ends]]))
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
            for first, last in zip(begin, np.append(begin[1:], len(at))):
                found.append((tree, int(at[first]), rows[first:last].tobytes()))
                held += len(found[-1][2])
            if held > DEALT_BYTES:
                yield _dealt(found)
                found, held = [], 0
    if found:
        yield _dealt(found)


def packed(tree: dict[str, np.ndarray], features: int) -> bytes:
    """A tree's arrays, compressed. The right child follows the left one; only split nodes have a threshold."""
    inner = np.flatnonzero(np.asarray(tree["feature"]) >= 0)
    parts = (
        np.asarray(tree["feature"], np.int16 if features < 1 << 15 else np.int32), np.asarray(tree["value"], np.float64),
        np.asarray(tree["threshold"], np.float64)[inner], np.asarray(tree["left"], np.int32)[inner],
    )
    raw = b"".join(p.tobytes() for p in parts)
    return pa.compress(raw, "zstd", asbytes=True)


def unpacked(nodes: bytes, n: int, features: int) -> dict[str, np.ndarray]:
    wide = 2 if features < 1 << 15 else 4
    # half of the nodes less one are split, since each of them has two children
    split = (n - 1) // 2
    raw = pa.decompress(nodes, n * (wide + 8) + split * 12, "zstd")
    feature = np.frombuffer(raw, f"i{wide}", n)
    value, threshold = np.frombuffer(raw, "f8", n, n * wide), np.frombuffer(raw, "f8", split, n * (wide + 8))
    out = {"feature": feature.astype(np.int32), "threshold": np.zeros(n), "left": np.full(n, -1, np.int32), "right": np.full(n, -1, np.int32), "value": value}
    inner = np.flatnonzero(feature >= 0)
    left = np.frombuffer(raw, "i4", split, n * (wide + 8) + split * 8)
    out["threshold"][inner], out["left"][inner], out["right"][inner] = threshold, left, left + 1
    return out


def _piece(tree: int, at: int, found: dict, features: int) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()))
    values = (tree, at, len(found["feature"]), packed(found, features), np.asarray(found["gain"]))
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["tree", "at", "n", "nodes", "gain"])


def grow_group(group: pa.Table, s: Settings, tops: dict[int, Top], features: int) -> pa.Table:
    tree, at = group["tree"][0].as_py(), group["at"][0].as_py()
    rows = np.frombuffer(b"".join(group["rows"].to_pylist())).reshape(-1, features + 2)
    pos, neg, x = rows[:, 0], rows[:, 1], rows[:, 2:]
    found = grow(s, tree % s.trees, tops[tree].node[at], tops[tree].depth[at], x, pos, neg)
    return pa.Table.from_batches([_piece(tree, at, found, features)])


# ---- whole trees in tasks that hold the table -----------------------------------------------
#: Bytes of a table that a task holds while it grows one tree after the other, if no bound is set.
HELD_BYTES = 400 << 20
#: Rows of a packed piece; their values are numbered in 16 bits.
PIECE_ROWS = 1 << 16
PACKED = "model int, piece binary"


def held_rows(features: int) -> int:
    return max(LEAST_BOUND, HELD_BYTES // (24 + 8 * max(1, features)))


def _packed_rows(parts: list[tuple[np.ndarray, ...]]) -> bytes:
    """Rows, and of each column the values that occur and which of them each row has."""
    row, weight, x = (np.concatenate(p) for p in zip(*parts))
    numbered = [np.unique(c, return_inverse=True) for c in (weight, *x.T)]
    return pickle.dumps((row, [(v, n.astype(small(len(v)))) for v, n in numbered]))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted rows of each model in pieces, positive and negative weight as one complex number."""
    held: dict[int, list] = {}
    count: dict[int, int] = {}

    def piece(model: int) -> pa.RecordBatch:
        count[model] = 0
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([_packed_rows(held.pop(model))], pa.binary())], names=["model", "piece"])

    for batch in batches:
        row, y, w, model = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
        x = matrix(batch)
        for m in np.unique(model):
            own = np.flatnonzero((model == m) & (w > 0))
            for at in range(0, len(own), PIECE_ROWS):
                part = own[at : at + PIECE_ROWS]
                if count.get(m, 0) + len(part) > PIECE_ROWS:
                    yield piece(int(m))
                held.setdefault(int(m), []).append((row[part], w[part] * y[part] + 1j * (w[part] * (1 - y[part])), x[part]))
                count[int(m)] = count.get(m, 0) + len(part)
    for m in list(held):
        yield piece(m)


def unpack(pieces: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(row, values of each column, numbers of each column), the weight first, in an order that depends on the
    rows alone."""
    found = [pickle.loads(p) for p in pieces]
    pieces.clear()
    row, values, codes = np.concatenate([r for r, _ in found]), [], []
    for f in range(len(found[0][1])):
        own = [columns[f] for _, columns in found]
        values.append(np.unique(np.concatenate([v for v, _ in own])))
        kind = small(len(values[-1]))
        codes.append(np.concatenate([np.searchsorted(values[-1], v).astype(kind)[n] for v, n in own]))
        for _, columns in found:
            columns[f] = None
    order = np.argsort(row, kind="stable")
    row = row[order]
    same = row[1:] == row[:-1]
    if same.any():  # rows of one key: by their values
        twice = np.flatnonzero(np.append(same, False) | np.append(False, same))
        order[twice] = order[twice][np.lexsort([*(c[order[twice]] for c in codes), row[twice]])]
    return row, values, [c[order] for c in codes]


def _tree_grower(s: Settings, features: int, parts: int):
    """The function that Spark applies to the pieces of each part of a forest."""

    def grow_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(part, []).append(piece)
        for part in sorted(held):
            row, values, codes = unpack(held.pop(part))
            weight, kind, values, codes = values[0], codes[0], values[1:], codes[1:]
            model, first = divmod(part, parts)
            for tree in range(first, s.trees, parts):
                if s.bootstrap:
                    k = bootstrap_counts(row, tree, s.seed)
                    used = np.flatnonzero(k)
                    own, k = [c[used] for c in codes], k[used]
                    pos, neg = weight.real[kind[used]] * k, weight.imag[kind[used]] * k
                else:
                    own, pos, neg = codes, weight.real[kind], weight.imag[kind]
                yield _piece(model * s.trees + tree, 0, grow_codes(s, tree, ROOT, 0, own, values, pos, neg), features)

    return grow_trees


def grow_held(rows: DataFrame, s: Settings, features: int, models: int) -> DataFrame:
    """The trees of tables that a task can hold: each task gets the table of one model, packed, and grows its
    share of the trees, so rows move once for each task and not once for each tree."""
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    parts = min(s.trees, -(-tasks // models))
    pieces = rows.mapInArrow(pack, PACKED).select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "model", "piece")
    dealt = pieces.select((F.col("model") * parts + F.col("part")).alias("part"), "piece").repartitionById(models * parts, "part")
    return cut_lineage(dealt.mapInArrow(_tree_grower(s, features, parts), PIECES))


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows with much work each, dealt over all cores however few files they come from."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _adder(block):
    """Sums of the trees of a broadcast block."""

    def add(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        points = np.stack(x.to_numpy())
        return pd.Series(sum(t["value"][walk(t, points)] for t in block.value.values()), dtype="float64")

    return add


def _explainer(block, background: np.ndarray):
    """Sums of the contributions of a broadcast block, a few rows at once."""

    def add(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        points = np.stack(x.to_numpy())
        parts = [points[i : i + 1024] for i in range(0, len(points), 1024)]
        return pd.Series(list(np.concatenate([sum(contributions(t, p, background) for t in block.value.values()) for p in parts])))

    return add


def _grower(s: Settings, tops, features: int):
    """The function of one argument that Spark applies to a group."""
    return lambda group: grow_group(group, s, tops.value, features)


def _to_depth(arrays: dict[str, np.ndarray], depth: int) -> dict[str, np.ndarray]:
    """A tree without the nodes below a depth; those at it become leaves."""
    kept, level = [np.array([0])], np.array([0])
    for _ in range(depth):
        inner = level[arrays["feature"][level] >= 0]
        level = np.concatenate((arrays["left"][inner], arrays["right"][inner]))
        kept.append(level)
    feature = arrays["feature"].copy()
    feature[level] = -1
    nodes = np.concatenate(kept)
    place = np.full(len(feature), -1)
    place[nodes] = np.arange(len(nodes))
    inner = feature[nodes] >= 0
    move = lambda side: np.where(inner, place[arrays[side][nodes]], -1)
    return {
        "feature": feature[nodes], "threshold": arrays["threshold"][nodes], "left": move("left"), "right": move("right"),
        "value": arrays["value"][nodes],
    }


def _unpack_into(found: dict[int, dict], pieces: dict[str, list], features: int) -> None:
    for tree, at, n, nodes in zip(*(pieces[c] for c in ("tree", "at", "n", "nodes"))):
        found[tree][at] = unpacked(nodes, n, features)


def whole_tree(top: Top, pieces: dict[int, dict[str, np.ndarray]], cut: int) -> dict[str, np.ndarray]:
    """A tree's top with the subtrees in place of its open ends."""
    own = {k: np.array(getattr(top, k)) for k in ("feature", "threshold", "left", "right")} | {"value": np.array([v or 0.0 for v in top.value])}
    parts, size = [own], len(own["feature"])
    for at in sorted(pieces):
        piece = dict(pieces[at])
        base = size - 1  # the piece's root takes the open end's place, the rest follow
        for k in ("left", "right"):
            piece[k] = np.where(piece[k] > 0, piece[k] + base, -1)
        for k, v in piece.items():
            own[k][at] = v[0]
        parts.append({k: v[1:] for k, v in piece.items()})
        size += len(piece["feature"]) - 1
    out = {k: np.concatenate([p[k] for p in parts]).astype(np.float64 if k in ("threshold", "value") else np.int32) for k in own}
    return _to_depth(out, cut) if cut else out


# ---- large forests applied block by block --------------------------------------------------
#: Bytes of trees that a task holds, and of the rows' values that it applies them to.
BLOCK_BYTES = 160 << 20
PAGED_BYTES = 64 << 20
PAGES = "page string, rows binary, x binary"
SUMMED = "page string, block int, found binary"


def _paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as bytes, whole and its last column, the feature values, apart."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.num_columns - 1
        x = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        rows, sink = batch.select(list(range(at))), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as writer:
            writer.write_batch(rows)
        values = (uuid.uuid4().hex, sink.getvalue().to_pybytes(), np.array([batch.num_rows], np.int64).tobytes() + x.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["page", "rows", "x"])


def _summer(plan: list[list[int]], tops, groups: int, features: int, cut: int, of_tree: Callable):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # group, block, tree, at, n, nodes, page, part
        found: dict[int, dict] = {}
        pages: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["page"] is None:
                    found.setdefault(r["part"], {}).setdefault(r["tree"], {})[r["at"]] = unpacked(r["nodes"], r["n"], features)
                else:
                    pages.setdefault(r["part"], []).append((r["page"], r["nodes"]))
        for part, own in pages.items():
            block, pieces, total = part // groups, found.pop(part, {}), [None] * len(own)
            for t in plan[block]:
                tree = whole_tree(tops.value[t], pieces.pop(t, {}), cut)
                for i, (_, raw) in enumerate(own):
                    n = int(np.frombuffer(raw, np.int64, 1)[0])
                    x = np.frombuffer(raw, np.float64, offset=8).reshape(n, -1)
                    more = np.concatenate([of_tree(tree, x[a : a + 4096]) for a in range(0, n, 4096)])
                    total[i] = more if total[i] is None else total[i] + more
            for (page, _), v in zip(own, total):
                yield pa.RecordBatch.from_arrays([pa.array([page]), pa.array([block], pa.int32()), pa.array([v.tobytes()])], names=["page", "block", "found"])

    return summed


def _met(group: pa.Table) -> pa.Table:
    """The rows of a page with the sums over all blocks, added in their order."""
    group = group.sort_by("block")
    found = group["found"].to_pylist()
    rows = pa.ipc.open_stream(found[0]).read_all()
    total = reduce(np.add, (np.frombuffer(f) for f in found[1:])).reshape(rows.num_rows, -1)
    ends = pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * total.shape[1])
    return pa.Table.from_arrays([*rows.columns, pa.ListArray.from_arrays(ends, pa.array(total.ravel()))], names=[*rows.column_names, "_sums"])


@dataclass
class ForestModel:
    settings: Settings
    features: int
    tops: dict[int, Top]
    pieces: DataFrame
    #: deeper nodes are left out; 0: none
    cut: int = 0

    def limited(self, trees: int, depth: int) -> ForestModel:
        """The forest that the same settings with fewer trees or less depth (0: open) give."""
        grown = self.cut or self.settings.depth
        if trees > len(self.tops) or grown and not 0 < depth <= grown:
            raise ValueError("a part of a forest has no more trees and no more depth")
        s = replace(self.settings, trees=trees, depth=depth)
        tops = {t: top for t, top in self.tops.items() if t < trees}
        return ForestModel(s, self.features, tops, self.pieces.where(F.col("tree") < trees), 0 if depth == grown else depth)

    def blocks(self) -> Iterator[dict[int, dict[str, np.ndarray]]]:
        """Whole trees as arrays, at most MODEL_BYTES at once (a larger tree by itself)."""
        for block in self._plan(MODEL_BYTES):
            yield self._whole(block)

    def _plan(self, most: int) -> list[list[int]]:
        """The trees of each block of at most so many bytes."""
        sizes = {r.tree: r.n for r in self.pieces.groupBy("tree").agg(F.sum("n").alias("n")).collect()}
        out, held = [[]], 0
        for tree in sorted(self.tops):
            size = 32 * (sizes.get(tree, 1) + len(self.tops[tree].feature) - 1)
            if out[-1] and held + size > most:
                out.append([])
                held = 0
            out[-1].append(tree)
            held += size
        return out

    def _whole(self, trees: list[int]) -> dict[int, dict[str, np.ndarray]]:
        found: dict[int, dict] = {t: {} for t in trees}
        for batch in self.pieces.where(F.col("tree").isin(trees)).toArrow().to_batches():
            _unpack_into(found, batch.to_pydict(), self.features)
        return {t: whole_tree(self.tops[t], found[t], self.cut) for t in trees}

    def add_score(self, df: DataFrame, values: str, out: str) -> DataFrame:
        """The mean share of positive weight in the leaves that a row of feature values reaches."""
        total, plan = len(self.tops), self._plan(MODEL_BYTES)
        if len(plan) > 1:
            summed = self._apart(df, values, lambda t, x: t["value"][walk(t, x)][:, None])
            return summed.withColumn(out, F.get("_sums", F.lit(0)) / total).drop("_sums")
        shared = df.sparkSession.sparkContext.broadcast(self._whole(plan[0]))
        return df.withColumn(out, F.pandas_udf(_adder(shared), "double")(F.col(values)) / total)

    def add_contributions(self, df: DataFrame, values: str, background: Sequence[float], out: str) -> DataFrame:
        """An array with the contribution of each feature; it sums to the row's score less the background's."""
        at, plan, df = np.array(background, float), self._plan(MODEL_BYTES), spread(df)
        if len(plan) > 1:
            df = self._apart(df, values, lambda t, x: contributions(t, x, at))
        else:
            shared = df.sparkSession.sparkContext.broadcast(self._whole(plan[0]))
            df = df.withColumn("_sums", F.pandas_udf(_explainer(shared, at), "array<double>")(F.col(values)))
        return df.withColumn(out, F.transform("_sums", lambda v: v / len(self.tops))).drop("_sums")

    def _apart(self, df: DataFrame, values: str, of_tree: Callable[[dict, np.ndarray], np.ndarray]) -> DataFrame:
        """Adds `_sums`, the sums over all trees of an array for each row. Neither the driver nor a task holds the forest: pages
        of rows go to tasks that each hold a block of trees, and the sums of a page meet again with its rows."""
        spark, cut = df.sparkSession, self.cut
        plan = self._plan(BLOCK_BYTES)
        names, df = df.columns, df.withColumn("_at", F.col(values))
        df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        pages = cut_lineage(df.mapInArrow(_paged, PAGES))
        size = pages.agg(F.sum(F.length("x"))).first()[0] or 0
        # every block is met by so many groups of pages, each of few bytes
        groups = max(1, -(-size // PAGED_BYTES), -(-2 * spark.sparkContext.defaultParallelism // len(plan)))
        place = {t: b for b, trees in enumerate(plan) for t in trees}
        block_of = F.element_at(F.create_map(*[F.lit(v) for kv in place.items() for v in kv]), F.col("tree"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        empty = lambda kind: F.lit(None).cast(kind)
        trees = self.pieces.select(every(groups).alias("group"), block_of.alias("block"), "tree", "at", "n", "nodes", empty("string").alias("page"))
        rows = pages.select(
            F.pmod(F.xxhash64("page"), F.lit(groups)).cast("int").alias("group"), every(len(plan)).alias("block"), *[empty("int").alias(c) for c in ("tree", "at", "n")],
            F.col("x").alias("nodes"), "page",
        )
        dealt = trees.unionByName(rows).withColumn("part", (F.col("block") * groups + F.col("group")).cast("int")).repartitionById(len(plan) * groups, "part")
        tops = spark.sparkContext.broadcast(self.tops)
        sums = dealt.mapInArrow(_summer(plan, tops, groups, self.features, cut, of_tree), SUMMED)
        both = pages.select("page", F.lit(-1).alias("block"), F.col("rows").alias("found")).unionByName(sums)
        kinds = StructType([*df.schema.fields[:-1], StructField("_sums", ArrayType(DoubleType()))])
        return cut_lineage(both.groupBy("page").applyInArrow(_met, kinds).toDF(*names, "_sums"))

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the fall of impurity that each feature brings, averaged over the trees."""
        if self.cut:
            raise ValueError("importances of a part of lower depth are not kept: fit a forest of that depth")
        trees = {t: np.zeros(self.features) for t in self.tops}
        for t, top in self.tops.items():
            for f, g in top.gain:
                trees[t][f] += g
        at = [F.sum(F.get("gain", F.lit(f))).alias(f"g{f}") for f in range(self.features)]
        for r in self.pieces.groupBy("tree").agg(*at).collect():
            trees[r.tree] += np.array(r[1:])
        shares = [g / g.sum() for g in trees.values() if g.sum() > 0]
        return Vectors.dense(np.mean(shares, axis=0) if shares else np.zeros(self.features))

    def save(self, path: str) -> None:
        spark = self.pieces.sparkSession
        self.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
        about = {"settings": asdict(self.settings), "features": self.features, "tops": {t: vars(top) for t, top in self.tops.items()}, "cut": self.cut}
        spark.range(1).select(F.lit(json.dumps(about)).alias("value")).write.mode("overwrite").text(f"{path}/forest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        about = json.loads(spark.read.text(f"{path}/forest", wholetext=True).where("value <> ''").first()["value"])
        tops = {int(t): Top(**{k: [tuple(g) for g in v] if k == "gain" else v for k, v in top.items()}) for t, top in about["tops"].items()}
        return ForestModel(Settings(**about["settings"]), about["features"], tops, spark.read.parquet(f"{path}/pieces"), about.get("cut", 0))


def fit(rows: DataFrame, s: Settings) -> ForestModel:
    """rows: row (long, hash of the row's key), y (0 or 1), w (weight), x (array of numbers)."""
    return fit_many(rows.withColumn("model", F.lit(0)), s, 1)[0]


def fit_many(rows: DataFrame, s: Settings, models: int) -> list[ForestModel]:
    """A forest for each number below `models` over the rows that carry it in `model`, as fit() gives it
    (but for the quantiles at which large nodes are cut: they are those of all rows)."""
    rows = rows.select(
        F.col("row").cast("long"), F.col("y").cast("double"), F.col("w").cast("double"), F.col("x").cast("array<double>"), F.col("model").cast("int")
    )
    heads = {r.model: r for r in rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("features")).collect()}
    features = max((r.features for r in heads.values()), default=0)
    held, s = s.bound or held_rows(features), s.bounded(features)
    size = {m: heads[m].n if m in heads else 0 for m in range(models)}
    quantiles = None
    if not s.random_splits and max(size.values(), default=0) > held:
        share = [(i + 1) / (s.bins + 1) for i in range(s.bins)]
        at = [F.percentile_approx(F.get("x", F.lit(f)), share, 10_000).alias(f"q{f}") for f in range(features)]
        quantiles = [np.unique(q) for q in rows.agg(*at).first()]
    tops = {m * s.trees + t: Top(rows=[size[m]]) for m in range(models) for t in range(s.trees)}
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)  # few files must not leave the trees to few cores
    if max(size.values(), default=0) <= held:
        pieces = grow_held(rows, s, features, models)
        return _models(pieces, s, features, tops, models)
    found = []
    step = max(s.block, s.dealt // max(1, features * max(size.values(), default=0)))
    for first in range(0, len(tops), step):
        block = {t: tops[t] for t in range(first, min(first + step, len(tops)))}
        split_large(rows, s, block, quantiles)
        shared = rows.sparkSession.sparkContext.broadcast(block)
        dealt = rows.mapInArrow(lambda it, b=shared: deal(it, s, b.value), DEALT)
        # groups with much work each: AQE would take few bytes into few tasks. Up to four parts a tree where trees
        # are large, so that few parts hold two of them
        much = len(block) * max(size.values(), default=0) // 50_000
        dealt = dealt.repartition(min(4 * len(block), max(min(4 * cores, len(block)), much)), "tree", "at")
        grown = cut_lineage(dealt.groupBy("tree", "at").applyInArrow(_grower(s, shared, features), PIECES))
        found.append(grown.coalesce(cores))  # read many times: no task for every empty part
        shared.destroy()
    return _models(reduce(DataFrame.union, found), s, features, tops, models)


def _models(pieces: DataFrame, s: Settings, features: int, tops: dict[int, Top], models: int) -> list[ForestModel]:
    out = []
    for m in range(models):
        base = m * s.trees
        own = pieces.where(F.col("tree").between(base, base + s.trees - 1)).withColumn("tree", F.col("tree") - base)
        out.append(ForestModel(s, features, {t: tops[base + t] for t in range(s.trees)}, own))
    return out
