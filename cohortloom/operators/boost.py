"""Second-order boosted trees over histograms, many models at once.

Values are cut into at most `bins` bins between approximate quantiles. A round takes the gradient and
hessian of the log loss at each row's margin, adds them up by (node, feature, bin) and splits nodes where
G^2 / (H + l2) of the sides exceeds that of the node most; a leaf adds -rate * G / (H + l2). Trees grow
level by level to `depth`, or best leaf first to `leaves` leaves: all leaves that could still be split are
measured in one pass, then splits are replayed in order of gain, so a tree takes as many passes as it has
levels, not one a leaf. With `newton_splits` off, splits minimise the squared error of the gradients
instead, and only leaf values use the hessian.

Gradients are rounded to multiples of 2^-20, so their sums are exact in any order (up to 2^53 units): a
model depends neither on partitions nor on where its rows are held. Rows and features are drawn by hashes
of row, feature, round and seed.

Where the work is done. A model of at most `bound` training rows (by default, as many as have CELLS values or
take HELD_BYTES) grows in one task, so the folds, settings
and versions of an experiment grow side by side, one group each. For a larger model every pass is a Spark
job: partitions add up their histograms, one shuffle sums them, and the driver sees leaves x features x
bins numbers. Rows then carry their margin, which is written anew every `KEEP` rounds.

Edge cases: rows without label are left out by the caller; a table without rows gives no trees and scores
0.5; one class alone gives trees of one leaf; a constant feature is never cut; equal rows stay together.
"""
from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.forest import draw, scramble, walk
from cohortloom.session import cut_lineage

UNIT = 2.0**-20
#: Rounds whose trees are applied anew in each pass over a large table.
KEEP = 16
#: Values (rows x features, a byte each) of a model that grows in one task, if no bound is set.
CELLS = 4_000_000
LEAST_BOUND = 100_000
#: Bytes of a model's rows, sums and row numbers in the task that grows it, if no bound is set. Growing it by a
#: Spark job for each level of each tree takes far longer.
HELD_BYTES = 640 << 20
LEAST_GAIN = 1e-7


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    rate: float = 0.05
    depth: int = 0  # 0: open, then `leaves` must be set
    leaves: int = 0  # 0: as many as the depth allows
    l2: float = 0.0
    min_rows: int = 1
    min_hessian: float = 0.0
    row_share: float = 1.0
    feature_share: float = 1.0
    newton_splits: bool = True
    bins: int = 255
    seed: int = 42
    bound: int = 0  # 0: as many rows as CELLS values, but not less than LEAST_BOUND

    def rows_in_task(self, features: int) -> int:
        return self.bound or max(LEAST_BOUND, CELLS // max(1, features))

    def __post_init__(self):
        if not self.depth and not self.leaves:
            raise ValueError("depth or leaves must bound a tree")
        if not 2 <= self.bins <= 256:
            raise ValueError("bins must be 2 to 256")


def held_rows(features: int) -> int:
    return HELD_BYTES // (96 + 4 * max(1, features))


# ---- sums of a round ----------------------------------------------------------------------
def channels(s: Settings, margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Rows, gradient and hessian, and the weight if gains are divided by it; all but the first in units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    g, h = np.rint(w * (p - y) / UNIT), np.rint(w * p * (1 - p) / UNIT)
    return [np.ones(len(y)), g, h] + ([] if s.newton_splits else [np.rint(w / UNIT)])


def sampled(s: Settings, row: np.ndarray, turn: int) -> np.ndarray:
    if s.row_share >= 1:
        return np.ones(len(row), bool)
    x = scramble(scramble(row.view(np.uint64) ^ scramble(np.array([s.seed], np.uint64))) ^ np.uint64(turn + 1))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53 < s.row_share


def sampled_features(s: Settings, n: int, turn: int) -> np.ndarray:
    """The features of a round."""
    if s.feature_share >= 1:
        return np.arange(n)
    return np.sort(np.argsort(draw(s.seed, turn, 0, n, 2), kind="stable")[: max(1, int(s.feature_share * n))])


def histogram(codes: np.ndarray, features: np.ndarray, place: np.ndarray, nodes: int, bins: int, sums: list[np.ndarray]) -> np.ndarray:
    """Sums by (channel, node, feature, bin); place is the node of each row."""
    out = np.empty((len(sums), nodes, len(features), bins))
    base = place * bins
    for i, f in enumerate(features):
        at = base + codes[:, f]
        for c, values in enumerate(sums):  # the first counts rows
            out[c, :, i] = np.bincount(at, values if c else None, nodes * bins).reshape(nodes, bins)
    return out


# ---- one tree -----------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes in the order of their making. feature -1: not split; a row goes left up to bin `cut`."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    depth: list = field(default_factory=lambda: [0])
    #: (rows, gradient, hessian) of a node; the root learns them in its first pass
    sums: list = field(default_factory=lambda: [None])
    #: (gain, feature, cut, sums left, sums right) of a measured node, (0,) if it can't be split
    best: list = field(default_factory=lambda: [None])

    def arrays(self) -> dict[str, np.ndarray]:
        return {"feature": np.array(self.feature), "threshold": np.array(self.cut), "left": np.array(self.left), "right": np.array(self.right)}

    def expand(self, at: int) -> None:
        _, self.feature[at], self.cut[at], *sides = self.best[at]
        for name, sums in zip(("left", "right"), sides):
            getattr(self, name)[at] = len(self.feature)
            for k, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("depth", self.depth[at] + 1), ("sums", sums), ("best", None)):
                getattr(self, k).append(v)


def best_cuts(s: Settings, hist: np.ndarray, features: np.ndarray) -> list[tuple]:
    """What Tree.best holds, for every node of a histogram; ties go to the least feature and cut."""
    left = np.cumsum(hist, axis=3)
    total = left[..., -1:]
    left = left[..., :-1]
    right = total - left

    def score(x: np.ndarray) -> np.ndarray:
        return x[1] * x[1] / np.maximum(x[-1] + s.l2 / UNIT, 1.0)

    gain = score(left)
    gain += score(right)
    gain -= score(total)
    gain *= UNIT
    for side in (left, right):
        short = side[0] < max(s.min_rows, 1)
        if s.min_hessian:
            short |= side[2] < s.min_hessian / UNIT
        gain[short] = 0.0
    out = []
    for i, flat in enumerate(gain.reshape(len(gain), -1)):
        k = int(np.argmax(flat >= flat.max(initial=0.0) - 1e-9)) if flat.size else 0
        if not flat.size or flat[k] <= LEAST_GAIN:
            out.append((0.0,))
            continue
        f, cut = divmod(k, gain.shape[2])
        out.append((float(flat[k]), int(features[f]), cut, left[:3, i, f, cut].copy(), right[:3, i, f, cut].copy()))
    return out


def grow_tree(s: Settings, features: np.ndarray, measure: Callable[[Tree, list[int]], np.ndarray]) -> tuple[Tree, set[int]]:
    """A tree and the nodes whose split counts; measure(tree, nodes) gives the histogram of leaves."""
    tree = Tree()
    while True:
        able = lambda i: (not s.depth or tree.depth[i] < s.depth) and (tree.sums[i] is None or tree.sums[i][0] >= 2 * s.min_rows)
        for i in range(len(tree.best)):
            if tree.best[i] is None and tree.sums[i] is not None and not able(i):
                tree.best[i] = (0.0,)
        wanted = [i for i, b in enumerate(tree.best) if b is None]
        if wanted:
            hist = measure(tree, wanted)
            for i, found, sums in zip(wanted, best_cuts(s, hist, features), hist[:3, :, 0].sum(axis=2).T):
                tree.sums[i], tree.best[i] = sums, found if able(i) else (0.0,)
        kept: set[int] = set()
        heap, leaves, known = [(-tree.best[0][0], 0)], 1, True
        while known and heap and heap[0][0] < 0 and (not s.leaves or leaves < s.leaves):
            if tree.feature[heap[0][1]] < 0:
                known = False
                break
            at = heapq.heappop(heap)[1]
            kept.add(at)
            leaves += 1
            for side in (tree.left[at], tree.right[at]):
                heapq.heappush(heap, (-tree.best[side][0], side))
        if known:
            return tree, kept
        # every leaf that may still be among the best, at once
        room = s.leaves - leaves if s.leaves else len(heap)
        for gain, at in heapq.nsmallest(room, heap):
            if gain < 0 and tree.feature[at] < 0:
                tree.expand(at)


def finished(s: Settings, tree: Tree, kept: set[int], cuts: list[np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The place in the kept part of a tree of each of its nodes (of the leaf above it, if it isn't kept), and the
    kept part, once with bins and once with values as thresholds."""
    order, at = [0], 0
    links: dict[int, tuple[int, int]] = {}
    while at < len(order):
        node = order[at]
        if node in kept:
            links[at] = (len(order), len(order) + 1)
            order += [tree.left[node], tree.right[node]]
        at += 1
    n = len(order)
    place = np.full(len(tree.feature), -1)
    place[order] = np.arange(n)
    for left, right, own in zip(tree.left, tree.right, place):  # nodes come after those above them
        if left >= 0 and place[left] < 0:
            place[[left, right]] = own
    inner = np.array([i in links for i in range(n)])
    feature = np.where(inner, [tree.feature[i] for i in order], -1)
    value = [-s.rate * tree.sums[i][1] * UNIT / max(tree.sums[i][2] * UNIT + s.l2, UNIT) for i in order]
    out = {
        "feature": feature,
        "threshold": np.where(inner, [tree.cut[i] for i in order], 0),
        "left": np.array([links.get(i, (-1, -1))[0] for i in range(n)]),
        "right": np.array([links.get(i, (-1, -1))[1] for i in range(n)]),
        "value": np.where(inner, 0.0, value),
        "gain": np.where(inner, [tree.best[i][0] if tree.best[i] else 0.0 for i in order], 0.0),
    }
    values = [float(cuts[f][k]) if f >= 0 else 0.0 for f, k in zip(out["feature"], out["threshold"])]
    return place, out, {**out, "threshold": np.array(values)}


def log_odds(pos: float, neg: float) -> float:
    share = min(max(pos / (pos + neg) if pos + neg > 0 else 0.5, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


# ---- a model in one task ------------------------------------------------------------------
def boost_rows(s: Settings, cuts: list[np.ndarray], row: np.ndarray, y: np.ndarray, w: np.ndarray, codes: np.ndarray, base: float) -> Iterator[dict[str, np.ndarray]]:
    """The trees of a model over rows in memory. Each leaf holds the numbers of its rows."""
    margin, bins = np.full(len(y), base), max((len(c) + 1 for c in cuts), default=1)
    codes = np.asfortranarray(codes)  # read by feature
    for turn in range(s.rounds):
        features = sampled_features(s, codes.shape[1], turn)
        drawn = sampled(s, row, turn)
        sums = channels(s, margin, y, w)
        held = {0: np.flatnonzero(drawn)}
        known: dict[int, np.ndarray] = {}

        def measure(tree: Tree, wanted: list[int]) -> np.ndarray:
            """Of two sides the smaller is counted; the larger is what is left of the node above, exactly."""
            _split_rows(tree, codes, held)
            asked, rest = set(wanted), []
            for up, left, right in zip(range(len(tree.left)), tree.left, tree.right):
                if up in known and left in asked and right in asked:
                    small, large = (left, right) if tree.sums[left][0] <= tree.sums[right][0] else (right, left)
                    rest.append((up, small, large))
                    asked.remove(large)
            counted = sorted(asked)
            inside = [held[i] for i in counted]
            place = np.repeat(np.arange(len(counted)), [len(i) for i in inside])
            if len(place) == len(y):
                hist = histogram(codes, features, place, len(counted), bins, sums)
            else:
                inside = np.concatenate(inside)
                hist = histogram(np.take(codes.T, inside, axis=1).T, features, place, len(counted), bins, [c[inside] for c in sums])
            known.update((i, hist[:, k]) for k, i in enumerate(counted))
            for up, small, large in rest:
                known[large] = known.pop(up) - known[small]
            return np.stack([known[i] for i in wanted], axis=1)

        tree, kept = grow_tree(s, features, measure)
        place, binned, made = finished(s, tree, kept, cuts)
        _split_rows(tree, codes, held)
        others = np.flatnonzero(~drawn)
        if len(others):
            held_back = {0: others}
            _split_rows(tree, codes, held_back)
        for ends in (held, held_back) if len(others) else (held,):
            for node, rows in ends.items():
                margin[rows] += binned["value"][place[node]]
        yield made


def _split_rows(tree: Tree, codes: np.ndarray, held: dict[int, np.ndarray]) -> None:
    """The rows of nodes that have been split go to the sides."""
    for node, (feature, cut, left, right) in enumerate(zip(tree.feature, tree.cut, tree.left, tree.right)):
        if left >= 0 and node in held:
            rows = held.pop(node)
            side = codes[:, feature][rows] <= cut
            held[left], held[right] = rows[side], rows[~side]


def descend(arrays: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows go on from where they are to the leaf they reach."""
    at = at.copy()
    going = np.flatnonzero(arrays["feature"][at] >= 0)
    while len(going):
        f = arrays["feature"][at[going]]
        left = codes[going, f] <= arrays["threshold"][at[going]]
        at[going] = np.where(left, arrays["left"][at[going]], arrays["right"][at[going]])
        going = going[arrays["feature"][at[going]] >= 0]
    return at


def unpack(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    """Codes of equal length for each row."""
    parts = []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        ends = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset : c.offset + len(c) + 1]
        if len(c) and ends[-1] > ends[0]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(parts).reshape(n, -1) if parts else np.zeros((n, 0), np.uint8)


TREES = "model int, tree int, base double, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, gain array<double>"
PARTS = ("feature", "threshold", "left", "right", "value", "gain")
_KINDS = {"feature": pa.int32(), "threshold": pa.float64(), "left": pa.int32(), "right": pa.int32(), "value": pa.float64(), "gain": pa.float64()}


def _grower(models: Mapping[int, Settings], cuts: list[np.ndarray]):
    """The function that Spark applies to the rows of a model, or of several that share a partition."""

    def grow(model: int, group: pa.Table) -> pa.Table:
        row, y, w = (group[c].to_numpy() for c in ("row", "y", "w"))
        base = log_odds(float((w * y).sum().round(6)), float((w * (1 - y)).sum().round(6)))
        trees = list(boost_rows(models[model], cuts, row, y, w, unpack(group["codes"], len(y)), base))
        columns = [pa.array([t[k] for t in trees], pa.list_(_KINDS[k])) for k in PARTS]
        head = [pa.array([model] * len(trees), pa.int32()), pa.array(range(len(trees)), pa.int32()), pa.array([base] * len(trees), pa.float64())]
        return pa.table([*head, *columns], names=["model", "tree", "base", *PARTS])

    def grow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            model = batch.column(0).to_numpy()
            for m in np.unique(model):
                held.setdefault(int(m), []).append(batch if (model == m).all() else batch.filter(pa.array(model == m)))
        for m in sorted(held):
            yield from grow(m, pa.Table.from_batches(held.pop(m))).to_batches()

    return grow_all


# ---- a model of many rows -----------------------------------------------------------------
SUMS = "node int, feature int, bin int, n double, g double, h double, c double"


def _margins(batch: pa.RecordBatch, codes: np.ndarray, pending: list[dict]) -> np.ndarray:
    margin = batch.column("margin").to_numpy(zero_copy_only=False)
    for tree in pending:
        margin = margin + tree["value"][walk(tree, codes)]
    return margin


def _summed(batches: Iterator[pa.RecordBatch], s: Settings, turn: int, features: np.ndarray, bins: int, state) -> Iterator[pa.RecordBatch]:
    """Histograms of a partition, added up before they are shuffled."""
    pending, arrays, wanted = state.value
    place = np.full(len(arrays["feature"]), -1)
    place[wanted] = np.arange(len(wanted))
    total = None
    for batch in batches:
        row, y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "y", "w"))
        codes = unpack(batch.column("codes"), len(y))
        at = place[descend(arrays, codes, np.zeros(len(y), np.int64))]
        use = np.flatnonzero((at >= 0) & sampled(s, row, turn))
        sums = channels(s, _margins(batch, codes, pending)[use], y[use], w[use])
        part = histogram(codes[use], features, at[use], len(wanted), bins, sums)
        total = part if total is None else total + part
    if total is not None:
        at = np.nonzero(total[0])
        values = [pa.array(total[min(c, len(total) - 1)][at]) for c in range(4)]
        yield pa.RecordBatch.from_arrays([*(pa.array(v.astype(np.int32)) for v in at), *values], names=["node", "feature", "bin", "n", "g", "h", "c"])


def _moved(batches: Iterator[pa.RecordBatch], state) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = unpack(batch.column("codes"), batch.num_rows)
        yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(_margins(batch, codes, state.value)))


def boost_table(rows: DataFrame, s: Settings, cuts: list[np.ndarray]) -> tuple[float, list[dict[str, np.ndarray]]]:
    """The trees of a model over a table (row, y, w, codes): a Spark job for each level of each tree."""
    context, bins = rows.sparkSession.sparkContext, max((len(c) + 1 for c in cuts), default=1)
    totals = rows.agg(F.sum(F.col("w") * F.col("y")).alias("p"), F.sum(F.col("w") * (1 - F.col("y"))).alias("n")).first()
    base = log_odds(round(totals.p or 0.0, 6), round(totals.n or 0.0, 6))
    rows = cut_lineage(rows.withColumn("margin", F.lit(base)))
    schema, trees, pending = rows.schema, [], []
    for turn in range(s.rounds):
        features = sampled_features(s, len(cuts), turn)

        def measure(tree: Tree, wanted: list[int]) -> np.ndarray:
            state = context.broadcast((pending, tree.arrays(), wanted))
            found = rows.mapInArrow(lambda it: _summed(it, s, turn, features, bins, state), SUMS)
            found = found.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "nghc"]).toArrow()
            state.destroy()
            names = "ngh" if s.newton_splits else "nghc"
            out = np.zeros((len(names), len(wanted), len(features), bins))
            at = tuple(found[c].to_numpy() for c in ("node", "feature", "bin"))
            for c, name in enumerate(names):
                out[(c, *at)] = found[name].to_numpy()
            return out

        _, binned, tree = finished(s, *grow_tree(s, features, measure), cuts)
        trees.append(tree)
        pending.append(binned)
        if len(pending) == KEEP and turn + 1 < s.rounds:
            state = context.broadcast(pending)
            rows = cut_lineage(rows.mapInArrow(lambda it, state=state: _moved(it, state), schema))
            state.destroy()
            pending = []
    return base, trees


# ---- models -------------------------------------------------------------------------------
def _adder(shared):
    def add(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        base, trees = shared.value
        points, margin = np.stack(x.to_numpy()), np.full(len(x), base)
        for tree in trees:
            margin = margin + tree["value"][walk(tree, points)]
        return pd.Series(1.0 / (1.0 + np.exp(-margin)))

    return add


@dataclass
class BoostedModel:
    """Rounds x leaves bound its size, so it is held by the driver and broadcast whole."""

    settings: Settings
    features: int
    base: float
    trees: list[dict[str, np.ndarray]]

    def add_score(self, df: DataFrame, values: str, out: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.base, self.trees))
        return df.withColumn(out, F.pandas_udf(_adder(shared), "double")(F.col(values)))

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the gain that each feature brings."""
        gain = np.zeros(self.features)
        for t in self.trees:
            inner = t["feature"] >= 0
            np.add.at(gain, t["feature"][inner], t["gain"][inner])
        return Vectors.dense(gain / gain.sum() if gain.sum() > 0 else gain)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(0, i, self.base, *[t[k].tolist() for k in PARTS]) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, TREES).write.mode("overwrite").parquet(f"{path}/trees")
        about = spark.createDataFrame([(self.features, self.base, *asdict(self.settings).values())], ["features", "base", *asdict(self.settings)])
        about.write.mode("overwrite").parquet(f"{path}/boosted")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        about = spark.read.parquet(f"{path}/boosted").first().asDict()
        features, base = about.pop("features"), about.pop("base")
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        return BoostedModel(Settings(**about), features, base, [_tree(r) for r in rows])


def _tree(r) -> dict[str, np.ndarray]:
    return {k: np.array(r[k], np.int64 if k in ("feature", "left", "right") else float) for k in PARTS}


def _encoder(cuts: list[np.ndarray]):
    """Bins of a row's values, one byte each."""

    def encode(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        points = np.stack(x.to_numpy())
        codes = np.stack([np.searchsorted(c, points[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)
        return pd.Series([r.tobytes() for r in codes])

    return encode


def cuts_of(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """For each feature, middles between neighbouring quantiles of `bins` equal shares."""
    share = [i / bins for i in range(bins + 1)]
    at = [F.percentile_approx(F.get("x", F.lit(f)), share, 10_000).alias(f"q{f}") for f in range(features)]
    out = []
    for q in rows.agg(*at).first() if features else ():
        values = np.unique(np.array(q or [], float))
        middle = (values[:-1] + values[1:]) / 2
        out.append(np.where(middle < values[1:], middle, values[:-1])[: bins - 1])
    return out


def fit_many(rows: DataFrame, models: Mapping[int, Settings]) -> dict[int, BoostedModel]:
    """rows: row (long, hash of the row's key), y (0 or 1), w (weight), x (array of numbers) and models
    (array of the models that a row trains). The bins are those of all rows together; settings must agree
    on their number."""
    bins = {s.bins for s in models.values()}
    if len(bins) != 1:
        raise ValueError("models fitted together share their bins")
    exploded = rows.select(F.explode("models").alias("model"), F.size("x").alias("k")).groupBy("model")
    counts = {r.model: r for r in exploded.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k")).collect()}
    features = max((r.k for r in counts.values()), default=0)
    cuts = cuts_of(rows, features, bins.pop())
    encode = F.pandas_udf(_encoder(cuts), "binary")
    encoded = rows.select(
        F.col("row").cast("long"), F.col("y").cast("double"), F.col("w").cast("double"), encode(F.col("x").cast("array<double>")).alias("codes"), "models"
    )
    small = [m for m, r in counts.items() if r.n <= (models[m].bound or max(models[m].rows_in_task(features), held_rows(features)))]
    out = {m: BoostedModel(s, features, 0.0, []) for m, s in models.items()}
    if small:
        mine = F.filter("models", lambda m: m.isin(small))
        number = F.element_at(F.create_map(*[F.lit(v) for i, m in enumerate(small) for v in (m, i)]), F.col("model"))
        dealt = encoded.select(F.explode(mine.cast("array<int>")).alias("model"), "row", "y", "w", "codes")
        dealt = dealt.repartitionById(len(small), number)  # a task for each model
        for r in sorted(dealt.mapInArrow(_grower(models, cuts), TREES).collect(), key=lambda r: (r.model, r.tree)):
            out[r.model].base = r.base
            out[r.model].trees.append(_tree(r))
    large = [m for m in counts if m not in small]
    if large:
        encoded = encoded.persist(StorageLevel.MEMORY_AND_DISK)
        for m in large:
            own = encoded.where(F.array_contains("models", m)).drop("models")
            out[m].base, out[m].trees = boost_table(own, models[m], cuts)
        encoded.unpersist()
    return out


def fit(rows: DataFrame, s: Settings) -> BoostedModel:
    """rows: row, y, w, x, as in fit_many()."""
    return fit_many(rows.withColumn("models", F.array(F.lit(0))), {0: s})[0]
