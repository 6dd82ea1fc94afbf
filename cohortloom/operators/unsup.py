"""Importance, clustering, projection and anomaly scores."""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import replace
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.functions.numeric import col, to_number
from cohortloom.operators import rank, sample, screen
from cohortloom.operators.joins import outer_scores
from cohortloom.operators.learn import Spec, fit_model
from cohortloom.operators.ordered import quantile_scalar
from cohortloom.session import cut_lineage


# ---- importance ---------------------------------------------------------------------------
def forest_importance(df: DataFrame, spec: Spec) -> DataFrame:
    """(feature, rf_importance) of a balanced forest."""
    values = fit_model(df, spec).model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(spec.features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, rf_importance double")


def feature_ranking(
    df: DataFrame, spec: Spec, min_score: float | None = None, top_n: int | None = None, fit_on: DataFrame | None = None
) -> tuple[DataFrame, dict]:
    """Mutual information and forest importance, each scaled to [0, 1] and averaged.

    Pass the training rows as fit_on to keep test rows out of the ranking. The second value
    holds the counts of the selection.
    """
    rows = df if fit_on is None else fit_on
    features, constant = screen.drop_constant(rows, spec.features)
    part = replace(spec, features=tuple(features))
    mi = screen.mutual_information(rows, features, spec.label).withColumnRenamed("mi", "mi_score")
    both = outer_scores(mi, forest_importance(rows, part), "feature")
    both = rank.minmax_normalise(both, "mi_score", "mi_norm")
    both = rank.minmax_normalise(both, "rf_importance", "rf_norm")
    ranked = both.withColumn("combined_score", (F.col("mi_norm") + F.col("rf_norm")) / 2)
    order = [F.desc("combined_score"), F.asc("feature")]
    if top_n is not None:
        kept = rank.sort_top_n(ranked, order, top_n)
    elif min_score is not None:
        kept = ranked.where(F.col("combined_score") >= min_score).orderBy(*order)
    else:
        kept = ranked.orderBy(*order)
    counts = {"candidate_features": len(features), "dropped_constant": len(constant), "min_combined_score_used": min_score}
    return kept, counts


def feature_stability(
    df: DataFrame, spec: Spec, top_k: int = 10, seeds: Sequence[int] = (42, 123, 456, 789, 2024)
) -> DataFrame:
    """One row: mean overlap of the top-k features over all pairs of seeded splits, most stable ones."""
    tops = []
    for seed in seeds:
        narrow = df.select(*[col(c) for c in (spec.key, spec.label, *spec.features)])
        split = sample.split_three_way(narrow, spec.key, spec.label, seed=seed)
        imp = forest_importance(split.where("split = 'train'"), replace(spec, seed=seed))
        tops.append(rank.sort_top_n(imp, [F.desc("rf_importance"), F.asc("feature")], top_k).select(F.lit(seed).alias("seed"), "feature"))
    every = reduce(DataFrame.unionByName, tops)
    n_pairs = len(list(combinations(seeds, 2)))
    counts = every.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    # a feature in n of the top sets is shared by n(n-1)/2 pairs of them
    score = F.sum(F.col("n") * (F.col("n") - 1) / 2) / (n_pairs * top_k)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("a"), "feature")))
    return counts.agg(score.alias("stability_score"), ordered.alias("o")).select(
        F.lit(len(seeds)).alias("n_splits"), F.lit(top_k).alias("top_k"), "stability_score",
        F.array_join(F.slice(F.transform("o", lambda x: x["feature"]), 1, top_k), ", ").alias("most_stable"),
    )


# ---- vectors ------------------------------------------------------------------------------
def embedding_vectors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(col(column).cast("array<double>")))


def column_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    numbers = {f"_f{i}": F.coalesce(to_number(c), F.lit(0.0)) for i, c in enumerate(columns)}
    return VectorAssembler(inputCols=list(numbers), outputCol="features").transform(df.withColumns(numbers)).drop(*numbers)


def standardise(df: DataFrame) -> DataFrame:
    scaler = StandardScaler(inputCol="features", outputCol="_z", withMean=True, withStd=True)
    return scaler.fit(df).transform(df).drop("features").withColumnRenamed("_z", "features")


def kmeans_profile(
    df: DataFrame, flags: Sequence[str], target: str, preop: DataFrame, key: str, columns: Sequence[str],
    k: int = 5, seeds: Sequence[int] = range(20),
) -> DataFrame:
    """(cluster, size, target_prevalence, flag means, preop means) of the best of several k-means runs."""
    # read by every run: the flags are worked out once
    rows = cut_lineage(column_vectors(df.select(*[col(c) for c in dict.fromkeys([key, target, *flags])]), flags))
    models = [KMeans(k=k, seed=s, maxIter=50).fit(rows) for s in seeds]
    best = min(models, key=lambda m: m.summary.trainingCost)
    labelled = best.transform(rows).withColumnRenamed("prediction", "cluster")
    profile = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(col(target).cast("double")).alias("target_prevalence"),
        *[F.avg(col(f)).alias(f) for f in flags],
    )
    joined = labelled.select(col(key), "cluster").join(preop, key)
    pre = joined.groupBy("cluster").agg(*[F.avg(to_number(c)).alias(f"{c}_mean") for c in columns])
    return profile.join(pre, "cluster", "left")


def pca_project(df: DataFrame, k: int = 2) -> tuple[DataFrame, dict[float, int]]:
    """Scores pc1..pck of the standardised vectors, and how many components explain 80 and 90 %."""
    rows = standardise(df)
    size = len(rows.select("features").first()[0])
    model = PCA(k=size, inputCol="features", outputCol="_pc").fit(rows)
    total = np.cumsum(model.explainedVariance.toArray())
    needed = {share: int(np.searchsorted(total, share) + 1) for share in (0.8, 0.9)}
    scores = model.transform(rows).withColumn("_a", vector_to_array("_pc"))
    return scores.withColumns({f"pc{i + 1}": F.col("_a")[i] for i in range(k)}).drop("_a", "_pc"), needed


# ---- isolation forest -----------------------------------------------------------------------
SUBSAMPLE = 256


def _average_path(n: float) -> float:
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(frame: pd.DataFrame) -> pd.DataFrame:
    """One isolation tree over at most SUBSAMPLE rows, as a table of nodes."""
    x = np.stack(frame["v"].to_numpy())
    tree = int(frame["tree"].iloc[0])
    rng = np.random.default_rng(tree)
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[list] = []

    def build(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree, me, -1, 0.0, -1, -1, depth + _average_path(len(rows))])
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            return me
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] < cut
        if left.all() or not left.any():
            return me
        nodes[me][2:4] = [f, cut]
        nodes[me][4] = build(rows[left], depth + 1)
        nodes[me][5] = build(rows[~left], depth + 1)
        return me

    build(np.arange(len(x)), 0)
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "path"])


NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double"


def isolation_forest(
    df: DataFrame, key: str, trees: int = 100, contamination: float = 0.1, seed: int = 42
) -> DataFrame:
    """(key, score, es_anomalia): isolation score of the standardised vectors, top share marked.

    Each tree sees SUBSAMPLE rows chosen by hash: rows far from the cut are discarded in
    the scan, so about four times the subsample reaches a tree's group. The forest (at most
    2 * SUBSAMPLE nodes per tree) travels with the scoring function.
    """
    rows = standardise(df).select(col(key), vector_to_array("features").alias("v"))
    n = rows.count()
    share = min(1.0, 4.0 * SUBSAMPLE / max(n, 1))
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.pmod(F.xxhash64(col(key), t, F.lit(seed)), F.lit(2**31)).alias("h")),
    )
    near = F.filter(draws, lambda d: d["h"] < F.lit(int(share * 2**31)))
    place = Window.partitionBy("tree").orderBy("h", col(key))
    picked = (
        rows.select(col(key), "v", F.explode(near).alias("d")).select(col(key), "v", "d.tree", "d.h")
        .withColumn("r", F.row_number().over(place)).where(F.col("r") <= SUBSAMPLE)
    )
    grown = picked.select("tree", "v").groupBy("tree").applyInPandas(_grow, NODE_SCHEMA).toPandas()
    forest = [
        {c: g.sort_values("node")[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")}
        for _, g in grown.groupby("tree")
    ]
    scale = _average_path(min(SUBSAMPLE, n))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            x = np.stack(frame["v"].to_numpy())
            depth = np.zeros(len(x))
            for t in forest:
                at = np.zeros(len(x), dtype=int)
                while True:
                    inner = t["feature"][at] >= 0
                    if not inner.any():
                        break
                    rows_in, f = np.flatnonzero(inner), t["feature"][at[inner]]
                    goes_left = x[rows_in, f] < t["cut"][at[inner]]
                    at[rows_in] = np.where(goes_left, t["left"][at[inner]], t["right"][at[inner]])
                depth += t["path"][at]
            yield pd.DataFrame({key: frame[key], "score": 2.0 ** (-depth / len(forest) / max(scale, 1e-9))})

    kind = dict(df.dtypes)[key]
    scored = rows.mapInPandas(score, f"`{key}` {kind}, score double")
    cut = quantile_scalar(scored, "score", 1.0 - contamination)
    return scored.withColumn("es_anomalia", (F.col("score") > cut).cast("int"))


# ---- local outlier factor ---------------------------------------------------------------------
BLOCK_ROWS = 2048
#: Distances to blocks that a task holds at once.
CELLS = 4_000_000
#: Queries for groups of blocks that leave a task at once.
ASKED = 10_000
#: Bytes of vectors in a group of blocks, and of the queries that a task holds them against.
GROUP_BYTES = 128 << 20
QUERY_BYTES = 64 << 20


def _nearest(x: np.ndarray, y: np.ndarray, ids_x, ids_y, weights, k: int):
    """For each row of x the closest rows of y until their weights reach k; the row itself is left out."""
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T
    d = np.sqrt(np.maximum(d2, 0.0))
    d[ids_x[:, None] == ids_y[None, :]] = np.inf
    order = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
    for i in range(len(x)):
        got = 0
        for j in order[i]:
            if not np.isfinite(d[i, j]) or got >= k:
                break
            got += int(weights[j])
            yield int(ids_x[i]), int(ids_y[j]), float(d[i, j]), int(weights[j])


def _reached(x: np.ndarray, pivots: np.ndarray, bound: np.ndarray, cell: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Rows x blocks: whether the ball of a block reaches into the bound of a row."""
    d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0))
    return d[:, cell] - radius[None, :] <= bound[:, None] + 1e-9


def _closest(found: list[tuple[np.ndarray, ...]], bound: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k closest (row, id, distance, weight) of each row, ties by id; bound falls to the k-th distance."""
    q, o, d, w = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((o, d, q))
    q, o, d, w = q[order], o[order], d[order], w[order]
    size = np.bincount(q, minlength=len(bound))
    rank = np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size)
    last = np.flatnonzero(rank == k - 1)
    bound[q[last]] = np.minimum(bound[q[last]], d[last])
    return tuple(c[rank < k] for c in (q, o, d, w))


def _searcher(pivots: np.ndarray, ball_cell: np.ndarray, ball_radius: np.ndarray, k: int):
    """The function that Spark applies to a group of blocks and a share of the queries."""

    def search(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, bound, w, number = (part[c].to_numpy() for c in ("id", "bound", "w", "number"))
        x = part["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        order, asked = np.lexsort((ids, number)), np.flatnonzero(number < 0)
        order = order[len(asked) :]
        begin = np.flatnonzero(np.append(True, np.diff(number[order]) > 0)) if len(order) else order
        blocks = [(int(number[rows[0]]), ids[rows], x[rows], w[rows]) for rows in np.split(order, begin[1:]) if len(rows)]
        blocks = [(b, o, y, (y * y).sum(1), n) for b, o, y, n in blocks]
        numbers = np.array([b for b, *_ in blocks], np.int64)
        for at in range(0, len(asked), BLOCK_ROWS):
            rows = asked[at : at + BLOCK_ROWS]
            q, z, limit = ids[rows], x[rows], bound[rows].copy()
            square, hit = (z * z).sum(1), _reached(z, pivots, limit, ball_cell[numbers], ball_radius[numbers])
            found, held = [], 0
            for (_, o, y, length, n), mine in zip(blocks, hit.T):
                own = np.flatnonzero(mine)
                d2 = square[own][:, None] + length[None, :] - 2.0 * z[own] @ y.T
                # a little more than the bound, so that rounding loses no neighbour
                i, j = np.nonzero(d2 <= (limit[own] * limit[own] * (1 + 1e-9) + 1e-9)[:, None])
                other = q[own[i]] != o[j]
                i, j = i[other], j[other]
                found.append((own[i], o[j], np.sqrt(np.maximum(d2[i, j], 0.0)), n[j]))
                held += len(i)
                if held > 4 * k * len(rows):
                    found = [_closest(found, limit, k)]
                    held = len(found[0][0])
            if found:
                i, *rest = _closest(found, limit, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (q[i], *rest)], names=["q", "o", "dist", "w"])

    def search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            part = batch.column(0).to_numpy()
            for p in np.unique(part):
                held.setdefault(int(p), []).append(batch if (part == p).all() else batch.filter(pa.array(part == p)))
        for p in sorted(held):
            yield from search(pa.Table.from_batches(held.pop(p)))

    return search_all


def nearest_neighbours(df: DataFrame, key: str, k: int, cells: int = 64, seed: int = 42) -> DataFrame:
    """Exact (q, o, dist, w): the nearest distinct vectors of each distinct vector.

    Equal vectors are one point with weight w, so a group of copies costs one row. Points go
    to the cell of their closest pivot, and cells are cut into blocks of about BLOCK_ROWS
    points. The own block bounds a point's k-th distance; only blocks whose ball reaches
    into that bound are searched, in chunks of about BLOCK_ROWS queries. A task holds a group of
    neighbouring blocks and a share of the queries, so a query is sent and answered once for each
    group of GROUP_BYTES, not for each block, and memory doesn't depend on the number of points.
    """
    points = (
        df.select(col(key).alias("id"), vector_to_array("features").alias("v"))
        .groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w"))
    )
    first = points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(cells)
    pivots = np.stack([np.array(r["v"]) for r in first.collect()])

    def to_cell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            x = np.stack(frame["v"].to_numpy())
            d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0))
            yield frame.assign(cell=d.argmin(1).astype("int32"), r=d.min(1))

    placed = points.select("id", "v", "w").mapInPandas(to_cell, "id long, v array<double>, w long, cell int, r double")
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts"))
    blocked = placed.join(parts, "cell").withColumn(
        "block", F.concat_ws("-", "cell", F.pmod(F.xxhash64("id"), F.col("parts")))
    )
    packed = blocked.groupBy("block", "cell").agg(F.collect_list(F.struct("id", "v", "w")).alias("pts"))

    def own(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pts in frame["pts"]:
            ids, w = np.array([p["id"] for p in pts]), np.array([p["w"] for p in pts])
            x = np.stack([p["v"] for p in pts])
            reach = {int(i): (int(n) - 1, math.inf if n <= k else 0.0) for i, n in zip(ids, w)}
            for q, _o, d, n in _nearest(x, x, ids, ids, w, k):
                got, bound = reach[q]
                if got < k:
                    reach[q] = (got + n, d if got + n >= k else math.inf)
            out += [(i, b) for i, (_g, b) in reach.items()]
        return pd.DataFrame(out, columns=["id", "bound"])

    bounds = packed.groupBy("block", "cell").applyInPandas(own, "id long, bound double")
    # one row per block: cell, radius and rows, a table of n / BLOCK_ROWS rows
    balls = blocked.groupBy("block", "cell").agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n")).toPandas()
    balls = balls.sort_values(["cell", "block"], ignore_index=True)
    wide = 8 * pivots.shape[1]
    group_of = (balls["n"].cumsum() - balls["n"]).to_numpy() * wide // GROUP_BYTES
    groups = np.unique(group_of, return_inverse=True)[1].astype("int32")
    first, n_groups = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), int(groups.max()) + 1
    ball_cell, ball_radius = balls["cell"].to_numpy(), balls["radius"].to_numpy()
    spark = df.sparkSession
    shares = int(max(1, -(-int(balls["n"].sum()) * wide // QUERY_BYTES), -(-2 * spark.sparkContext.defaultParallelism // n_groups)))

    def targets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            step = max(1, CELLS // max(len(ball_cell), 1))
            for part in (frame.iloc[i : i + step] for i in range(0, len(frame), step)):
                hit = _reached(np.stack(part["v"].to_numpy()), pivots, part["bound"].to_numpy(), ball_cell, ball_radius)
                rows, at = np.nonzero(np.logical_or.reduceat(hit, first, axis=1))
                ids, vectors, bound = (part[c].to_numpy() for c in ("id", "v", "bound"))
                for i in range(0, len(rows), ASKED):
                    own, to = rows[i : i + ASKED], at[i : i + ASKED].astype("int32")
                    yield pd.DataFrame({"id": ids[own], "v": vectors[own], "bound": bound[own], "group": to})

    asked = blocked.join(bounds, "id").select("id", "v", "bound").mapInPandas(targets, "id long, v array<double>, bound double, group int")
    share = F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int")
    queries = asked.select((F.col("group") * shares + share).alias("part"), "id", "v", "bound", F.lit(0).cast("long").alias("w"), F.lit(-1).alias("number"))
    places = spark.createDataFrame([(str(b), i, int(g)) for i, (b, g) in enumerate(zip(balls["block"], groups))], "block string, number int, group int")
    held = blocked.join(places, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    held = held.select((F.col("group") * shares + F.col("share")).alias("part"), "id", "v", F.lit(0.0).alias("bound"), "w", "number")
    dealt = held.unionByName(queries).repartitionById(n_groups * shares, "part")
    found = dealt.mapInArrow(_searcher(pivots, ball_cell, ball_radius, k), "q long, o long, dist double, w long")
    # the copies of a point are its own neighbours at distance 0
    copies = points.where("w > 1").select(F.col("id").alias("q"), F.col("id").alias("o"), F.lit(0.0).alias("dist"), (F.col("w") - 1).alias("w"))
    order = Window.partitionBy("q").orderBy("dist", "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = found.unionByName(copies).withColumn("cum", F.sum("w").over(order))
    return ranked.where(F.col("cum") - F.col("w") < k).select(
        "q", "o", "dist", F.least("w", F.lit(k) - (F.col("cum") - F.col("w"))).alias("w")
    )


def local_outlier_factor(df: DataFrame, key: str, k: int = 20, scale: bool = True) -> DataFrame:
    """(key, lof): ratio of the neighbours' density to the own density, about 1 inside a cluster."""
    rows = standardise(df) if scale else df
    near = cut_lineage(nearest_neighbours(rows, key, k))  # read three times
    reach = near.groupBy("q").agg(F.max("dist").alias("kd"))
    pairs = near.join(reach.select(F.col("q").alias("o"), F.col("kd").alias("okd")), "o")
    density = pairs.groupBy("q").agg(
        (F.sum("w") / (F.sum(F.greatest("dist", "okd") * F.col("w")) + 1e-10 * F.sum("w"))).alias("lrd")
    )
    factor = (
        near.join(density.select(F.col("q").alias("o"), F.col("lrd").alias("olrd")), "o")
        .groupBy("q").agg((F.sum(F.col("olrd") * F.col("w")) / F.sum("w")).alias("m"))
        .join(density, "q").select("q", (F.col("m") / F.col("lrd")).alias("lof"))
    )
    ids = rows.select(col(key), vector_to_array("features").alias("v"))
    first = ids.groupBy("v").agg(F.min(col(key)).alias("q"))
    return ids.join(first, "v").join(factor, "q").select(col(key), "lof")
