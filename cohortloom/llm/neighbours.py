"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Method. Vectors are scaled by the largest norm and get one more component, so that a smaller
Euclidean distance is a larger inner product. A table's hash has M projections on normal (2-stable)
vectors, floor((a.x + b) / w) each. A query visits its own bucket and then perturbed buckets (one
step up or down in some projections) in the order of their estimated success: the sets of
perturbations are ordered once by the expected squared distance to the bucket edges, and applied to
the query's projections sorted by that distance. What the tables yield is merged and ranked by the
exact inner product in double precision.

The index is dealt by hash of the vectors into shards of about SHARD_ROWS, each with its own part
of every bucket, so no bucket is a task of its own, however full. Queries visit the shards in blocks
of about QUERY_ROWS. Equal vectors are one entry with their k + 1 smallest ids, which are all that
can be among the k nearest.

Width, number of projections and number of probes are fitted on CALIBRATION queries whose true
neighbours are found exactly over all rows, so that the recall is at least TARGET there.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component take no part,
nor do null ids and vectors whose length is not the most frequent one (ties: the longer). Rows that
share an id are one row, with the smallest of their vectors. With no queries or one vector only the
result has the rows there are.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import batch_of, mix, written

TABLES = 3
MAX_PROBES = 1_500
TARGET = 0.96
CALIBRATION = 64
#: Rows on which the share of vectors that a setting visits is estimated.
SAMPLE_ROWS = 2_000
SHARD_ROWS = 8_192
QUERY_ROWS = 8_192
SEED = 20_240


def perturbation_sets(m: int, limit: int) -> np.ndarray:
    """Sets of places among the 2m edge distances in rising order, best expected score first; the
    empty set leads. Rows of 0 and 1."""
    j = np.arange(1, m + 1)
    low = j * (j + 1) / (4 * (m + 1) * (m + 2))
    k = 2 * m + 1 - np.arange(m + 1, 2 * m + 1)
    high = 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2))
    z = np.concatenate((low, high))
    out, heap = [()], [(z[0], (0,))]
    while heap and len(out) < limit:
        score, own = heapq.heappop(heap)
        if not any(2 * m - 1 - i in own for i in own):  # not both edges of one projection
            out.append(own)
        last = own[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - z[last] + z[last + 1], own[:-1] + (last + 1,)))
            heapq.heappush(heap, (score + z[last + 1], own + (last + 1,)))
    rows = np.zeros((len(out), 2 * m), np.uint64)
    for i, own in enumerate(out):
        rows[i, list(own)] = 1
    return rows


class Hashing:
    """The hash tables of one setting. Vectors come with their extra component."""

    def __init__(self, dim: int, m: int, width: float, tables: int, seed: int):
        rng = np.random.default_rng(seed)
        self.m, self.width, self.tables = m, width, tables
        self.a = rng.standard_normal((tables, dim, m))
        self.b = rng.uniform(0, width, (tables, m))
        self.c = rng.integers(1, 1 << 62, (tables, m)).astype(np.uint64) | np.uint64(1)

    def cells(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.a[t] + self.b[t]) / self.width

    def sums(self, cells: np.ndarray, t: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (np.floor(cells).astype(np.int64).view(np.uint64) * self.c[t]).sum(axis=1, dtype=np.uint64)

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        return mix(self.sums(self.cells(x, t), t))

    def probes(self, x: np.ndarray, t: int, sets: np.ndarray) -> np.ndarray:
        """Buckets that each query visits, in order: queries x sets."""
        cells = self.cells(x, t)
        part = cells - np.floor(cells)
        order = np.argsort(np.concatenate((part, 1 - part), axis=1), axis=1, kind="stable")
        with np.errstate(over="ignore"):
            step = np.concatenate((np.uint64(0) - self.c[t], self.c[t]))[order]
            return mix(self.sums(cells, t)[:, None] + step @ sets.T)


@dataclass
class Plan:
    dim: int
    scale: float  # the largest norm
    m: int = 1
    width: float = 1e9
    tables: int = 1
    probes: int = 1
    recall: float = 1.0
    share: float = 1.0
    seed: int = SEED

    def hashing(self) -> Hashing:
        return Hashing(self.dim + 1, self.m, self.width, self.tables, self.seed)

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        return np.column_stack((x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros(len(x))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the k largest finite scores of each row, ties to the smaller id."""
    out = []
    edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
    for row, low in zip(scores, edge):
        at = np.flatnonzero((row >= low) & (row > -np.inf))
        out.append(at[np.lexsort((ids[at], -row[at]))[:k]])
    return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    v = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _exact(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """Vectors of the k best rows of a bounded number of queries, their own row apart."""
    dim = queries.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((ids, queries))
    schema = pa.schema([("q", pa.int32()), ("id", pa.int64()), ("score", pa.float64()), ("v", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        held: list[list] = [[] for _ in own]
        for batch in batches:
            x, xi = matrix(batch.column(1), dim), batch.column(0).to_numpy()
            scores = q @ x.T
            scores[own[:, None] == xi[None, :]] = -np.inf
            for i, at in enumerate(best_rows(scores, xi, k)):
                held[i] = sorted(held[i] + [(-scores[i, j], int(xi[j]), x[j]) for j in at], key=lambda r: r[:2])[:k]
        flat = [(i, r[1], -r[0], r[2].tolist()) for i, rs in enumerate(held) for r in rs]
        if flat:
            yield batch_of(schema, **dict(zip(schema.names, map(list, zip(*flat)))))

    found: list[list] = [[] for _ in ids]
    for r in rows.mapInArrow(run, "q int, id long, score double, v array<double>").collect():
        found[r.q].append((-r.score, r.id, r.v))
    return [np.array([v for _, _, v in sorted(f, key=lambda r: r[:2])[:k]]) for f in found]


def fit_plan(rows: DataFrame, query_rows: DataFrame, k: int, tables: int, target: float) -> Plan | None:
    """The setting that visits the smallest share of the rows among those that reach the target."""
    sizes = sorted(((r.n, r.d) for r in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()), reverse=True)
    if not sizes:
        return None
    n, dim = sizes[0]
    rows, query_rows = rows.where(F.size("v") == dim), query_rows.where(F.size("v") == dim)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    plan = Plan(dim, float(rows.agg(F.sqrt(F.max(norm))).first()[0]))
    draw = F.xxhash64("id", F.lit("calibration"))
    some = query_rows.orderBy(draw).limit(CALIBRATION).collect()
    if not some or n <= 2 * k:
        return plan  # everything is visited
    ids, q = np.array([r.id for r in some]), np.array([r.v for r in some])
    near = _exact(rows, ids, q, k)
    sample = np.array([r.v for r in rows.orderBy(draw).limit(SAMPLE_ROWS).select("v").collect()])
    pairs_q = np.repeat(np.arange(len(q)), [len(x) for x in near])
    pairs_x, xs = plan.rows(np.concatenate([x for x in near if len(x)])), plan.rows(sample)
    qs, best = plan.queries(q), None
    m = int(np.clip(round(np.log2(n) / 2.2), 4, 14))
    sets = perturbation_sets(m, MAX_PROBES)
    for width in (0.75, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 6.0, 8.0):
        h = Hashing(dim + 1, m, width, tables, plan.seed)
        first = np.full(len(pairs_q), len(sets))
        visits = np.full((len(q), len(xs)), len(sets))
        for t in range(tables):
            probes = h.probes(qs, t, sets)
            bucket, inverse = np.unique(h.buckets(xs, t), return_inverse=True)
            pair = h.buckets(pairs_x, t)
            for i in range(len(q)):
                order = np.argsort(probes[i], kind="stable")
                rank = lambda b, i=i, order=order, probes=probes: _rank(probes[i], order, b)
                own = pairs_q == i
                first[own] = np.minimum(first[own], rank(pair[own]))
                visits[i] = np.minimum(visits[i], rank(bucket)[inverse])
        reached = np.sort(first)
        needed = int(reached[min(len(reached) - 1, int(np.ceil(target * len(reached))) - 1)]) + 1
        if needed > len(sets):
            continue
        share = float((visits < needed).mean())
        if best is None or share < best.share:
            best = Plan(dim, plan.scale, m, width, tables, needed, float((first < needed).mean()), share, plan.seed)
    return best or plan


def _rank(probes: np.ndarray, order: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Place of each bucket among the probes, or their number."""
    at = np.minimum(np.searchsorted(probes[order], buckets), len(order) - 1)
    return np.where(probes[order][at] == buckets, order[at], len(order))


def search_shard(plan: Plan, entries: pa.Table, queries: pa.Table, k: int, schema: pa.Schema, chunk: int = 512) -> pa.Table:
    """The k + 1 best entries of one shard for each query that visits a bucket with entries."""
    out = []
    if entries.num_rows and queries.num_rows:
        x = matrix(entries.column("v").combine_chunks(), plan.dim)
        ids = entries.column("first").to_numpy()
        q_all, q_ids = matrix(queries.column("qv").combine_chunks(), plan.dim), queries.column("q").to_numpy()
        h, sets, xs = plan.hashing(), perturbation_sets(plan.m, plan.probes), plan.rows(x)
        tables = [np.unique(h.buckets(xs, t), return_inverse=True) for t in range(plan.tables)]
        lists = entries.column("ids").to_pylist()
        for start in range(0, len(q_all), chunk):
            q = q_all[start : start + chunk]
            visited = np.zeros((len(q), len(x)), bool)
            for t, (bucket, inverse) in enumerate(tables):
                probes = h.probes(plan.queries(q), t, sets)
                at = np.minimum(np.searchsorted(bucket, probes), len(bucket) - 1)
                hit = np.zeros((len(q), len(bucket)), bool)
                row, col = np.nonzero(bucket[at] == probes)
                hit[row, at[row, col]] = True
                visited |= hit[:, inverse.ravel()]
            scores = np.where(visited, q @ x.T, -np.inf)
            for i, best in enumerate(best_rows(scores, ids, k + 1)):
                if len(best):
                    pairs = [(v, float(scores[i, j])) for j in best for v in lists[j]]
                    pairs = sorted(pairs, key=lambda p: (-p[1], p[0]))[: k + 1]
                    out.append((int(q_ids[start + i]), [p[0] for p in pairs], [p[1] for p in pairs]))
    columns = [list(c) for c in zip(*out)] if out else [[], [], []]
    return pa.table({n: pa.array(c, schema.field(n).type) for n, c in zip(schema.names, columns)}, schema=schema)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = TABLES,
    target: float = TARGET,
) -> DataFrame:
    """For each query row, the k best rows found, itself apart: query_id, rank, vec_id, score.

    queries are rows of vectors. All their settings go into the plan, see fit_plan.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_column, vector_column), "vectors")
    asked = rows.join(queries.select(F.col(id_column).cast("long").alias("id")).distinct(), "id", "left_semi")
    plan = fit_plan(rows, asked, k, tables, target)
    result = "query_id long, rank int, vec_id long, score double"
    if plan is None:
        return spark.createDataFrame([], result)
    same = F.size("v") == plan.dim
    # equal vectors: Spark trims every task to k + 1 rows of a vector before it deals them out
    numbered = rows.where(same).withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    entries = written(numbered.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("first", F.col("ids")[0]), "entries")
    members = asked.where(same).join(entries.select("v", "first"), "v").select("first", F.col("id").alias("query_id"))
    wanted = members.select("first").distinct().join(entries.select("first", "v"), "first")
    shards = int(entries.count() // SHARD_ROWS) + 1
    blocks = int(wanted.count() // QUERY_ROWS) + 1
    cell = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = entries.select("first", "ids", "v", cell("first", shards, 1).alias("shard"), every(blocks).alias("block"))
    right = wanted.select(F.col("first").alias("q"), F.col("v").alias("qv"), cell("first", blocks, 2).alias("q_block"), every(shards).alias("q_shard"))
    schema = pa.schema([("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
    shared = spark.sparkContext.broadcast(plan)
    found = left.groupBy("shard", "block").cogroup(right.groupBy("q_shard", "q_block")).applyInArrow(
        lambda a, b: search_shard(shared.value, a, b, k, schema), "first long, ids array<long>, scores array<double>"
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for batch in batches:
            for q, ids, scores in zip(*(batch.column(i).to_pylist() for i in range(3))):
                best[q] = sorted(best.get(q, []) + list(zip([-s for s in scores], ids)))[: k + 1]
        if best:
            yield batch_of(schema, first=list(best), ids=[[i for _, i in b] for b in best.values()], scores=[[-s for s, _ in b] for b in best.values()])

    merged = found.repartition("first").mapInArrow(merge, "first long, ids array<long>, scores array<double>")
    pairs = F.filter(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score")), lambda p: p["vec_id"] != F.col("query_id"))
    answers = members.join(merged, "first").select("query_id", F.posexplode(F.slice(pairs, 1, k)).alias("at", "pair"))
    return answers.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("pair.vec_id").alias("vec_id"), F.col("pair.score").alias("score"))
