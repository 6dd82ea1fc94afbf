"""Forests against a plain recursive version with the same draws, whatever part of a tree Spark grows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import forest
from cohortloom.operators.forest import ROOT, Settings


def table(spark, n, seed, levels=None, partitions=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4)) if levels is None else r.integers(0, levels, (n, 4)).astype(float)
    x[:, 3] = 1.0  # never tried
    y = ((x[:, 0] > 0.3) ^ (r.random(n) < 0.2)).astype(float)
    w = np.where(y == 1, 2.0, 0.5)
    rows = [(i * 7919 + 13, float(y[i]), float(w[i]), x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "row long, y double, w double, x array<double>").repartition(partitions), rows


def plain_tree(s, tree, rows):
    """Nested tuples: (feature, rows left, left, right) or the share of positive weight."""

    def gini(part):
        p, q = sum(w for _, y, w, _ in part if y), sum(w for _, y, w, _ in part if not y)
        return (p * p + q * q) / (p + q) if part else 0.0

    def node(part, number, depth):
        p, total = sum(w for _, y, w, _ in part if y), sum(w for _, _, w, _ in part)
        leaf = p / total if total else 0.0
        if leaf in (0.0, 1.0) or s.depth and depth >= s.depth:
            return leaf
        columns = np.array([v for *_, v in part])
        lo, hi = columns.min(axis=0), columns.max(axis=0)
        first = np.argsort(forest.draw(s.seed, tree, number, len(lo), 0))
        u, best = forest.draw(s.seed, tree, number, len(lo), 1), None
        for f in [f for f in first if lo[f] < hi[f]][: s.tried(len(lo))]:
            cuts = [lo[f] + u[f] * (hi[f] - lo[f])] if s.random_splits else sorted(set(columns[:, f]))[:-1]
            for cut in cuts:
                sides = [r for r in part if r[3][f] <= cut], [r for r in part if r[3][f] > cut]
                if min(map(len, sides)) >= s.min_leaf:
                    value = gini(sides[0]) + gini(sides[1])
                    if best is None or value > best[0] + 1e-9:
                        best = (value, int(f), *sides)
        if best is None:
            return leaf
        return (best[1], len(best[2]), node(best[2], forest.child(number, 0), depth + 1), node(best[3], forest.child(number, 1), depth + 1))

    used = []
    for row, y, w, v in rows:
        k = forest.bootstrap_counts(np.array([row], np.int64), tree, s.seed)[0] if s.bootstrap else 1
        if k:
            used.append((row, y, w * k, v))
    return node(used, ROOT, 0)


def nested(arrays, s, tree, rows):
    used = [r for r in rows if not s.bootstrap or forest.bootstrap_counts(np.array([r[0]], np.int64), tree, s.seed)[0]]

    def node(at, part):
        f = int(arrays["feature"][at])
        if f < 0:
            return float(arrays["value"][at])
        left = [r for r in part if r[3][f] <= arrays["threshold"][at]]
        right = [r for r in part if r[3][f] > arrays["threshold"][at]]
        return (f, len(left), node(arrays["left"][at], left), node(arrays["right"][at], right))

    return node(0, used)


def close(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and close(a[2], b[2]) and close(a[3], b[3])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and abs(a - b) < 1e-9


@pytest.mark.parametrize("random_splits,bootstrap,levels", [(True, False, None), (True, True, None), (False, True, 9), (False, False, 5)])
@pytest.mark.parametrize("bound", [1000, 40])
def test_trees_equal_a_plain_version(spark, random_splits, bootstrap, levels, bound):
    rows, plain = table(spark, 160, 3, levels)
    s = Settings(trees=3, bootstrap=bootstrap, random_splits=random_splits, bound=bound, seed=5, block=2)
    model = forest.fit(rows, s)
    trees = {t: a for block in model.blocks() for t, a in block.items()}
    assert any(len(top.feature) > 1 for top in model.tops.values()) == (bound == 40)
    for t in range(3):
        assert close(nested(trees[t], s, t, plain), plain_tree(s, t, plain))


def test_open_depth_separates_rows_and_limits_hold(spark):
    rows, _ = table(spark, 300, 1)
    deep = forest.fit(rows, Settings(trees=4, bootstrap=False, random_splits=True, bound=60))
    scored = deep.add_score(rows, "x", "score")
    assert scored.where(F.abs(F.col("score") - F.col("y")) > 1e-9).count() == 0  # pure leaves
    flat = forest.fit(rows, Settings(trees=4, depth=2, bound=60))
    assert all(len(a["feature"]) <= 7 for block in flat.blocks() for a in block.values())
    wide = forest.fit(rows, Settings(trees=2, min_leaf=50, bootstrap=False, bound=60))
    leaves = wide.add_score(rows, "x", "score").groupBy("score").count()
    assert leaves.agg(F.min("count")).first()[0] >= 50 or leaves.count() > 2


def test_blocks_importance_and_storage(spark, tmp_path, monkeypatch):
    rows, _ = table(spark, 250, 2)
    model = forest.fit(rows, Settings(trees=6, bound=80))
    gain = model.featureImportances.toArray()
    assert gain.argmax() == 0 and gain[3] == 0 and abs(gain.sum() - 1) < 1e-9
    once = [r.score for r in model.add_score(rows, "x", "score").orderBy("row").collect()]
    monkeypatch.setattr(forest, "MODEL_BYTES", 2000)
    assert len(list(model.blocks())) > 1
    model.save(f"{tmp_path}/m")
    again = forest.ForestModel.load(spark, f"{tmp_path}/m")
    assert [r.score for r in again.add_score(rows, "x", "score").orderBy("row").collect()] == pytest.approx(once)


def test_partitions_do_not_matter_and_odd_tables(spark):
    rows, _ = table(spark, 200, 4)
    s = Settings(trees=3, bound=70)
    score = lambda df: [r.score for r in forest.fit(df, s).add_score(rows, "x", "score").orderBy("row").collect()]
    assert score(rows.repartition(1)) == pytest.approx(score(rows.repartition(7)))
    none = forest.fit(rows.limit(0), s)
    assert {r.score for r in none.add_score(rows, "x", "score").collect()} == {0.0}
    same = forest.fit(rows.withColumn("x", F.array(F.lit(1.0), F.lit(2.0))), Settings(trees=2, bootstrap=False, bound=50))
    got = {round(r.score, 6) for r in same.add_score(rows.withColumn("x", F.array(F.lit(1.0), F.lit(2.0))), "x", "score").collect()}
    want = rows.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()[0]
    assert got == {round(want, 6)}


@pytest.mark.parametrize("bound", [1000, 40])
def test_part_of_a_forest_equals_a_smaller_one(spark, bound):
    rows, _ = table(spark, 220, 8)
    score = lambda m: [r.score for r in m.add_score(rows, "x", "score").orderBy("row").collect()]
    whole = forest.fit(rows, Settings(trees=5, bound=bound, bins=300))
    for trees, depth in ((5, 3), (2, 0), (3, 1)):
        alone = forest.fit(rows, Settings(trees=trees, depth=depth, bound=bound, bins=300))
        assert score(whole.limited(trees, depth)) == pytest.approx(score(alone))
    with pytest.raises(ValueError):
        whole.limited(6, 0)
    with pytest.raises(ValueError):
        whole.limited(5, 3).limited(5, 4)
    with pytest.raises(ValueError):
        whole.limited(5, 3).featureImportances  # noqa: B018


@pytest.mark.parametrize("random_splits", [True, False])
def test_forests_of_several_row_sets_equal_single_ones(spark, random_splits):
    rows, _ = table(spark, 240, 9)
    s = Settings(trees=3, bound=1000, random_splits=random_splits, seed=4)
    part = lambda m: rows.where(F.col("row") % 3 != m)
    both = part(0).withColumn("model", F.lit(0)).unionByName(part(1).withColumn("model", F.lit(1)))
    score = lambda m: [r.score for r in m.add_score(rows, "x", "score").orderBy("row").collect()]
    found = forest.fit_many(both, s, 3)
    for m in (0, 1):
        assert score(found[m]) == pytest.approx(score(forest.fit(part(m), s)))
    assert set(score(found[2])) == {0.0}  # no row carries it


def test_bootstrap_counts_have_mean_one():
    k = forest.bootstrap_counts(np.arange(200_000), 3, 42)
    assert abs(k.mean() - 1) < 0.01 and abs((k == 0).mean() - np.exp(-1)) < 0.005


def test_contributions_equal_full_enumeration(spark):
    import itertools

    rows, plain = table(spark, 120, 6)
    model = forest.fit(rows, Settings(trees=3, bound=50, seed=2))
    points = np.array([v for *_, v in plain])
    background = points.mean(axis=0)
    want = np.zeros(points.shape)
    trees = [a for block in model.blocks() for a in block.values()]
    for arrays in trees:
        value = lambda z: arrays["value"][forest.walk(arrays, z)]  # noqa: E731, B023
        for order in itertools.permutations(range(4)):
            mixed = np.tile(background, (len(points), 1))
            for f in order:
                before = value(mixed)
                mixed[:, f] = points[:, f]
                want[:, f] += (value(mixed) - before) / 24
    found = model.add_contributions(rows, "x", background, "c").orderBy("row").select("c").collect()
    got = np.array([r.c for r in found])
    assert np.allclose(got, want / len(trees), atol=1e-9)
    scored = [r.score for r in model.add_score(rows, "x", "score").orderBy("row").collect()]
    base = np.mean([a["value"][forest.walk(a, background[None])][0] for a in trees])
    assert np.allclose(got.sum(axis=1) + base, scored)


def test_middling_tables_grow_in_tasks_without_jobs_for_levels(spark, monkeypatch):
    assert Settings().bounded(5).bound == 800_000 and Settings().bounded(4000).bound == forest.LEAST_BOUND
    assert Settings(bound=40).bounded(5).bound == 40
    n = 60_000
    rows = spark.range(n).selectExpr("id AS row", "CAST(id % 7 < 3 AS double) AS y", "1.0D AS w", "array(CAST(id % 7 AS double), CAST(id % 11 AS double)) AS x")
    model = forest.fit(rows, Settings(trees=2, depth=3))
    assert all(top.feature == [-1] and top.rows == [n] for top in model.tops.values())
    right = model.add_score(rows, "x", "s").where("(s >= 0.5) = (y = 1)").count()
    assert right > 0.9 * n


def test_rows_are_dealt_in_pieces_and_their_order_does_not_matter(spark):
    rows, plain = table(spark, 400, 11, levels=7, partitions=2)
    s = Settings(trees=5, bound=1000)
    tops = {t: forest.Top(rows=[400]) for t in range(5)}
    pieces = rows.withColumn("model", F.lit(0)).mapInArrow(lambda it: forest.deal(it, s, tops), forest.DEALT).collect()
    assert len(pieces) == 2 * 5  # a piece for each partition and tree, not a row for each row
    used = sum((forest.bootstrap_counts(np.array([r for r, *_ in plain], np.int64), t, s.seed) > 0).sum() for t in range(5))
    assert sum(len(p.rows) for p in pieces) == used * 6 * 8
    x, y = np.array([v for *_, v in plain]), np.array([y for _, y, _, _ in plain])
    x = np.column_stack((x, np.random.default_rng(1).normal(size=400)))
    mixed = np.random.default_rng(2).permutation(400)
    for random_splits in (False, True):
        s = Settings(random_splits=random_splits)
        assert forest.grow(s, 0, ROOT, 0, x, 0.7 * y, 1 - y) == forest.grow(s, 0, ROOT, 0, x[mixed], 0.7 * y[mixed], 1 - y[mixed])


def test_cuts_are_the_same_from_sums_and_from_sorted_rows():
    r = np.random.default_rng(3)
    g, codes = np.sort(r.integers(0, 6, 900)), r.integers(0, 40, 900)
    pos = r.integers(0, 3, 900).astype(float)
    neg, values = 1.5 * (pos == 0), np.sort(r.normal(size=40))
    sums = np.stack([np.bincount(g, w, 6) for w in (None, pos, neg)], axis=1)
    dense = forest._best_cuts(g, codes, pos, neg, sums, 3, values)
    sparse = forest._best_cuts(g, codes * 1000, pos, neg, sums, 3, np.repeat(values, 1000))
    huge = forest._best_cuts(g, codes << 55, pos, neg, sums, 3, _Spread(values))
    for found in (sparse, huge):
        assert (found[0] == dense[0]).all() and np.allclose(found[1], dense[1]) and np.allclose(found[2], dense[2])


class _Spread:
    """Values of codes too great to be packed into one number with node and place."""

    def __init__(self, values):
        self.values = values

    def __len__(self):
        return len(self.values) << 55

    def __getitem__(self, codes):
        return self.values[codes >> 55]


@pytest.mark.parametrize("random_splits,bootstrap", [(True, False), (False, True)])
def test_whole_trees_grow_from_a_table_that_a_task_holds(spark, monkeypatch, random_splits, bootstrap):
    rows, plain = table(spark, 150, 21, levels=8)
    monkeypatch.setattr(forest, "deal", lambda *a: pytest.fail("rows dealt tree by tree"))
    monkeypatch.setattr(forest, "PIECE_ROWS", 20)
    s = Settings(trees=5, bootstrap=bootstrap, random_splits=random_splits, seed=6)
    # a key twice with other values, and rows without weight
    odd = spark.createDataFrame([(13, 0.0, 0.5, [3.0, 1.0, 2.0, 1.0]), (999, 1.0, 0.0, [1.0, 1.0, 1.0, 9.0])], rows.schema)
    plain = [*plain, (13, 0.0, 0.5, [3.0, 1.0, 2.0, 1.0])]
    trees = {t: a for block in forest.fit(rows.unionByName(odd), s).blocks() for t, a in block.items()}
    for t in range(5):
        assert close(nested(trees[t], s, t, plain), plain_tree(s, t, plain))


def test_nodes_of_few_rows_grow_apart_and_trees_are_kept_whole(monkeypatch):
    r = np.random.default_rng(8)
    x, y = r.integers(0, 50, (3000, 3)).astype(float), (r.random(3000) < 0.4).astype(float)
    for s in (Settings(), Settings(random_splits=True), Settings(depth=4, min_leaf=30)):
        monkeypatch.setattr(forest, "CACHED_ROWS", 1 << 19)
        whole = {k: np.array(v) for k, v in forest.grow(s, 1, ROOT, 0, x, 0.7 * y, 1 - y).items()}
        monkeypatch.setattr(forest, "CACHED_ROWS", 100)
        apart = {k: np.array(v) for k, v in forest.grow(s, 1, ROOT, 0, x, 0.7 * y, 1 - y).items()}
        assert np.allclose(whole["value"][forest.walk(whole, x)], apart["value"][forest.walk(apart, x)])
        again = forest.unpacked(forest.packed(apart, 3), len(apart["feature"]), 3)
        inner = apart["feature"] >= 0
        assert all((again[k] == apart[k]).all() for k in ("feature", "left", "right", "value"))
        assert (again["threshold"][inner] == apart["threshold"][inner]).all()


def test_a_large_forest_is_applied_without_the_driver(spark, monkeypatch):
    rows, _ = table(spark, 230, 12)
    rows = rows.withColumns({"at": F.expr("timestamp'2024-03-01 08:00:00' + make_interval(0, 0, 0, CAST(row % 9 AS int))"), "s": F.struct("y", "w"), "none": F.lit(None).cast("string"), "a`b": F.lit(1)})
    background = [0.1, 0.2, 0.3, 1.0]
    for bound, part in ((0, lambda m: m), (60, lambda m: m.limited(4, 3))):
        model = part(forest.fit(rows, Settings(trees=6, bound=bound, bins=300)))
        monkeypatch.setattr(forest, "MODEL_BYTES", 64 << 20)
        want = model.add_score(model.add_contributions(rows, "x", background, "c"), "x", "score").orderBy("row").collect()
        for name, size in (("MODEL_BYTES", 500), ("BLOCK_BYTES", 3000), ("PAGED_BYTES", 2000)):
            monkeypatch.setattr(forest, name, size)
        with monkeypatch.context() as m:
            m.setattr(forest.ForestModel, "_whole", lambda *a: pytest.fail("trees in the driver"))
            done = model.add_score(model.add_contributions(rows, "x", background, "c"), "x", "score")
            again = model.add_score(done, "x", "score")
            assert model.add_score(rows.limit(0), "x", "score").count() == 0
        assert done.columns == [*rows.columns, "c", "score"] and done.dtypes[:-2] == rows.dtypes
        for got in (done, again):
            for a, b in zip(got.orderBy("row").collect(), want, strict=True):
                assert a[:-2] == b[:-2] and np.allclose(a.c, b.c) and np.isclose(a.score, b.score)
