"""Boosted trees against a plain recursive version, whether a task or Spark adds up the histograms."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import boost
from cohortloom.operators.boost import Settings

DEPTHS = Settings(rounds=4, rate=0.3, depth=3, l2=1.0, min_hessian=1.0)
LEAVES = Settings(rounds=4, rate=0.3, leaves=6, min_rows=5)
CLASSIC = Settings(rounds=4, rate=0.3, depth=3, newton_splits=False)
DRAWN = Settings(rounds=17, rate=0.3, depth=3, l2=1.0, row_share=0.7, feature_share=0.6)


def table(spark, n, seed, levels=20, partitions=3):
    r = np.random.default_rng(seed)
    x = r.integers(0, levels, (n, 4)).astype(float)
    x[:, 3] = 1.0  # never cut
    y = ((x[:, 0] > levels / 2) ^ (x[:, 1] < levels / 4) ^ (r.random(n) < 0.1)).astype(float)
    rows = [(i * 7919 + 13, float(y[i]), 2.0 if y[i] else 0.5, x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "row long, y double, w double, x array<double>").repartition(partitions), rows


def plain_margins(s, rows):
    """Margins of all rows after each round; every cut of every node is tried by itself."""
    x, y, w = (np.array([r[i] for r in rows]) for i in (3, 1, 2))
    margin = np.full(len(y), np.log((w * y).sum() / (w * (1 - y)).sum()))
    out = []
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (p - y) * 2**20) / 2**20, np.rint(w * p * (1 - p) * 2**20) / 2**20
        c = h if s.newton_splits else w

        def score(part):
            return g[part].sum() ** 2 / (c[part].sum() + s.l2)

        def best(part, depth):
            found = (0.0, None)
            if s.depth and depth >= s.depth:
                return found
            for f in range(x.shape[1]):
                for cut in sorted(set(x[part, f]))[:-1]:
                    left, right = part[x[part, f] <= cut], part[x[part, f] > cut]
                    if min(len(left), len(right)) < s.min_rows or min(h[left].sum(), h[right].sum()) < s.min_hessian:
                        continue
                    gain = score(left) + score(right) - score(part)
                    if gain > max(found[0], 1e-7) + 1e-9:
                        found = (gain, (left, right))
            return found

        ends = [(np.arange(len(y)), 0)]
        while not s.leaves or len(ends) < s.leaves:
            gains = [best(*e) for e in ends]
            k = int(np.argmax([v for v, _ in gains]))
            if gains[k][1] is None:
                break
            depth = ends.pop(k)[1] + 1
            ends += [(side, depth) for side in gains[k][1]]
        for part, _ in ends:
            margin[part] -= s.rate * g[part].sum() / (h[part].sum() + s.l2)
        out.append(margin.copy())
    return out


def margins(model, rows):
    x = np.array([r[3] for r in rows])
    at, out = np.full(len(x), model.base), []
    for t in model.trees:
        at = at + t["value"][boost.walk(t, x)]
        out.append(at)
    return out


@pytest.mark.parametrize("s", [DEPTHS, LEAVES, CLASSIC], ids=["depths", "leaves", "classic"])
@pytest.mark.parametrize("bound", [1000, 10], ids=["task", "spark"])
def test_trees_equal_a_plain_version(spark, s, bound):
    df, rows = table(spark, 200, 3)
    model = boost.fit(df, Settings(**{**vars(s), "bound": bound}))
    for got, want in zip(margins(model, rows), plain_margins(s, rows), strict=True):
        assert np.allclose(got, want, atol=1e-9)


def test_a_model_depends_neither_on_bound_nor_on_partitions(spark):
    a = boost.fit(table(spark, 300, 5, 300, 1)[0], DRAWN)
    b = boost.fit(table(spark, 300, 5, 300, 4)[0], Settings(**{**vars(DRAWN), "bound": 20}))
    assert len(a.trees) == DRAWN.rounds > boost.KEEP
    for s, t in zip(a.trees, b.trees, strict=True):
        assert all(np.array_equal(s[k], t[k]) for k in boost.PARTS)
    used = [set(t["feature"][t["feature"] >= 0]) for t in a.trees]
    assert len({frozenset(u) for u in used}) > 1 and all(len(u) <= 2 for u in used)


def test_loss_falls_each_round_and_leaves_are_bounded(spark):
    df, rows = table(spark, 400, 7)
    model = boost.fit(df, Settings(rounds=30, rate=0.1, leaves=5, min_rows=3))
    y, w = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    loss = [(w * (np.log1p(np.exp(m)) - y * m)).sum() for m in margins(model, rows)]
    assert all(a > b for a, b in zip(loss, loss[1:]))
    assert all((t["feature"] < 0).sum() <= 5 for t in model.trees)
    assert np.isclose(sum(model.featureImportances), 1) and model.featureImportances[3] == 0
    scored = model.add_score(df, "x", "p")
    assert {r.row: r.p for r in scored.collect()} == pytest.approx({r[0]: 1 / (1 + np.exp(-m)) for r, m in zip(rows, margins(model, rows)[-1])})


def test_models_grown_together_equal_those_grown_alone(spark):
    df, rows = table(spark, 240, 11)
    part = F.col("row") % 3
    models = F.concat(F.array(F.lit(9)), F.when(part != 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array()))
    got = boost.fit_many(df.withColumn("models", models), {9: DEPTHS, 1: DEPTHS, 2: LEAVES})
    alone = {9: boost.fit(df, DEPTHS), 1: boost.fit(df.where(part != 0), DEPTHS), 2: boost.fit(df.where(part != 0), LEAVES)}
    for m, model in alone.items():
        assert np.allclose(margins(got[m], rows)[-1], margins(model, rows)[-1])


def test_edge_cases(spark, tmp_path):
    df, rows = table(spark, 60, 13)
    empty = boost.fit(df.limit(0), DEPTHS)
    assert {r.p for r in empty.add_score(df, "x", "p").collect()} == {0.5} and empty.trees == []
    single = boost.fit(df.where("y = 1"), DEPTHS)
    assert all(len(t["feature"]) == 1 for t in single.trees) and single.base > 13
    flat = boost.fit(df.withColumn("x", F.array(F.lit(2.0))), LEAVES)
    assert all(len(t["feature"]) == 1 for t in flat.trees)
    with pytest.raises(ValueError):
        Settings()
    model = boost.fit(df, LEAVES)
    model.save(str(tmp_path / "m"))
    again = boost.BoostedModel.load(spark, str(tmp_path / "m"))
    assert again.settings == LEAVES and np.array_equal(margins(again, rows)[-1], margins(model, rows)[-1])


def test_middling_tables_grow_in_a_task(spark, monkeypatch):
    assert Settings(depth=2).rows_in_task(5) == 800_000 and Settings(depth=2).rows_in_task(1000) == boost.LEAST_BOUND
    assert Settings(depth=2, bound=7).rows_in_task(5) == 7
    monkeypatch.setattr(boost, "boost_table", lambda *a: pytest.fail("a job for each level"))
    n = 120_000
    rows = spark.range(n).selectExpr("id AS row", "CAST(id % 7 < 3 AS double) AS y", "1.0D AS w", "array(CAST(id % 7 AS double)) AS x")
    model = boost.fit(rows, Settings(rounds=3, depth=2, rate=0.5))
    assert len(model.trees) == 3


def test_the_larger_side_is_not_counted(monkeypatch):
    """What is left of the node above is taken, so below the root at most half of the rows are counted."""
    r = np.random.default_rng(5)
    n, seen, histogram = 4000, [], boost.histogram
    codes = r.integers(0, 30, (n, 3)).astype(np.uint8)
    y = ((codes[:, 0] > 12) ^ (r.random(n) < 0.3)).astype(float)
    cuts = [np.arange(29) + 0.5] * 3
    monkeypatch.setattr(boost, "histogram", lambda c, f, place, *rest: seen.append(len(place)) or histogram(c, f, place, *rest))
    for s in (boost.Settings(rounds=3, depth=4), boost.Settings(rounds=3, leaves=9, row_share=0.7)):
        seen.clear()
        trees = list(boost.boost_rows(s, cuts, np.arange(n), y, np.ones(n), codes, 0.0))
        roots = [k for k in seen if k > n / 2]
        assert len(roots) == 3 and len(seen) > 6 and all(2 * k <= max(roots) for k in seen if k <= n / 2)
        # the margins of the last round are those of the trees, for drawn and other rows
        margin = sum(t["value"][boost.walk(t, codes.astype(float))] for t in trees)
        assert np.abs(margin).max() > 0 and ((margin > 0) == (y == 1)).mean() > 0.6


def test_large_tables_grow_in_a_task_and_rows_keep_their_leaves(spark, monkeypatch):
    assert boost.held_rows(5) > 5_000_000  # 4,800,000 rows took a Spark job for each level of each tree
    monkeypatch.setattr(boost, "boost_table", lambda *a: pytest.fail("a job for each level"))
    monkeypatch.setattr(boost, "CELLS", 10)
    monkeypatch.setattr(boost, "LEAST_BOUND", 10)
    df, rows = table(spark, 300, 17)
    model = boost.fit(df, DRAWN)
    used = np.array([m[-1] for m in zip(*margins(model, rows))])
    assert len(model.trees) == DRAWN.rounds and ((used > 0) == [r[1] for r in rows]).mean() > 0.7
    # rows pass from node to node without walking from the root
    monkeypatch.setattr(boost, "walk", lambda *a: pytest.fail("walked"))
    codes = np.array([r[3] for r in rows]).astype(np.uint8)
    y = np.array([r[1] for r in rows])
    again = list(boost.boost_rows(DRAWN, [np.arange(19) + 0.5] * 4, np.array([r[0] for r in rows]), y, np.ones(300), codes, 0.0))
    assert len(again) == DRAWN.rounds


def test_codes_are_read_from_the_buffers():
    import pyarrow as pa

    rows = [b"\x01\x02", b"\x03\x04", b"\x05\x06"]
    whole = pa.chunked_array([pa.array(rows).slice(1), pa.array(rows, pa.large_binary()).cast(pa.binary())])
    assert boost.unpack(whole, 5).tolist() == [[3, 4], [5, 6], [1, 2], [3, 4], [5, 6]]
    assert boost.unpack(pa.array([b"", b""]), 2).shape == (2, 0) and boost.unpack(pa.array([], pa.binary()), 0).shape == (0, 0)
