"""Language, toxicity, neighbours and near duplicates against plain versions and held-out rows."""
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import language, near_duplicates, neighbours, toxicity
from cohortloom.llm.common import Words, remainder
from cohortloom.llm.queries import QUERIES
from tests.llm.fixtures import awkward, frame, prose, row, words


# ---- language -------------------------------------------------------------------------
def toy_model():
    english, german = "the of and is that with for this", "der die und ist das mit für ein"
    counts = np.zeros((2, language.TABLE))
    for k, text in enumerate((english, german)):
        runs = language.LetterRuns([text] * 50)
        for n in language.ORDERS:
            np.add.at(counts[k], runs.grams(n)[1], 1)
    scripts = np.zeros((2, language.N_SCRIPTS + 1))
    scripts[:, 1] = 100
    return language.Model(["de", "en"], counts[::-1], scripts)


def test_spans_of_mixed_text():
    model = toy_model()
    text = "the of and is that with for this " * 3 + "der die und ist das mit für ein " * 5
    names, values, spans = language.label_texts([text, None, "123 !!", "", "日本"], model, language.PENALTY)
    assert names == ["de", "und", "und", "und", "de"] or names == ["de", "und", "und", "und", "en"]
    assert [s["lang"] for s in spans[0]] == ["en", "de"] and abs(spans[0][1]["start"] - 99) <= 4
    assert 0.5 < values[0] < 0.7 and values[1:4] == [0, 0, 0]


@pytest.mark.parametrize("seed", range(6))
def test_best_paths_equal_enumeration(seed):
    r = np.random.default_rng(seed)
    sizes = [0, 1, 2, 5, 0, 7, 6]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = r.normal(0, 4, (first[-1], 3)).astype(np.float32)
    got = language.best_paths(scores, first, 3.0)

    def value(path, own):
        return sum(own[i, p] for i, p in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))

    for a, b in zip(first, first[1:]):
        own = scores[a:b].astype(float)
        if b > a:
            best = max(value(p, own) for p in itertools.product(range(3), repeat=b - a))
            assert math.isclose(value(got[a:b], own), best, abs_tol=1e-4)


def test_unlabelled_and_empty_tables(spark):
    docs = frame(spark, [row(1, "some words"), row(2, None)])
    model = language.fit_language_model(docs)
    assert {r.lang_pred for r in language.identify(docs, model).collect()} == {"und"}
    assert language.identify(frame(spark, []), toy_model()).count() == 0
    kept = language.keep_identified(frame(spark, awkward()), toy_model(), 0.0)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {5, 6, 7, None, 8, 9, 10}


def test_held_out_languages(spark, sf):
    got = QUERIES["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_labels_do_not_matter(spark, sf, tmp_path):
    """Predictions stay the same when the held-out labels are changed."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op10_language_id"](spark, sf).collect()}
    changed = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "source", "n_chars")
    changed.write.parquet(f"{tmp_path}/documents.parquet")
    after = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op10_language_id"](spark, str(tmp_path)).collect()}
    assert before == after


# ---- toxicity -------------------------------------------------------------------------
def plain_segments(scores):
    """All maximal segments by recursion on the best one."""
    if not any(s > 0 for s in scores):
        return []
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), key=lambda x: (x[0], x[1]))
    _, _, a, b = best
    left = [(x, y, s) for x, y, s in plain_segments(scores[:a])]
    right = [(x + b, y + b, s) for x, y, s in plain_segments(scores[b:])]
    return left + [(a, b, best[0])] + right


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments_equal_recursion(seed):
    r = random.Random(seed)
    scores = [r.uniform(-4, 5) for _ in range(r.randint(0, 14))]
    got = [(a, b, round(s, 9)) for a, b, s in toxicity.maximal_segments(scores)]
    assert got == [(a, b, round(s, 9)) for a, b, s in plain_segments(scores)]


def test_text_segments_skip_what_lies_between():
    r = random.Random(3)
    lengths = [0, 5, 12, 1, 0, 9]
    first = np.concatenate(([0], np.cumsum(lengths)))
    scores = np.array([r.choice([-0.5, -0.5, -0.5, 2.0, 1.0]) for _ in range(first[-1])])
    want = [(t, a + x, a + y, round(s, 9)) for t, (a, b) in enumerate(zip(first, first[1:])) for x, y, s in toxicity.maximal_segments(scores[a:b].tolist())]
    assert [(t, a, b, round(s, 9)) for t, a, b, s in toxicity.text_segments(scores, first)] == want


def labelled(n):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = prose(i, 40).split()
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(["zork", "zorkling", "quizzle"]))
        rows.append(row(i, " ".join(w)))
        labels.append((i, int(toxic), "x"))
    return rows, labels


def test_toxic_passages_and_edge_cases(spark):
    rows, labels = labelled(600)
    label_df = spark.createDataFrame(labels + [(0, None, "x"), (None, 1, "x"), (5, 0, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(frame(spark, rows[:500]), label_df)
    got = {r.doc_id: r for r in toxicity.score_documents(frame(spark, rows + awkward()[:4] + [row(None, "a zork zork b")]), model).collect()}
    for i in range(500, 600):
        assert (got[i].score >= 0.7) == (i % 5 == 0)
        assert bool(got[i].passages) == (i % 5 == 0)
    spans = got[500].passages
    assert any("zork" in rows[500][1][s.start : s.end] or "quizzle" in rows[500][1][s.start : s.end] for s in spans)
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = toxicity.fit(frame(spark, rows), label_df.limit(0))
    assert {r.score < 1e-9 for r in toxicity.score_documents(frame(spark, rows[:5]), nothing).collect()} == {True}
    assert toxicity.score_documents(frame(spark, []), model).count() == 0


# ---- neighbours -----------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int, v string, score int"


def plain_neighbours(rows, k, queries):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    common = max(((sum(len(v) == n for v in best.values()), n) for n in {len(v) for v in best.values()}))[1]
    best = {i: np.array(v, np.float32).astype(float) for i, v in best.items() if len(v) == common}
    out = {}
    for q in queries & set(best):
        found = sorted((-float(best[q] @ v), i) for i, v in best.items() if i != q)[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def test_neighbours_on_awkward_vectors(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=8) * r.uniform(0.5, 3)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [None] + [1.0] * 7), (204, [1.0, 2.0]), (None, rows[1][1]), (205, []), (0, rows[0][1]), (1, rows[2][1])]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)
    got = {}
    for x in neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20, target=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    want = plain_neighbours(rows, 20, {i for i, _ in rows if i is not None and i % 20 == 0})
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert len(found) == 20
        assert [i for i, _ in found] == [i for i, _ in want[q]]  # fitted to find all
        assert np.allclose([s for _, s in found], [s for _, s in want[q]], atol=1e-12)
    one = spark.createDataFrame([(0, [1.0, 0.0], 0, "x", 1), (3, [0.5, 0.5], 0, "x", 1)], VECTORS)
    assert [(x.query_id, x.rank, x.vec_id) for x in neighbours.nearest(one, one.where("vec_id = 0")).collect()] == [(0, 1, 3)]
    assert neighbours.nearest(one.limit(0), one).count() == 0


def test_recall_of_the_index(spark, monkeypatch):
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 16)) + 2 * r.normal(size=(12, 16))[r.integers(0, 12, 3000)]
    df = spark.createDataFrame([(i, v.tolist(), 0, "x", 1) for i, v in enumerate(x)], VECTORS)
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 700)
    plans = []
    monkeypatch.setattr(neighbours, "fit_plan", lambda *a, f=neighbours.fit_plan: plans.append(f(*a)) or plans[-1])
    got = {}
    for row_ in neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=10).collect():
        got.setdefault(row_.query_id, set()).add(row_.vec_id)
    x = x.astype(np.float32).astype(float)
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(found & set(np.argsort(-s, kind="stable")[:10].tolist()))
    assert len(got) == 150 and hit >= 0.9 * 1500
    assert plans[0].share < 0.9  # the index leaves rows out


def test_perturbation_sets_rise_and_are_valid():
    sets = neighbours.perturbation_sets(4, 500)
    assert len(sets) == len({tuple(s) for s in sets}) == 81  # each projection: down, stay or up
    assert sets[0].sum() == 0 and all(not (s[i] and s[7 - i]) for s in sets for i in range(4))


# ---- near duplicates ------------------------------------------------------------------
def plain_shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    texts = sorted({r[1] or "" for r in rows})
    sets = [plain_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and n >= 0.8 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    return {r: find(texts.index(r[1] or "")) for r in {x[:2] for x in rows}}


def near_rows():
    r = random.Random(6)
    rows = awkward()
    for g in range(12):
        base = prose(100 + g, 150).split()
        for c in range(8):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = prose(r.random(), 1)
            rows.append(row(1000 + 10 * g + c, " ".join(w)))
    shared = prose(500, 60)
    rows += [row(2000 + i, shared + " " + prose(600 + i, 80)) for i in range(40)]  # a common passage is no near copy
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_rows()
    want = plain_classes(rows)
    got = near_duplicates.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    groups, named = {}, {}
    for x in rows:
        groups.setdefault(want[x[:2]], []).append(x[0])
    for x in got:
        named.setdefault(x.class_id, []).append(x)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    assert {c: sorted(map(str, (x.doc_id for x in xs))) for c, xs in named.items()} == {least(g): sorted(map(str, g)) for g in groups.values()}
    assert all(sum(x.keep for x in xs) == 1 and all(x.class_size == len(xs) for x in xs) for xs in named.values())
    docs = frame(spark, rows)
    kept = near_duplicates.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(c) for c in named)
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0
    assert near_duplicates.drop_near_duplicates(frame(spark, [])).count() == 0


def by_class(rows, class_of):
    groups = {}
    for x in rows:
        groups.setdefault(class_of(x), []).append(x[0])
    return sorted(sorted(map(str, g)) for g in groups.values())


@pytest.mark.parametrize("n", [300, 900])
def test_dense_groups_cost_a_few_comparisons_a_text(spark, monkeypatch, n):
    """Variants of one text with three or four changed words: most pairs lie between 0.75 and 0.85."""
    r, base, compared = random.Random(n), prose(7, 300).split(), []
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(3, 4)):
            w[r.randrange(300)] = prose(r.random(), 1)
        rows.append(row(i, " ".join(w)))
    links = near_duplicates.Texts.links

    def counted(self, pairs):
        compared.append(pairs.count())
        return links(self, pairs)

    monkeypatch.setattr(near_duplicates.Texts, "links", counted)
    got = {x.doc_id: x.class_id for x in near_duplicates.near_duplicates(frame(spark, rows)).collect()}
    want = plain_classes(rows)
    assert by_class(rows, lambda x: got[x[0]]) == by_class(rows, lambda x: want[x[:2]])
    assert sum(compared) <= 6 * n


def test_a_passage_repeated_in_one_copy_links_by_the_sets(spark):
    rows = []
    for g in range(6):
        w = prose(40 + g, 104).split()
        rows += [row(5000 + 10 * g, " ".join(w)), row(5001 + 10 * g, " ".join(w[:34] * 100 + w[34:])), row(5002 + 10 * g, " ".join(w[34:] + w[:34] * 60))]
    rows += near_rows()[:40]
    got = {x.doc_id: x.class_id for x in near_duplicates.near_duplicates(frame(spark, rows)).collect()}
    want = plain_classes(rows)
    assert by_class(rows, lambda x: got[x[0]]) == by_class(rows, lambda x: want[x[:2]])


def test_signatures_estimate_probability_jaccard():
    r = np.random.default_rng(1)
    hashes = r.integers(0, 1 << 62, 400).astype(np.uint64)
    wx, wy = 1 + np.log(r.integers(1, 6, 300)), 1 + np.log(r.integers(1, 6, 300))
    text = np.repeat([0, 1], 300)
    marks = near_duplicates.signatures(2, text, np.concatenate((hashes[:300], hashes[100:])), np.concatenate((wx, wy)), size=4000)
    x, y = np.zeros(400), np.zeros(400)
    x[:300], y[100:] = wx, wy
    exact = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(400)) for i in range(100, 300))
    got = near_duplicates.probability_jaccard(wx[100:], wy[:200], (wx.sum(), wy.sum()))
    assert math.isclose(got, exact, rel_tol=1e-9)
    assert abs((marks[0] == marks[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / 4000)


def test_shingles_and_similarity_of_short_texts():
    texts = pa.array(["a b c", "A, b c!", "a b d", "", None, "!!"])
    text, _, times = near_duplicates.shingles(Words(texts))
    assert text.tolist() == [0, 1, 2] and times.tolist() == [1, 1, 1]
    assert near_duplicates.similarities(texts, texts.take(pa.array([1, 0, 0, 4, 3, 5]))).tolist() == [1, 1, 0, 0, 0, 0]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 100)], "a long, b long")
    got = {r.node: r.component for r in near_duplicates.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
