"""The pipeline: each stage on its own input, and the rows of run() against a plain version."""
from collections import defaultdict

import numpy as np

import corpus_pipeline
from cohortloom.llm import language
from cohortloom.llm.common import remainder
from tests.llm.fixtures import awkward, frame, prose, row
from tests.llm.test_models_and_joins import plain_classes
from tests.llm.test_text_scans import plain_contamination
from tests.llm.test_tokens_files_packing import PLAIN


def documents():
    rows = [row(100 + i, prose(i, 50, "abcde" if i % 2 else "vwxyz"), "aa" if i % 2 else "zz") for i in range(40)]
    item = prose(777, 40, "abcde")
    rows += [row(200, rows[0][1] + " end", "zz"), row(201, rows[1][1].upper(), None), row(202, item + " " + prose(5, 30, "abcde"), "aa")]
    rows += [row(203, prose(6, 30, "abcde") + " password=abcdef12 " + prose(8, 30, "abcde"), "aa")]
    return rows + awkward(), [(1, item)]


def test_stages_and_run(spark, tmp_path):
    rows, items = documents()
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # plain version, stage by stage; the language model is the operator's own
    model = language.fit_language_model(docs.where(remainder("doc_id", 4) != 2))
    names, values, _ = language.label_texts([r[1] for r in rows], model, language.PENALTY)
    left = [r for r, n, v in zip(rows, names, values) if n != "und" and v >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    assert {r[0] for r in rows} - {r[0] for r in left} == {1, 2, 3, 4}
    classes, groups = plain_classes(left), defaultdict(list)
    for r in left:
        groups[classes[r[:2]]].append(r)
    left = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    hit = {r: plain_contamination(r[1], items) for r in left}
    left = [r for r in left if not hit[r][1] or 20 * hit[r][1] < hit[r][0]]
    texts = {r[0]: r[1].replace("password=abcdef12", "[secret]") for r in left}
    assert 202 not in texts and 200 not in texts and 201 not in texts and 6 not in texts
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4")))
    ids = {d: np.concatenate([x for _, x in sorted(p, key=lambda q: q[0])]).tolist() for d, p in got.items()}
    assert ids == {d: [*PLAIN["byte_bpe_50k.json"](t), 1] for d, t in texts.items()}


def test_stages_keep_columns_and_take_empty_tables(spark, sf):
    docs = frame(spark, awkward())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_clean_documents_stay(spark, sf):
    clean = [row(i, prose(9000 + i, 70), "en") for i in range(30)]
    docs = frame(spark, clean)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == [(r[0], r[1], r[4]) for r in clean]


def test_mixed_and_unlabelled_documents_stay(spark, sf):
    parts = ["abcde", "fghij", "klmno", "pqrst", "uvwxy"]
    learned = [row(i, prose(i, 60, parts[i % 5]), f"l{i % 5}") for i in range(60)]
    # equal parts of five languages, each sure by itself
    mixed = [row(900 + k, " ".join(prose(5000 + 10 * k + i, 30, parts[i]) for i in range(5)), None) for k in range(4)]
    kept = corpus_pipeline.language_id(spark, frame(spark, learned + mixed), sf)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in learned + mixed}
    unlabelled = [row(i, prose(i, 20), None) for i in range(5)] + [row(10, "123 ...", None), row(11, None, None), row(12, "", None)]
    kept = corpus_pipeline.language_id(spark, frame(spark, unlabelled), sf)
    assert {r.doc_id for r in kept.collect()} == set(range(5))


def test_registered():
    names = list(corpus_pipeline.REGISTERED)
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_language_decides_what_shares_a_window(spark, tmp_path):
    parts = {"l0": "abcde", "l1": "fghij", "l2": "klmno"}
    # wrong and missing labels on some rows that the model does not learn from
    rows = [row(i, prose(i, 80, parts[f"l{i % 3}"]), f"l{i % 3}") for i in range(120)]
    truth = {r[0]: r[2] for r in rows}
    unseen = spark.createDataFrame([(r[0],) for r in rows], "doc_id long").where(remainder("doc_id", 4) == 2).collect()
    odd = {r.doc_id for r in unseen}
    assert len(odd) > 10
    rows = [row(r[0], r[1], (None if r[0] % 2 else "l0") if r[0] in odd else r[2]) for r in rows]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(7777, 30, "xyz"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = corpus_pipeline.language_id(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id: r.lang for r in stage.collect()} == truth
    windows = defaultdict(set)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        windows[r.sequence_id].add(truth[r.doc_id])
    assert {len(v) for v in windows.values()} == {1} and set().union(*windows.values()) == set(parts)
