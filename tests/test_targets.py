"""Targets from precomputed flags, hand-worked."""
import pytest

from cohortloom.plans import clean, target
from cohortloom.plans.flags import ALL_FLAGS
from cohortloom.operators import joins, project
from cohortloom.sources import tables


def frame(spark, rows):
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], names)


def test_threshold(spark):
    base = {f: 0 for f in ALL_FLAGS}
    df = frame(
        spark,
        [
            {"k": 1, **base, "flag_estancia": 1},
            {"k": 2, **base, "flag_estancia": 1, "flag_liquidos": 1},
            {"k": 3, **base, "flag_via_aerea": 1},
        ],
    )
    assert [r["target"] for r in target.target_threshold(df, threshold=1).orderBy("k").collect()] == [1, 1, 1]
    assert [r["target"] for r in target.target_threshold(df, threshold=2).orderBy("k").collect()] == [0, 1, 0]
    with pytest.raises(ValueError, match="not found"):
        target.target_threshold(df.drop("flag_estancia"), threshold=1)


def test_expression_and_override(spark):
    df = frame(
        spark,
        [
            {"k": 1, "a": 1, "b": 0, "canceladas": 0, "canceladas_por_medico": 0},
            {"k": 2, "a": 1, "b": 0, "canceladas": 1, "canceladas_por_medico": 0},
            {"k": 3, "a": 1, "b": 0, "canceladas": 1, "canceladas_por_medico": 1},
            {"k": 4, "a": 1, "b": 1, "canceladas": 0, "canceladas_por_medico": 0},
        ],
    )
    out = target.target_expression(df, "a AND NOT (b OR c)", {"c": "b"})
    assert [r["target"] for r in out.orderBy("k").collect()] == [1, 0, 1, 0]
    for bad in ("a; drop", "a OR missing", "__import__('os')"):
        with pytest.raises(ValueError):
            target.target_expression(df, bad)


def test_ages_over_110_are_drawn_again_and_over_120_nulled(spark):
    df = spark.createDataFrame([(1, 115.0), (2, 200.0), (3, 50.0), (4, None)], "k long, Edad double")
    out = project.range_random_impute(project.outlier_nullify(df, {"Edad": (0, 120)}), "k")
    ages = {r["k"]: r["Edad"] for r in out.collect()}
    assert ages[2] is None and ages[4] is None and ages[3] == 50.0
    assert 0 <= ages[1] <= 110 and ages[1] != 115.0


def test_age_filter_keeps_unknown(spark):
    df = spark.createDataFrame([(15.0,), (25.0,), (None,)], "Edad double")
    assert project.filter_min_age(df).count() == 2
    assert project.filter_min_age(df, keep_null=False).count() == 1


def test_merge_normalises_key_and_counts(spark):
    pre = spark.createDataFrame([(f"P{i:03d}", float(i)) for i in range(100)], ["Documento PMD", "Edad"])
    tgt = spark.createDataFrame([(f"P{i:03d}", i % 2) for i in range(80)], [tables.KEY_ALIAS, "target"])
    assert joins.merge_preop_target(pre, tgt).count() == 80
    assert joins.duplicate_keys(pre).count() == 0
    with pytest.raises(ValueError):
        joins.merge_preop_target(pre.drop("Documento PMD"), tgt)


def test_landing_is_reused(spark, tmp_path):
    raw = tmp_path / "pre.csv"
    raw.write_text("Documento PMD,Edad\nA,30\nB,\n", encoding="utf8")
    pos = spark.createDataFrame([("A", 1)], [tables.KEY_ALIAS, "target"])
    pre, post = tables.land_pair(spark, str(raw), pos, str(tmp_path / "out"))
    raw.write_text("Documento PMD,Edad\nA,30\n", encoding="utf8")
    again, _ = tables.land_pair(spark, str(raw), pos, str(tmp_path / "out"))
    assert pre.count() == again.count() == 2 and tables.KEY in post.columns
    assert [r["Edad"] for r in again.orderBy(tables.KEY).collect()] == ["30", None]


def test_metrics_files_by_name(spark, tmp_path):
    for t, m, f2 in (("b", "lr", 0.5), ("a", "rf", 0.4), ("a", "lr", 0.6)):
        (tmp_path / t).mkdir(exist_ok=True)
        (tmp_path / t / f"{m}_metrics.json").write_text(f'{{"F2": {f2},\n "Recall": 0.9}}')
    rows = tables.collect_metrics(spark, str(tmp_path)).collect()
    assert [(r["target"], r["model"], r["F2"]) for r in rows] == [("a", "lr", 0.6), ("a", "rf", 0.4), ("b", "lr", 0.5)]
    assert rows[0]["split"] == "validation" and rows[0]["ROC_AUC"] is None


def test_clean_with_given_vocabulary_keeps_columns(spark):
    df = spark.createDataFrame([(1, "hta, rara")], "k long, `Antecedentes cardiovasculares` string")
    for h in clean.HISTORY:
        if h not in df.columns:
            from pyspark.sql import functions as F

            df = df.withColumn(h, F.lit(None).cast("string"))
    vocabulary = {h: ["hta", "negativo"] for h in clean.HISTORY}
    out, _ = clean.run_stages(df, ["history"], vocabulary)
    row = out.first()
    assert row["Antecedentes cardiovasculares_hta"] == 1 and row["Antecedente renales_negativo"] == 1
    assert len(out.columns) == 1 + 2 * len(clean.HISTORY)
