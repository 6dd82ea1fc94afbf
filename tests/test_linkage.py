"""Linkage of all target versions and flags from one cube."""
from cohortloom import fixtures as fx
from cohortloom.functions.numeric import col
from cohortloom.operators import joins, screen
from cohortloom.plans import flags, target
from cohortloom.queries import QUERIES, screening
from cohortloom.queries.profiles import rounded
from cohortloom.sources.tables import KEY


def test_all_versions_and_flags_are_linked(spark, sf):
    got = {(r.version, r.post_variable, r.feature): r for r in QUERIES["pre_post_linkage_all"](spark, sf).collect()}
    assert {v for v, _, _ in got} == set(target.TARGETS)
    assert {p for _, p, _ in got} <= {*flags.ALL_FLAGS, "target"} and len({p for _, p, _ in got}) > 4
    assert {(r.version, r.post_variable, r.feature): r for r in QUERIES["pre_post_linkage"](spark, sf).collect()} == got
    # one frame a version gives the same rows
    outcomes = ["flag_liquidos", "flag_estancia", "flag_desenlace", "target"]
    pre = fx.preop(spark, sf).where("Edad >= 18").select(col(KEY), *[col(f) for f in screening.PRE_FEATS])
    frames = {
        v: pre.join(joins.short_key(target.extract_target(fx.posop(spark, sf), v)).select(col(KEY), *outcomes), KEY)
        for v in ("target_f_predictibilidad_maxima", "target_d_v5")
    }
    found = rounded(screen.pre_post_linkage(frames, screening.PRE_FEATS, outcomes), "mi", "abs_pearson", "combined", "prevalence").collect()
    assert len(found) > 20
    for r in found:
        assert got[r.version, r.post_variable, r.feature] == r


def test_rows_of_a_feature_are_not_brought_together(spark):
    """The edges go to the rows, however large Spark takes them to be."""
    long = spark.range(200).selectExpr("'f' || id % 2 AS feature", "CAST(id % 50 AS DOUBLE) AS value", "CAST(id % 3 = 0 AS BIGINT) AS y")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = screen.contingency(long, ["y"], 4)
        plan = table._jdf.queryExecution().sparkPlan().toString()
        got = sorted(tuple(r) for r in table.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [feature" in plan
    assert sum(n for _, _, n, _, _ in got) == 200 and sum(p for *_, p in got) == 67
    assert got == sorted(tuple(r) for r in screen.contingency(long, ["y"], 4).collect())
