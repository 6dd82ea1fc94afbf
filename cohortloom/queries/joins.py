"""Joins, cached lookups and set operations."""
from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom import fixtures as fx
from cohortloom.functions.numeric import col, round_half_up as r6
from cohortloom.operators import joins, lookup, setops
from cohortloom.plans import flags, target
from cohortloom.queries.base import query, r
from cohortloom.queries.projections import scratch
from cohortloom.queries.targets import VERSION_SQL
from cohortloom.sources.tables import KEY, KEY_ALIAS, write_parquet


@query(
    "join_pre_target",
    'SELECT p.k, p."Documento PMD" AS doc, t.target FROM preop_v p JOIN tf_v t ON p."Documento PMD" = t.doc',
    needs=("preop_v", "tf_v"),
)
def join_pre_target(spark, sf):
    tgt = target.extract_target(fx.posop(spark, sf), "target_f_predictibilidad_maxima")
    pre = fx.preop(spark, sf).select("k", col(KEY))
    return joins.merge_preop_target(pre, tgt).select("k", col(KEY).alias("doc"), "target")


@query(
    "join_versions_summary",
    f"""SELECT version, count(*) AS n, sum(target)::BIGINT AS n_pos, {r('avg(target)')} AS prevalence
FROM preop_v p JOIN versions_v v ON p."Documento PMD" = v.doc GROUP BY version""",
    needs=("preop_v", "versions_v"),
)
def join_versions_summary(spark, sf):
    """One join of the keys; the versions stay columns until they are summed."""
    wide = joins.short_key(target.target_wide(fx.posop(spark, sf), KEY_ALIAS))
    merged = fx.preop(spark, sf).select(col(KEY)).join(wide, KEY)
    return target.version_counts(merged, list(VERSION_SQL)).withColumn("prevalence", r6("prevalence"))


@query(
    "join_flags_profile",
    """SELECT p.k, p."Edad", p."Edad" * 0 AS flag_estancia, f.flag_estancia AS flag_estancia_pos, f.flag_liquidos
FROM preop_v p JOIN flags_v f ON p."Documento PMD" = f.doc""",
    needs=("preop_v", "flags_v"),
)
def join_flags_profile(spark, sf):
    pre = fx.preop(spark, sf).select("k", col(KEY), "Edad", (F.col("Edad") * 0).alias("flag_estancia"))
    wanted = ["flag_estancia", "flag_liquidos"]
    f = flags.flags_all(fx.posop(spark, sf), families=wanted)
    return joins.join_flags_profile(pre, f, wanted).drop(KEY)


@query(
    "join_first_by_hash",
    """
WITH res AS (SELECT md5(text) AS h, min(doc_id) AS first_id FROM documents GROUP BY md5(text))
SELECT d.doc_id, s.source AS source_dx, s.n_chars AS n_chars_dx
FROM documents d LEFT JOIN res ON md5(CASE WHEN d.doc_id % 3 <> 0 THEN d.text END) = res.h
LEFT JOIN documents s ON s.doc_id = res.first_id""",
)
def join_first_by_hash(spark, sf):
    docs = fx.table(spark, sf, "documents")
    results = docs.select(F.md5("text").alias("text_hash"), "doc_id", "source", "n_chars")
    rows = docs.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("t"))
    return joins.first_by_hash(rows, results, "t", "doc_id", "doc_id", "_dx").drop("t")


MED_CODES = "VALUES ('losartán', 'C09CA01', 'losartan'), ('aspirina', 'N02BA01', 'aspirin'), ('la metformina', 'A10BA02', 'metformin')"


@query(
    "lookup_with_cache",
    f"""
SELECT k, coalesce(CASE WHEN lower(trim(m)) = 'aspirina' THEN 'B01AC06' END, c.atc) AS atc,
       CASE WHEN lower(trim(m)) = 'aspirina' THEN 'aspirin low dose' ELSE c.name END AS name
FROM (SELECT k, "Nombre del medicamento" AS m FROM preop_v) LEFT JOIN ({MED_CODES}) AS c(key, atc, name) ON lower(trim(m)) = c.key""",
    needs=("preop_v",),
)
def lookup_with_cache(spark, sf):
    """The cache already knows one drug; the table resolver answers the other distinct names."""
    codes = spark.sql(f"SELECT * FROM ({MED_CODES}) AS c(key, atc, name)")
    cache = spark.sql("SELECT 'aspirina' AS key, 'B01AC06' AS atc, 'aspirin low dose' AS name")
    rows = fx.preop(spark, sf).select("k", "Nombre del medicamento")
    columns = ["atc", "name"]
    _, grown = lookup.lookup_with_cache(rows, "Nombre del medicamento", "k", cache, lookup.table_resolver(codes, "key", columns), columns)
    stored = spark.read.parquet(write_parquet(grown, scratch(spark, "drug-cache")))
    # the second run finds every key in the stored cache and asks a resolver that knows nothing
    out, _ = lookup.lookup_with_cache(rows, "Nombre del medicamento", "k", stored, lookup.table_resolver(codes.limit(0), "key", columns), columns)
    return out.select("k", "atc", "name")


# names of the part table act as the code book; every third part name is asked with an extra word
@query(
    "code_lookup_token_subsets",
    """
WITH q AS (SELECT DISTINCT p_name || CASE WHEN p_partkey % 3 = 0 THEN ' zzz' ELSE '' END AS q FROM part),
cand AS (SELECT q, toks, i, CASE WHEN i = 0 THEN toks ELSE list_filter(toks, lambda t, j: j <> len(toks) + 1 - i) END AS c
         FROM (SELECT q, string_split(q, ' ') AS toks FROM q), (SELECT unnest(range(0, 3)) AS i) WHERE len(string_split(q, ' ')) = 2
         UNION ALL SELECT q, toks, i, CASE WHEN i = 0 THEN toks WHEN i <= 3 THEN list_filter(toks, lambda t, j: j <> 4 - i) ELSE [toks[1]] END
         FROM (SELECT q, string_split(q, ' ') AS toks FROM q), (SELECT unnest(range(0, 5)) AS i) WHERE len(string_split(q, ' ')) = 3),
cand2 AS (SELECT q, i, CASE WHEN len(toks) = 2 AND i > 0 THEN [toks[i]] ELSE c END AS c FROM cand),
codes AS (SELECT DISTINCT p_brand || '-' || p_type AS code, p_name AS term FROM part),
hit AS (SELECT q, i, code, term FROM cand2 JOIN codes ON list_has_all(string_split(term, ' '), c))
SELECT q, (arg_min(code, (i, code, term))) AS code, arg_min(term, (i, code, term)) AS term, min(i)::INTEGER AS attempt FROM hit GROUP BY q""",
)
def code_lookup_token_subsets(spark, sf):
    part = fx.table(spark, sf, "part")
    codes = part.select(F.concat_ws("-", "p_brand", "p_type").alias("code"), F.col("p_name").alias("term")).distinct()
    extra = F.when(F.col("p_partkey") % 3 == 0, F.lit(" zzz")).otherwise(F.lit(""))
    return lookup.code_by_token_subsets(part.select(F.concat("p_name", extra).alias("q")), "q", codes)


@query(
    "join_outer_scores",
    f"""
SELECT coalesce(a.feature, b.feature) AS feature, {r('coalesce(a.mi, 0)')} AS mi, {r('coalesce(b.rf, 0)')} AS rf
FROM (SELECT group_type || '_' || severity AS feature, avg(y_true) AS mi FROM scored_v WHERE severity < 4 GROUP BY 1) a
FULL JOIN (SELECT group_type || '_' || severity AS feature, avg(y_proba) AS rf FROM scored_v WHERE severity > 1 GROUP BY 1) b
ON a.feature = b.feature""",
    needs=("scored_v",),
)
def join_outer_scores(spark, sf):
    df = fx.scored(spark, sf).withColumn("feature", F.concat_ws("_", "group_type", "severity"))
    mi = df.where("severity < 4").groupBy("feature").agg(F.avg("y_true").alias("mi"))
    rf = df.where("severity > 1").groupBy("feature").agg(F.avg("y_proba").alias("rf"))
    return joins.outer_scores(mi, rf, "feature").select("feature", r6("mi").alias("mi"), r6("rf").alias("rf"))


@query(
    "join_left_ranking",
    f"""
SELECT b.version, {r('b.f2')} AS f2, {r('c.cv')} AS cv, {r('coalesce(s.stab, 0)')} AS stab, 0.5::DOUBLE AS calibration
FROM (SELECT version, avg(y_true) AS f2 FROM scored_v GROUP BY version) b
LEFT JOIN (SELECT version, avg(y_proba) AS cv FROM scored_v GROUP BY version) c ON b.version = c.version
LEFT JOIN (SELECT version, avg(feat_b) / 100 AS stab FROM scored_v WHERE version <> 'v2' GROUP BY version) s ON b.version = s.version""",
    needs=("scored_v",),
)
def join_left_ranking(spark, sf):
    df = fx.scored(spark, sf)
    base = df.groupBy("version").agg(F.avg("y_true").alias("f2"))
    cv = df.groupBy("version").agg(F.avg("y_proba").alias("cv"))
    stab = df.where("version <> 'v2'").groupBy("version").agg((F.avg("feat_b") / 100).alias("stab"))
    cal = df.where("version = 'none'").groupBy("version").agg(F.avg("feat_b").alias("calibration"))
    out = joins.left_chain(base, [(cv, {"cv": 0.0}), (stab, {"stab": 0.0}), (cal, {"calibration": 0.5})], "version")
    return out.select("version", *[r6(c).alias(c) for c in ("f2", "cv", "stab", "calibration")])


@query(
    "join_baseline_vs_tuned",
    f"""
SELECT b.version, {r('b.m')} AS m_baseline, {r('t.m')} AS m_tuned, {r('t.m - b.m')} AS delta_m
FROM (SELECT version, max(m) AS m FROM (SELECT version, model, avg(y_proba) AS m FROM scored_v WHERE model IN ('m0', 'm1') GROUP BY version, model) GROUP BY version) b
LEFT JOIN (SELECT version, max(m) AS m FROM (SELECT version, model, avg(y_proba) AS m FROM scored_v WHERE model IN ('m2', 'm3') AND version <> 'v0' GROUP BY version, model) GROUP BY version) t
ON b.version = t.version""",
    needs=("scored_v",),
)
def join_baseline_vs_tuned(spark, sf):
    per_model = fx.scored(spark, sf).groupBy("version", "model").agg(F.avg("y_proba").alias("m"))
    base = per_model.where("model IN ('m0', 'm1')").groupBy("version").agg(F.max("m").alias("m"))
    tuned = per_model.where("model IN ('m2', 'm3') AND version <> 'v0'").groupBy("version").agg(F.max("m").alias("m"))
    out = joins.baseline_vs_tuned(base, tuned, ["m"])
    return out.select("version", *[r6(c).alias(c) for c in ("m_baseline", "m_tuned", "delta_m")])


LABEL_CASE = """CASE WHEN regexp_matches(lower(t), '\\bparo\\b|choque|sepsis') THEN 'critical'
 WHEN regexp_matches(lower(t), 'fractura|laparotom|ruptura') THEN 'high severity'
 WHEN regexp_matches(lower(t), 'hernia|herniorrafia') THEN 'moderate severity'
 WHEN regexp_matches(lower(t), 'catarata|faco') THEN 'low severity' ELSE 'medium severity' END"""


@query(
    "severity_batch_label",
    f"""
SELECT text_hash, text, model, predicted_label, 0.6::DOUBLE AS predicted_score, 'x' AS status FROM (
SELECT md5(t) AS text_hash, t AS text, 'keywords' AS model, CASE WHEN t = 'xyz' THEN 'critical' ELSE {LABEL_CASE} END AS predicted_label
FROM (SELECT DISTINCT "Dx Preoperatorio" AS t FROM preop_v WHERE "Dx Preoperatorio" IS NOT NULL
      UNION SELECT DISTINCT "Procedimiento propuesto" FROM preop_v WHERE "Procedimiento propuesto" IS NOT NULL))""",
    needs=("preop_v",),
)
def severity_batch_label(spark, sf):
    """Diagnosis and procedure texts; one pair is in the cache and keeps its cached label."""
    df = fx.preop(spark, sf)
    texts = df.select(col("Dx Preoperatorio").alias("t")).union(df.select(col("Procedimiento propuesto")))
    cache = spark.sql(
        "SELECT 'xyz' AS text, 'keywords' AS model, 'critical' AS predicted_label, 0.6D AS predicted_score, "
        "array('critical') AS all_labels, array(0.6D) AS all_scores, md5('xyz') AS text_hash"
    )
    out = lookup.label_texts(texts, "t", cache, lookup.keyword_labeller())
    return out.select("text_hash", "text", "model", "predicted_label", "predicted_score", F.lit("x").alias("status"))


# ---- set operations -----------------------------------------------------------------------
@query(
    "union_blocks",
    """SELECT version, model, n, NULL::BIGINT AS n_pos FROM (SELECT version, model, count(*) AS n FROM scored_v GROUP BY version, model)
UNION ALL SELECT version, NULL, NULL, sum(y_true)::BIGINT FROM scored_v GROUP BY version""",
    needs=("scored_v",),
)
def union_blocks(spark, sf):
    df = fx.scored(spark, sf)
    return setops.union_blocks(
        [
            df.groupBy("version", "model").agg(F.count(F.lit(1)).alias("n")),
            df.groupBy("version").agg(F.sum("y_true").alias("n_pos")),
        ]
    )


@query(
    "upsert_keep_last",
    """
SELECT user_id, arg_max(event_id, (event_id % 2, event_id)) AS event_id, arg_max(event_type, (event_id % 2, event_id)) AS event_type
FROM events GROUP BY user_id""",
)
def upsert_keep_last(spark, sf):
    ev = fx.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return setops.upsert_keep_last(ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1"), ["user_id"], "event_id")


@query(
    "set_intersect_except",
    """
SELECT coalesce(a.g, b.g) AS g, CASE WHEN a.g IS NULL THEN 'only_right' WHEN b.g IS NULL THEN 'only_left' ELSE 'common' END AS side
FROM (SELECT DISTINCT group_type || version AS g FROM scored_v WHERE severity < 2 OR version <> 'v0') a
FULL JOIN (SELECT DISTINCT group_type || version AS g FROM scored_v WHERE version <> 'v1') b ON a.g = b.g""",
    needs=("scored_v",),
)
def set_intersect_except(spark, sf):
    df = fx.scored(spark, sf).withColumn("g", F.concat("group_type", "version"))
    return setops.compare_sets(df.where("severity < 2 OR version <> 'v0'"), df.where("version <> 'v1'"), "g")
