"""Registered queries of the corpus operators, with the digest columns of their results."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import collocations, decontamination, language, licenses, main_text, near_duplicates, neighbours, packing, periodic_runs, secret_scan, substring_dedup, token_files, toxicity
from cohortloom.llm.common import new_folder, remainder, ship
from cohortloom.llm.tokens import vocabulary

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_packing")
def op7_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    folder = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op4_license_scan")
def op4_license_scan(spark, sf_dir):
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.expr("to_json(expressions)").alias("expressions"),
    )


#: Words of a text for DuckDB.
WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op5_decontamination",
    f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS t FROM (
    SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
    FROM (SELECT *, least(13, len(w)) AS k FROM b WHERE len(w) > 0))),
h AS (SELECT doc_id, i, x.k, p.item_id FROM (
    SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS t FROM (
        SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)) x JOIN p ON p.k = x.k AND p.t = x.t),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
)
def op5_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def learned_language(docs: DataFrame):
    """The language model of the rows that may be learned from."""
    return language.fit_language_model(docs.where(remainder("doc_id", 4) != 2), key=F.col("doc_id"))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, learned_language(docs))
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        F.to_json("spans").alias("spans"),
    )


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1))
    found = toxicity.score_documents(docs, model)
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, secret_scan.BASE),
        F.sha2(secret_scan.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


@query("op9_substring_dedup")
def op9_substring_dedup(spark, sf_dir):
    found = substring_dedup.deduplicate(table(spark, sf_dir, "documents"), min_line_words=1)
    return found.select("doc_id", "text", "n_units", "removed_chars", F.to_json("removed").alias("removed"), F.to_json("kept").alias("kept"))


@query("op1_nearest_neighbours")
def op1_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op6_near_duplicates")
def op6_near_duplicates(spark, sf_dir):
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "keep")


def with_repetitions(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text, by the hash h of its id, ends in repetitions: its words
    from a = g % n on repeat with period 1 + (n - a) div (3 + g % 8), for g = h div 10 and n words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("words"))
    sized = cut.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = "transform(sequence(0L, n - 1L), i -> element_at(words, cast(if(i < a, i, a + (i - a) % p) as int) + 1))"
    return placed.select("doc_id", F.when(F.col("n") > 0, F.expr(f"array_join({repeated}, ' ')")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_repetitions(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic_runs.best_run(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query(
    "op12_collocations",
    r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (
        SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k))
    GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, phrase, a, j, array_to_string(p[1 : j], ' ') AS x, array_to_string(p[j + 1 : k], ' ') AS y
    FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.j, fx.f AS l, fy.f AS r, ((1000000::HUGEINT * cut.a * cut.a) // (fx.f::HUGEINT * fy.f))::BIGINT AS score
    FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = cut.x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = cut.y),
least_cut AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(p[1 : 2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(p[2 : 3], ' '), a FROM c WHERE k = 3) GROUP BY lang, phrase)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, n.n, s.score
FROM least_cut s JOIN n ON n.lang = s.lang LEFT JOIN longer ON longer.lang = s.lang AND longer.phrase = s.phrase
WHERE longer.a IS NULL OR 100 * longer.a < 50 * s.a
QUALIFY rank <= 2000""",
)
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op11_main_text")
def op11_main_text(spark, sf_dir):
    return main_text.main_text(table(spark, sf_dir, "pages"))
