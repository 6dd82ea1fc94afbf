"""Dirty texts, flags and caches: values written out, not taken from the tables under test."""
import pytest
from pyspark.sql import functions as F

from cohortloom import session
from cohortloom.functions import numeric, text
from cohortloom.operators import encode, learn, lookup, profile
from cohortloom.plans import allergens, vocab
from cohortloom.sources import tables


def test_numbers_from_dirty_texts(spark):
    texts = ["nan", "NaN", "3d", "2f", "inf", "Infinity", "", " 3 ", "-1.5e2", ".5", "7.", "0x1", "1,5", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", numeric.to_number("t").alias("v")).orderBy("i").collect()]
    assert got == [None] * 7 + [3.0, -150.0, 0.5, 7.0, None, None, None]
    doubles = spark.createDataFrame([(float("nan"),), (1e300,), (2.0,), (None,)], "t double")
    assert sorted(r.v for r in doubles.select(numeric.to_number("t").alias("v")).collect() if r.v is not None) == [2.0, 1e300]


def test_folding_covers_all_code_points(spark):
    cases = {"⑩ 𝐀lergia ㎎ ½": "10 alergia mg 12", "ﬁn … ÑandÚ": "fin ... nandu", "日本 abc": "abc", "NaN": None, "ß x": "x"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.a for r in df.select("t", text.ascii_lower("t").alias("a")).collect()}
    assert got == cases


def test_many_flags_and_null_flags(spark):
    names = [f"f{i}" for i in range(70)]
    rows = [[(i + j) % 2 for j in range(70)] for i in range(6)]
    for r in rows:
        r[64] = r[0]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} int" for n in names))
    pair = profile.flag_cooccurrence(df, names).where("flag1 = 'f0' AND flag2 = 'f64'").first()
    assert pair.pct == 100.0
    holed = spark.createDataFrame([(1, None), (1, 1), (None, 1)], "a int, b int")
    got = {(r.flag1, r.flag2): r.pct for r in profile.flag_cooccurrence(holed, ["a", "b"]).collect()}
    assert got == {("a", "a"): 100.0, ("b", "b"): 100.0, ("a", "b"): 50.0, ("b", "a"): 50.0}


def test_allergen_classes_of_single_words(spark):
    want = {
        "tegaderm": "adhesivo", "peniclina": "penicilina", "meropenen": "carbapenem", "fluconzaol": "azole",
        "trmadol": "opioide", "gadobutrol": "contraste_gadolinio", "cafeina": "alimento_estimulante", "acaros": "ambiental",
        "qwerty": None,
    }
    df = spark.createDataFrame([(w,) for w in want], "token string")
    assert {r.token: r["class"] for r in allergens.token_classes(df).collect()} == want
    assert len(allergens.ALIASES) == 423 and len(vocab.ANAESTHESIA_WORDS) == 126
    assert (vocab.ANAESTHESIA_WORDS["conductivosedación"], vocab.ANAESTHESIA_WORDS["a"]) == ("conductiva sedacion", "")


def test_classes_have_no_cap(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("t"))
    assert len(encode.fit_vocabulary(df, onehot=["t"])["t"]) == 6000


def test_half_written_landing_is_written_again(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.lit("a"))
    (tmp_path / "preop_raw.parquet" / "_temporary").mkdir(parents=True)
    df.limit(2).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/part")
    for f in (tmp_path / "part").glob("part-*"):
        f.rename(tmp_path / "preop_raw.parquet" / f.name)
    pre, _ = tables.land_pair(spark, df, df, str(tmp_path))
    assert pre.count() == 5 and tables.landed(spark, f"{tmp_path}/preop_raw.parquet")
    again, _ = tables.land_pair(spark, df.limit(1), df, str(tmp_path))
    assert again.count() == 5


def test_landing_takes_a_schema(spark, tmp_path):
    (tmp_path / "pre.csv").write_text("Edad,Sexo,Extra\n34,F,x\nnada,M,y\n")
    pre, post = tables.land_pair(spark, f"{tmp_path}/pre.csv", f"{tmp_path}/pre.csv", str(tmp_path / "out"), (tables.RAW_SCHEMA, None))
    assert dict(pre.dtypes) == {"Edad": "double", "Sexo": "string", "Extra": "string"}
    assert [r.Edad for r in pre.orderBy("Extra").collect()] == [34.0, None] and dict(post.dtypes)["Edad"] == "string"


def test_lookup_asks_once_and_keeps_rows(spark):
    df = spark.createDataFrame([(1, "A "), (2, "a"), (3, "b"), (4, None), (5, "c")], "k int, t string")
    cache = spark.createDataFrame([("c", "old"), ("c", "old")], "key string, v string")
    asked = spark.sparkContext.accumulator(0)

    def answer(frame):
        asked.add(len(frame))
        return frame.assign(v=frame["key"].str.upper())

    out, grown = lookup.lookup_with_cache(df, "t", "k", cache, lookup.batch_resolver(answer, "key string, v string"), ["v"])
    assert {r.k: r.v for r in out.collect()} == {1: "A", 2: "A", 3: "B", 4: None, 5: "old"}
    assert out.count() == 5 and sorted(r.key for r in grown.collect()) == ["a", "b", "c"]
    assert asked.value == 2


def test_temporary_folder_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_cluster_failures_are_not_taken_for_calibration_failures(spark, monkeypatch):
    def lost(*a, **k):
        raise RuntimeError("executor lost")

    df = spark.createDataFrame([(i, i % 2, float(i % 7)) for i in range(60)], "row_key int, y_true int, x double")
    monkeypatch.setattr(learn, "calibrate", lost)
    with pytest.raises(RuntimeError):
        learn.fit_calibrated(df, learn.Spec("decision_tree", ("x",), params={"minInstancesPerNode": 1}), folds=2)
