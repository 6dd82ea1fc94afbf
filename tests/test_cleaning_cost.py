"""The cleaning reads numbers as numbers and splits lists in functions that Spark compiles."""
import math

from pyspark.sql import functions as F

from cohortloom.functions import text
from cohortloom.operators import project


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_are_not_read_as_text(spark):
    rows = [(1, 30.0, "7"), (2, math.inf, "x"), (3, math.nan, None), (4, None, " 8 "), (5, -0.0, "inf")]
    df = spark.createDataFrame(rows, "k bigint, Edad double, Temperatura string")
    out = project.numeric_coerce(df, ["Edad", "Temperatura"])
    assert [(r.Edad, r.Temperatura) for r in out.orderBy("k").collect()] == [(30.0, 7.0), (None, None), (None, None), (None, 8.0), (-0.0, None)]
    assert "RLIKE" not in plan(project.band_impute_body(project.range_random_impute(df.withColumns({c: F.lit(80.0) for c in ("Peso (Kg)", "Talla (cm)", "IMC")}).drop("Temperatura"), "k"), "k"))


def test_age_is_named_once(spark):
    df = spark.createDataFrame([(17.0,), (18.0,), (None,), (math.nan,)], "Edad double")
    kept = project.filter_min_age(df)
    assert [str(r.Edad) for r in kept.collect()] == ["18.0", "None", "nan"]
    assert plan(kept).count("Edad#") == 2  # the condition and the column itself


def test_terms_are_split_without_interpreted_functions(spark):
    df = spark.createDataFrame([(" a ,\tb c,, ",), ("",), (None,), (",",), ("x",)], "c string")
    out = df.select(text.split_terms("c").alias("t"))
    assert [r.t for r in out.collect()] == [["a", "b c"], [], None, [], ["x"]]
    assert "lambda" not in plan(out)
