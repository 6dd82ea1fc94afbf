"""Scalar functions against hand-computed values."""
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import codes, dates, labs, text
from cohortloom.functions.hashing import hash32
from cohortloom.operators import encode, lookup, rank


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("  Épilepsia   Ñandú ", "epilepsia nandu"), ("nan", None), (None, None), ("", ""),
        ("a - b", "a  b"), ("ﬁebre…", "fiebre"), ("1º grado", "o grado"), ("x y", "x y"),
    ],
)
def test_standardise(spark, raw, want):
    assert one(spark, raw, text.standardise) == want


def test_text_helpers(spark):
    assert one(spark, "negativo, hta,hta , fa", text.resolve_contradiction) == "fa,hta"
    assert one(spark, "negativo", text.resolve_contradiction) == "negativo"
    assert one(spark, "gral general ag", lambda c: text.replace_words(c, {"gral": "general", "general ag": "x"})) == "general x"
    assert one(spark, "la sal y el mar", lambda c: text.remove_stopwords(c, ["la", "y", "el"])) == "sal mar"
    assert one(spark, None, lambda c: text.remove_stopwords(c, ["la"])) == ""
    assert one(spark, " NaN ", text.null_normalise) is None
    assert one(spark, "general local", lambda c: text.keyword_labels(c, ["local", "general"], "no")) == "local, general"


@pytest.mark.parametrize(
    "fn, raw, want",
    [
        (labs.lab_float, "13,5", 13.5), (labs.lab_float, "<11.2 g", 11.2), (labs.lab_float, "x", None),
        (labs.lab_float, None, None), (labs.lab_float, ".5", 0.5), (labs.lab_pt_inr, "12.5/1.1", 1.1),
        (labs.lab_pt_inr, "1,05", 1.05), (labs.lab_pt_inr, "23", 2.0), (labs.lab_pt_inr, "0.1", None),
        (labs.lab_pt_inr, "5000 6000", None), (labs.lab_percent, "41%", 41.0), (labs.lab_percent, "140%", None),
        (labs.lab_count_thousands, "250.000", 250.0), (labs.lab_count_thousands, "180000", 180.0),
        (labs.lab_count_thousands, "9,8", 9.8), (labs.lab_count_thousands, "7,500", 7.5),
        (labs.lab_ratio_first, "30/28", 30.0),
    ],
)
def test_lab_parsers(spark, fn, raw, want):
    got = one(spark, raw, fn)
    assert got is None if want is None else got == pytest.approx(want)


def test_lab_state_and_fill(spark):
    assert one(spark, "UROCULTIVO", labs.lab_urine_state) == 1
    assert one(spark, None, labs.lab_urine_state) == 0
    df = spark.createDataFrame([("PTT", None), ("PTT", "30/28"), ("Otro", "1")], "e string, r string")
    filled = [r["Examen_PTT"] for r in labs.lab_wide(df, "e", "r").collect()]
    kept = [r["Examen_PTT"] for r in labs.lab_wide(df, "e", "r", fill=None).collect()]
    assert filled == [0.0, 30.0, 0.0] and kept == [None, 30.0, None]


@pytest.mark.parametrize("raw, want", [("07:30", 7.5), ("7:30 PM", 19.5), ("sin hora", None), ("23:15:10", 23.25), ("24:00", None)])
def test_hours(spark, raw, want):
    assert one(spark, raw, dates.hour_decimal) == want


def test_codes(spark):
    assert [one(spark, v, codes.nyha_ordinal) for v in ("I", "II", "III", "IV", None, "V")] == [0, 1, 2, 3, None, None]
    assert one(spark, None, codes.nutrition_from_bmi, "double") == 0
    assert one(spark, "NO ENCONTRADO", codes.code_chapter) == "NO ENCONTRADO"
    assert [one(spark, float(v), rank.fixed_bins, "double") for v in (18, 40, 41, 120, 121)] == ["18-40", "18-40", "40-60", "75-120", None]


def test_hash_is_the_documented_one(spark):
    df = spark.createDataFrame([(42,)], "k long").select(hash32("k", "x", 7).alias("h"))
    import hashlib

    assert df.first()["h"] == int(hashlib.md5(b"42|x|7").hexdigest()[:8], 16)


def test_token_subsets_follow_combination_order(spark):
    import itertools

    for n in range(1, 7):
        tokens = [f"t{i}" for i in range(n)]
        want = []
        for k in range(n, 0, -1):
            want += [list(c) for c in sorted(itertools.combinations(tokens, k), key=lambda c: tokens.index(c[0]))]
        df = spark.createDataFrame([(tokens,)], "t array<string>").select(lookup.token_subsets(F.col("t")).alias("x"))
        assert df.first()["x"] == want[:5]


def test_ordinal_is_strict(spark):
    df = spark.createDataFrame([("M",), (None,)], "s string")
    got = [r["s_encoded"] for r in encode.encode_ordinal(df, {"s": ["M", "F"]}).collect()]
    assert got == [0.0, None]
    bad = spark.createDataFrame([("Z",)], "s string")
    with pytest.raises(Exception, match="unknown class"):
        encode.encode_ordinal(bad, {"s": ["M", "F"]}).collect()
    assert encode.encode_ordinal(bad, {"s": ["M", "F"]}, strict=False).first()["s_encoded"] is None


def test_vocabulary_refuses_free_text(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(ValueError, match="too many classes"):
        encode.fit_vocabulary(df, onehot=["t"], max_classes=20)


def test_fold_ascii_equals_a_plain_version(spark):
    from cohortloom.functions import text

    multi, (src, dst) = text.ascii_fold_multi(), text.ascii_fold_map()
    single = {ord(a): b for a, b in zip(src, dst)} | {ord(a): None for a in src[len(dst) :]}

    def plain(t):
        if t is None:
            return None
        for ch, form in multi.items():
            t = t.replace(ch, form)
        return "".join(c for c in t.translate(single) if c.isascii())

    signs = list(multi)
    texts = [f"a {''.join(signs[i : i + 7])} é {signs[i]}" for i in range(0, len(signs), 5)] + ["ñandú", "", "plain", None, "½ﬁ😀"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.fold_ascii("t").alias("folded")).collect()
    assert [r.folded for r in got] == [plain(r.t) for r in got]
