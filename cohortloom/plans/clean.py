"""Cleaning stages of the preop table.

A stage names the text normalisation of its columns and how they are encoded. Stages
run alone or all together: the normalised columns of every stage form one projection,
one fit pass collects all vocabularies, and one projection encodes them.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes, dates, labs, text
from cohortloom.functions.numeric import col
from cohortloom.operators import encode, lookup, project
from cohortloom.operators.encode import Vocabulary, fit_vocabulary, onehot_columns, ordinal
from cohortloom.operators.joins import first_by_hash, left_lookup
from cohortloom.plans import allergens, vocab
from cohortloom.session import cut_lineage

# Accepted variants of the strict categorical fields.
STRICT_VALUES = {
    "Sexo": {
        "masculino": "M", "male": "M", "hombre": "M", "m": "M",
        "femenino": "F", "female": "F", "mujer": "F", "f": "F",
    },
    "Atención": {
        "urgencia": "Urgencia", "urgente": "Urgencia", "urgency": "Urgencia", "electivo": "Electivo",
        "elective": "Electivo", "programado": "Electivo", "urgencia programada": "Urgencia Programada",
    },
    "Cuello Móvil": {
        "normal": "Normal", "si": "Normal", "sí": "Normal", "yes": "Normal", "reducido": "Reducido",
        "fijo": "Fijo", "no": "Fijo",
    },
    "Apertura Oral": {
        "> 3 cm": "> 3 cm", "normal": "> 3 cm", "si": "> 3 cm", "sí": "> 3 cm", "< 3 cm": "< 3 cm",
        "no": "< 3 cm", "disminuida": "< 3 cm", "limitada": "< 3 cm",
    },
    "Arritmia": {
        "si": "Si", "sí": "Si", "yes": "Si", "1": "Si", "true": "Si", "no": "No", "0": "No", "false": "No",
    },
}
# Class lists of the ordinal fields.
ORDINAL = {
    "Sexo": ["M", "F"],
    "Atención": ["Electivo", "Urgencia", "Urgencia Programada"],
    "Cuello Móvil": ["Normal", "Reducido", "Fijo"],
    "Apertura Oral": ["> 3 cm", "< 3 cm"],
    "Apertura Visual": ["sin dato", "espontanea", "a la voz", "al dolor", "ninguna"],
    "Respuesta Verbal": [
        "sin dato", "conversacion orientada", "conversacion confusa", "palabras inapropiadas",
        "ruidos incomprensibles", "ninguna",
    ],
    "Respuesta Motora": [
        "sin dato", "obedece ordenes", "localiza el dolor", "retira al dolor", "flexiona al dolor", "flacido",
    ],
    "Arritmia": ["No", "Si"],
    "Disnea": ["no", "si"],
    "Angina": ["no", "si"],
}
HISTORY = [
    "Antecedente neurológicos", "Antecedente respiratorios", "Antecedentes cardiovasculares",
    "Antecedente hematológicos ", "Antecedente endocrinológicos", "Antecedente renales",
    "Antecedente gastrointestinales",
]
SYSTOLIC, DIASTOLIC, MEAN = (
    "Tensión Arterial Sistólica (mm/Hg)", "Tensión Arterial Diastólica (mm/Hg)", "Tensión Arterial Media (mm/Hg)",
)
VITALS = [
    "Edad", "Peso (Kg)", "Talla (cm)", "IMC", SYSTOLIC, DIASTOLIC, MEAN, "Frecuencia Respiratoria", "Temperatura",
]
SEVERITY_CLASSES = ["NONE", *lookup.SEVERITY_LABELS]


@dataclass(frozen=True)
class Stage:
    """trigger: run only if this column is there; normalise: rewritten or new columns."""

    trigger: str
    normalise: Callable[[], dict[str, Column]] = dict
    ordinal: tuple[str, ...] = ()
    onehot: tuple[str, ...] = ()
    multilabel: tuple[str, ...] = ()
    derive: Callable[[], dict[str, Column]] = dict
    drop: tuple[str, ...] = ()
    canonical: tuple[str, ...] = field(default=())


def _or(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def _std(name: str) -> Column:
    return text.standardise(name)


def _loose(name: str) -> Column:
    """Standardised, but signs stay (comma lists keep their commas)."""
    return text.standardise(name, letters_only=False)


def _no_semicolon(c: Column, by: str = "") -> Column:
    return F.replace(c, F.lit(";"), F.lit(by))


def _history(name: str) -> Column:
    filled = F.coalesce(col(name), F.lit("negativo"))
    return text.resolve_contradiction(_or(text.standardise(filled, keep=","), "negativo"))


def _systems() -> dict[str, Column]:
    breathing = _no_semicolon(_or(_loose("Sistema Respiratorio"), "normal"))
    return {
        "Sistema Respiratorio": breathing,
        "Disnea": F.when(breathing.contains("disnea"), F.lit("x")).otherwise(breathing),
        "Sistema cardiovascular": _no_semicolon(_or(_loose("Sistema cardiovascular"), "normal")),
        "Abdomen": _or(_loose("Abdomen"), "normal"),
    }


def _marked(name: str) -> Column:
    """'si' when the standardised text is just an x."""
    return F.when(_std(name) == "x", F.lit("si")).otherwise(F.lit("no"))


def _conditions() -> dict[str, Column]:
    return {
        "Disnea": _marked("Disnea"),
        "Angina": _marked("Angina"),
        "Condición": _no_semicolon(_or(_loose("Condición"), "ninguna"), ","),
    }


STAGES: dict[str, Stage] = {
    "demographics": Stage(
        "Sexo", ordinal=("Sexo", "Atención"), drop=("Sexo", "Atención"), canonical=("Sexo", "Atención"),
    ),
    "blood_nyha": Stage(
        "Grupo Sanguíneo", onehot=("Grupo Sanguíneo", "RH"),
        derive=lambda: {"NYHA_num": codes.nyha_ordinal("Clase Funcional (NYHA) ")},
        drop=("Grupo Sanguíneo", "RH", "Clase Funcional (NYHA) "),
    ),
    "history": Stage(
        HISTORY[0], lambda: {h: _history(h) for h in HISTORY}, multilabel=tuple(HISTORY), drop=tuple(HISTORY)
    ),
    "airway": Stage(
        "Cuello Móvil", lambda: {"Cuello Móvil": _or(col("Cuello Móvil"), "Normal")},
        ordinal=("Cuello Móvil", "Apertura Oral"),
        derive=lambda: {"Puntaje Mallampati": codes.shift_score("Puntaje Mallampati")},
        drop=("Cuello Móvil", "Apertura Oral"), canonical=("Cuello Móvil", "Apertura Oral"),
    ),
    "physical_exam": Stage(
        "Estado Nutricional",
        lambda: {"Color de Piel": _std("Color de Piel"), "Sistema Nervioso": _or(_loose("Sistema Nervioso"), "Sin dato")},
        onehot=("Color de Piel",), multilabel=("Sistema Nervioso",),
        derive=lambda: {"Estado Nutricional_encoded": codes.nutrition_from_bmi("IMC").cast("double")},
        drop=("Estado Nutricional", "Color de Piel"),
    ),
    "consciousness": Stage(
        "Apertura Visual",
        lambda: {c: _or(_std(c), "sin dato") for c in ("Apertura Visual", "Respuesta Verbal", "Respuesta Motora")},
        ordinal=("Apertura Visual", "Respuesta Verbal", "Respuesta Motora"),
        drop=("Apertura Visual", "Respuesta Verbal", "Respuesta Motora"),
    ),
    "systems": Stage(
        "Sistema Respiratorio", _systems, multilabel=("Sistema Respiratorio", "Sistema cardiovascular", "Abdomen"),
        drop=("Sistema Respiratorio", "Sistema cardiovascular", "Abdomen"),
    ),
    "conditions": Stage(
        "Arritmia", _conditions, ordinal=("Arritmia", "Disnea", "Angina"), multilabel=("Condición",),
        drop=("Arritmia", "Disnea", "Angina", "Condición"), canonical=("Arritmia",),
    ),
    "procedures": Stage(
        "Tipo de anestesia propuesta",
        lambda: {
            "Tipo de anestesia propuesta": _or(_loose("Tipo de anestesia propuesta"), "sin dato"),
            "Prótesis Dental": _std("Prótesis Dental"),
        },
        onehot=("Prótesis Dental",), multilabel=("Tipo de anestesia propuesta",),
        drop=("Tipo de anestesia propuesta", "Prótesis Dental"),
    ),
}


def canonical_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.canonicalise(c, STRICT_VALUES[c]) for c in names if c in df.columns})


def run_stages(
    df: DataFrame, names: Sequence[str], vocabulary: Vocabulary | None = None, strict: bool = True,
    extra_multilabel: Sequence[str] = (),
) -> tuple[DataFrame, Vocabulary]:
    """Run the stages whose trigger column is present; returns the frame and the vocabulary used.

    With a given vocabulary nothing is fitted, so the columns are known beforehand.
    `extra_multilabel` are comma-list columns prepared by the caller; they share the fit pass.
    """
    present = set(df.columns)
    stages = [STAGES[n] for n in names if STAGES[n].trigger in present]
    df = canonical_values(df, [c for s in stages for c in s.canonical])
    raw = df
    # a stage may read what an earlier one wrote (the dyspnoea marker), so they are stacked
    for stage in stages:
        normal = stage.normalise()
        if normal:
            df = df.withColumns(normal)
    onehot = [c for s in stages for c in s.onehot]
    multilabel = [*[c for s in stages for c in s.multilabel], *extra_multilabel]
    if vocabulary is None:
        normalise = {c: e for s in stages for c, e in s.normalise().items() if c in present}
        vocabulary = fit_vocabulary(raw, onehot, multilabel, normalise=normalise)
    terms = {f"_terms{i}": text.split_terms(c) for i, c in enumerate(multilabel)}
    out: dict[str, Column] = {}
    for c in onehot:
        out |= onehot_columns(c, vocabulary[c])
    for i, c in enumerate(multilabel):
        out |= {
            f"{c}_{x}": F.coalesce(F.array_contains(f"_terms{i}", x), F.lit(False)).cast("int") for x in vocabulary[c]
        }
    for s in stages:
        out |= {f"{c}_encoded": ordinal(c, ORDINAL[c], strict) for c in s.ordinal} | s.derive()
    if terms:
        df = df.withColumns(terms)
    df = df.withColumns(out).drop(*[c for s in stages for c in s.drop], *extra_multilabel, *terms)
    return df, vocabulary


def clean_dates(df: DataFrame) -> DataFrame:
    return df.withColumns(dates.date_parts("Fecha", "Hora")).drop("Fecha", "Hora")


def clean_vitals(df: DataFrame, key: str, noise: float = 0.03, seed: int = 42) -> DataFrame:
    """Numbers, range imputation, body measures by age band, mean pressure; in this order."""
    df = project.numeric_coerce(df, VITALS)
    df = project.range_random_impute(df, key, project.VITAL_RANGES, noise, seed)
    df = project.band_impute_body(df, key, noise=noise, seed=seed)
    if {SYSTOLIC, DIASTOLIC, MEAN} <= set(df.columns):
        df = df.withColumn(MEAN, project.mean_pressure(SYSTOLIC, DIASTOLIC, MEAN))
    return df


PRIOR = "Anestesia previa"


def prepare_prior_anaesthesia(df: DataFrame) -> DataFrame:
    """Null without anaesthetic history; dictionary over distinct texts; keyword list."""
    history = F.coalesce(col("Antecedentes anestésicos"), F.lit(0.0))
    prior = F.when(history != 0, text.standardise(PRIOR))
    df = df.withColumns({"Antecedentes anestésicos": history, PRIOR: prior})
    df = vocab.replace_words_by_distinct(df, PRIOR, vocab.ANAESTHESIA_WORDS)
    return df.withColumn(PRIOR, text.keyword_labels(PRIOR, vocab.ANAESTHESIA_KEYWORDS, "desconocido"))


def clean_prior_anaesthesia(df: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    out = encode.encode_multilabel(prepare_prior_anaesthesia(df), PRIOR, labels)
    return out.drop(PRIOR, "Antecedentes quirúrgicos")


ALLERGEN = "Alérgeno"


def prepare_allergens(df: DataFrame, row_key: str, aliases: DataFrame | None = None) -> DataFrame:
    """Allergy text replaced by its sorted macro classes."""
    classes = allergens.classify_allergens(df, ALLERGEN, aliases)
    dim = cut_lineage(classes.select(ALLERGEN, allergens.macro_classes("classes").alias("_macro")))
    joined = left_lookup(df, dim, ALLERGEN, row_key)
    return joined.withColumn(ALLERGEN, F.coalesce("_macro", F.lit(""))).drop("_macro")


def clean_allergens(df: DataFrame, row_key: str, aliases: DataFrame | None = None, labels=None) -> DataFrame:
    return encode.encode_multilabel(prepare_allergens(df, row_key, aliases), ALLERGEN, labels).drop(ALLERGEN, "Alergias")


MEDICATION = "Nombre del medicamento"


def clean_medications(
    df: DataFrame, row_key: str, resolver: lookup.Resolver, cache: DataFrame | None = None
) -> DataFrame:
    """Drug text -> cleaned name -> ATC first level -> fourteen indicators.

    The resolver answers distinct names with (key, atc_l1_code).
    """
    plain = text.phrases_to_null(text.standardise(MEDICATION, replace_char=" "), vocab.MEDICATION_NEGATIONS)
    name = F.when(plain.isNotNull(), text.remove_stopwords(plain, text.spanish_stopwords()))
    df = df.withColumn(MEDICATION, name)
    if cache is None:
        cache = df.sparkSession.createDataFrame([], "key string, atc_l1_code string")
    out, _ = lookup.lookup_with_cache(df, MEDICATION, row_key, cache, resolver, ["atc_l1_code"])
    return out.withColumns(codes.atc_group_flags("atc_l1_code")).drop("atc_l1_code", MEDICATION)


DX_COLUMNS = {"Dx Preoperatorio": "dx", "Procedimiento propuesto": "proc", "Antecedentes quirúrgicos": "proc_ant"}


def clean_dx_procedures(
    df: DataFrame, row_key: str, translations: DataFrame, code_books: Mapping[str, DataFrame],
    labeller=None, vocabulary: Vocabulary | None = None,
) -> DataFrame:
    """Diagnosis and procedure texts: translation, code, chapter, severity label and scores.

    translations: (key, text_en); code_books: column -> (code, term). Everything is resolved
    per distinct text and joined back.
    """
    labeller = labeller or lookup.keyword_labeller()
    dims: dict[str, DataFrame] = {}
    for c in DX_COLUMNS:
        en, code = f"{c} EN", f"{c} Code"
        texts = df.select(col(c)).where(col(c).isNotNull()).distinct()
        named, _ = lookup.lookup_with_cache(
            texts, c, c, translations, lambda misses: misses.withColumn("text_en", F.lit(None).cast("string")), ["text_en"]
        )
        named = cut_lineage(named.withColumnRenamed("text_en", en))
        found = lookup.code_by_token_subsets(named, en, code_books[c]).select(col(en).alias("_en"), F.col("code").alias(code))
        coded = left_lookup(named, found, en, c, "_en").withColumns(
            {en: codes.mark_not_found(c, en), code: codes.mark_not_found(c, code)}
        )
        # one row per distinct text, written once
        dims[c] = cut_lineage(coded.withColumn(code, codes.code_chapter(code)))
    texts = reduce(DataFrame.unionByName, [dims[c].select(col(f"{c} EN").alias("t")) for c in DX_COLUMNS])
    labels = cut_lineage(
        lookup.label_texts(texts, "t", None, labeller).select("text_hash", "model", "predicted_label", "all_labels", "all_scores")
    )
    for c, suffix in DX_COLUMNS.items():
        dim = first_by_hash(dims[c], labels, f"{c} EN", c, "model", f"_{suffix}")
        df = left_lookup(df, dim, c, row_key)
    if vocabulary is None:
        vocabulary = fit_vocabulary(df, onehot=[f"{c} Code" for c in DX_COLUMNS])
    out: dict[str, Column] = {}
    for c, suffix in DX_COLUMNS.items():
        out |= onehot_columns(f"{c} Code", vocabulary[f"{c} Code"])
        out[f"predicted_label_{suffix}_encoded"] = ordinal(
            _or(col(f"predicted_label_{suffix}"), "NONE"), SEVERITY_CLASSES
        )
        pairs = F.map_from_arrays(f"all_labels_{suffix}", f"all_scores_{suffix}")
        for label in lookup.SEVERITY_LABELS:
            out[f"score_{suffix}_{label.replace(' ', '_')}"] = F.coalesce(F.try_element_at(pairs, F.lit(label)), F.lit(0.0))
    gone = [f"{p}_{s}" for s in DX_COLUMNS.values() for p in ("predicted_label", "all_labels", "all_scores")]
    return df.withColumns(out).drop(*gone, *[f"{c} Code" for c in DX_COLUMNS])


def clean_all(
    df: DataFrame, key: str, minimum_age: float = 18, leakage: Sequence[str] = (),
    identifiers: Sequence[str] = ("CODIGO",), outliers: Mapping[str, tuple] | None = None,
    renames: Mapping[str, str] | None = None, vocabulary: Vocabulary | None = None,
    aliases: DataFrame | None = None, exam_fill: float | None = 0.0,
) -> tuple[DataFrame, Vocabulary]:
    """The whole deterministic cleaning; each step runs only if its columns are there.

    All categorical columns share one fit pass, or none when a vocabulary is given.
    """
    df = project.rename_map(df, renames or {})
    df = project.drop_columns(df, leakage)
    present = set(df.columns)
    if {"Fecha", "Hora"} <= present:
        df = clean_dates(df)
    df = project.outlier_nullify(df, outliers if outliers is not None else {"Edad": (0, 120)})
    df = clean_vitals(df, key)
    if "Edad" in present:
        df = project.filter_min_age(df, "Edad", minimum_age)
    lists = []
    if PRIOR in present:
        df = prepare_prior_anaesthesia(df).drop("Antecedentes quirúrgicos")
        lists.append(PRIOR)
    if ALLERGEN in present:
        df = prepare_allergens(df, key, aliases).drop("Alergias")
        lists.append(ALLERGEN)
    if "Examen" in present:
        result = "Resultado de examen de laboratorio"
        df = labs.lab_wide(df, "Examen", result, exam_fill).drop("Examen", result)
    df, vocabulary = run_stages(df, list(STAGES), vocabulary, extra_multilabel=lists)
    return project.drop_columns(df, identifiers), vocabulary
